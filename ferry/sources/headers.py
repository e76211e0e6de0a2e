"""Header catalog: which columns each object folder holds, and how that drifts.

An object is the first folder below the root, however its files are nested in it (``year=`` or
``run_id=`` folders). The first data file below it, in name order, gives the header. Spark lists the files
(in parallel beyond a few folders); tasks pick each object's first file and read its header: the beginning of
a CSV file up to its first record, or the footer of a Parquet file. No folder or header passes the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.sources.binary import open_file, read_files
from ferry.sources.split_csv import header_names

CATALOG_SCHEMA = "object_name string, position int, column_name string"


def first_record(path: str, step: int = 1 << 16) -> str:
    """The first non-blank record of a CSV file in the quoted dialect; no more of the file is read than that needs."""
    with open_file(path) as f:
        data, quotes, begin = b"", 0, 0
        while True:
            more = f.read(step)
            at = len(data)
            data += more
            if not more:
                return data[begin:].decode().rstrip("\r\n")
            for i in range(at, len(data)):
                if data[i] == 34:
                    quotes ^= 1
                elif data[i] == 10 and not quotes:
                    if data[begin:i].strip(b"\r"):
                        return data[begin:i].decode().rstrip("\r")
                    begin = i + 1


def file_header(path: str, fmt: str) -> list[str]:
    if fmt != "parquet":
        return header_names(first_record(path))
    import pyarrow.parquet as pq

    with open_file(path, seek=True) as f:
        return pq.ParquetFile(f).schema_arrow.names


def first_files(spark: SparkSession, root: str, fmt: str) -> DataFrame:
    """``object_name, path``: the first non-empty ``fmt`` file of each folder directly below ``root``.

    Files of a folder come before those of its sub-folders, each in name order.
    """
    base = urlparse(root).path.rstrip("/") + "/"
    below = F.split(F.col("path").substr(F.instr("path", base) + len(base), F.length("path")), "/")
    files = read_files(spark, root, glob=f"*.{fmt}", recursive=True, with_content=False).where("length > 0").select("path", below.alias("names"))
    nested = files.where(F.size("names") > 1)
    folders = F.transform(F.slice("names", 2, F.greatest(F.size("names") - 2, F.lit(0))), lambda n: F.concat(F.lit("1"), n))
    order = F.concat(folders, F.array(F.concat(F.lit("0"), F.element_at("names", -1))))
    first = nested.groupBy(F.col("names")[0].alias("object_name")).agg(F.min(F.struct(order.alias("order"), "path")).alias("first"))
    return first.select("object_name", "first.path")


def header_catalog(spark: SparkSession, root: str, fmt: str = "csv") -> DataFrame:
    """``(object_name, position, column_name)`` for each object folder that holds a ``fmt`` file.

    Folders without such a file are skipped; no file at all is an error.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, path in zip(*(c.to_pylist() for c in batch.columns)):
                columns = file_header(path, fmt)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(columns), pa.string()), pa.array(range(1, len(columns) + 1), pa.int32()),
                                                  pa.array(columns, pa.string())], ["object_name", "position", "column_name"])

    files = first_files(spark, root, fmt)
    if files.isEmpty():
        raise FileNotFoundError(f"no {fmt} header found below {root}")
    return files.mapInArrow(read, CATALOG_SCHEMA)


def header_drift(catalog: DataFrame, expected: DataFrame) -> DataFrame:
    """Compare a catalog with an expected one (both ``object_name, position, column_name``).

    One row per (object, column) on either side with ``status`` in ``same`` / ``moved`` (present
    at another position) / ``missing`` (expected, not found) / ``extra`` (found, not expected).
    """
    a = catalog.select("object_name", "column_name", F.col("position").alias("found_position"))
    e = expected.select("object_name", "column_name", F.col("position").alias("expected_position"))
    j = a.join(e, ["object_name", "column_name"], "full_outer")
    status = (F.when(F.col("found_position").isNull(), F.lit("missing"))
              .when(F.col("expected_position").isNull(), F.lit("extra"))
              .when(F.col("found_position") == F.col("expected_position"), F.lit("same"))
              .otherwise(F.lit("moved")))
    return j.select("object_name", "column_name", "expected_position", "found_position",
                    status.alias("status"))
