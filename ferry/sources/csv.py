"""CSV in the quoted dialect, and a by-name union over files with drifting headers.

Every column is read as a string (no schema inference): the data model of the migrated objects is
text, and typed columns come only from explicit casts. Note the null model of the CSV hop: with
default options both null and ``''`` come back as null, and the writer strips outer white space.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ferry.sources.listing import exists, folders_with
from ferry.sources.split_csv import read_csv_splits, union_csv_splits

QUOTED_DIALECT = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}


def read_csv(spark: SparkSession, path: str | Sequence[str], recursive: bool = False,
             schema: StructType | None = None, check_header: bool = False, multiline: bool | str = True,
             **options) -> DataFrame:
    """Read CSV in the quoted dialect (doubled quotes, embedded line breaks).

    ``recursive`` reads every file below ``path`` (and disables partition discovery).
    ``check_header`` makes Spark compare each file's header with ``schema`` and fail on a
    mismatch instead of reading columns by position. Spark's multi-line reader gives a file to one
    task; ``multiline=False`` (for files known to hold no line break inside a value, e.g. scrubbed
    output) lets Spark split large files, and ``multiline="split"`` splits files with such line breaks as
    well (see ``ferry.sources.split_csv``; the header is that of the first file unless ``schema`` is given).
    """
    if multiline == "split":
        names = header_of(spark, path, recursive, **options) if schema is None else None
        schema = schema if schema is not None else StructType([StructField(n, StringType()) for n in names])
        return read_csv_splits(spark, path, schema, {**QUOTED_DIALECT, **{k: str(v) for k, v in options.items()}}, recursive)
    opts = dict(QUOTED_DIALECT)
    opts["multiLine"] = "true" if multiline else "false"
    if recursive:
        opts["recursiveFileLookup"] = "true"
    if check_header:
        opts["enforceSchema"] = "false"
    opts.update({k: str(v) for k, v in options.items()})
    reader = spark.read.options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    return reader.csv(paths)


def header_of(spark: SparkSession, path: str | Sequence[str], recursive: bool = False, **options) -> list[str]:
    """Column names of a CSV file: Spark reads its first record only."""
    return read_csv(spark, path, recursive, **options).columns


def headers_of(spark: SparkSession, paths: Sequence[str], fmt: str = "csv",
               threads: int = 16) -> list[list[str]]:
    """Headers of many files (the first record of a CSV file, the footer of a Parquet file).
    Each read is a small job; the jobs are submitted from a few driver threads at once so that
    many folders do not queue behind each other."""
    def one(p: str) -> list[str]:
        return header_of(spark, p) if fmt == "csv" else spark.read.format(fmt).load(p).columns

    if len(paths) <= 1:
        return [one(p) for p in paths]
    with ThreadPoolExecutor(max_workers=min(threads, len(paths))) as pool:
        return list(pool.map(one, paths))


def union_by_header(spark: SparkSession, root: str, glob: str = "*.csv", group_by: str = "auto") -> DataFrame:
    """Read every CSV file below ``root`` as one table, matching columns by header name.

    A folder with a success marker was written by one job: its files share the header of its first
    non-empty file, however many they are. In other folders each file has its own header, found by the tasks
    that read the file (``split_csv``): the number of jobs does not grow with the files, only distinct headers
    reach the driver, and large files are split. ``group_by="directory"`` trusts one header per folder
    everywhere, ``"file"`` reads every file's. Files of trusted folders with equal headers are read with one
    scan, whose header check makes a file with other columns fail loudly instead of landing in the wrong
    columns. The parts are combined with ``unionByName(allowMissingColumns=True)``.
    """
    if group_by not in ("auto", "file", "directory"):
        raise ValueError("group_by is 'auto', 'file' or 'directory'")
    if group_by == "file":
        out = union_csv_splits(spark, root, {**QUOTED_DIALECT, "pathGlobFilter": glob}, recursive=True)
        if out is None:
            raise FileNotFoundError(f"no CSV file below {root}")
        return out
    trusted, loose = [], []                                   # (path to scan, file with its header); folders
    for folder, first in folders_with(spark, root, glob):
        if group_by == "directory" or exists(spark, f"{folder}/_SUCCESS"):
            trusted.append((f"{folder}/{glob}", first))
        else:
            loose.append(f"{folder}/{glob}")
    if not trusted and not loose:
        raise FileNotFoundError(f"no CSV file below {root}")
    headers = headers_of(spark, [first for _, first in trusted])
    by_header: dict[tuple[str, ...], list[str]] = {}
    for (path, _), names in zip(trusted, headers):
        by_header.setdefault(tuple(names), []).append(path)
    parts = [read_csv(spark, paths, schema=StructType([StructField(n, StringType()) for n in names]), check_header=True)
             for names, paths in by_header.items()]
    if loose:
        parts.append(union_csv_splits(spark, loose, QUOTED_DIALECT))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [p for p in parts if p is not None])
