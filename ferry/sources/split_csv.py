"""Multi-line CSV in the quoted dialect, read by as many tasks as the files have splits.

Whether a line break ends a record depends on the quotes before it, from the start of the file on. So:

1. Spark's text source reads lines, whatever splits it cuts the files into. Tasks pack consecutive lines of
   a split into chunks of about ``chunk_bytes``, each with the parity of its quotes and of those before it
   in its split, and the chunks are written once to the shared scratch folder.
2. Parities are summed per split, and over the splits of a file: one row per split tells whether it
   begins inside a quoted value. With that, every chunk is cut into records on its own.
3. A record that crosses a chunk border leaves fragments, which are put together by position. They are
   the only text that is shuffled.
4. Records are parsed by ``from_csv`` with the reader's own options.

The rows equal those of the multi-line reader for files whose values hold quotes in quoted form only (the
quoted dialect; all common writers do so). A quote inside an unquoted value would turn the parity, so
it raises an error instead of giving wrong rows; ``read_csv`` reads such files, one task a file. Records end
with a line feed, with or without a carriage return before it; empty lines are skipped. All files share the
header of the given schema (``union_csv_splits`` takes each file's own). A single record has to fit into a row.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ferry.session import scratch_path

QUOTE, FEED, RETURN = 34, 10, 13
CHUNK_TYPES = "file string, block long, chunk long, text string, before int, parity int, crlf boolean"
PIECE_TYPES = "file string, block long, chunk long, kind int, first boolean, text string"
#: Kinds of pieces: a whole record, the beginning of one, and what continues one.
WHOLE, BEGINS, CONTINUES = 0, 1, 2


def line_chunks(lines: DataFrame, chunk_bytes: int) -> DataFrame:
    """Lines ``file, block, value`` in the order of their splits as chunks ``CHUNK_TYPES``."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, chunk, before, held, size = None, 0, 0, [], 0
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.bool_()]
        names = ["file", "block", "chunk", "text", "before", "parity", "crlf"]

        def packed() -> pa.RecordBatch:
            text = "\n".join([*held, ""])
            columns = [pa.array([x], t) for x, t in zip([*place, chunk, text, before, text.count('"') & 1, held[0].endswith("\r")], types)]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for file, block, value in zip(*(c.to_pylist() for c in batch.columns)):
                if held and ((file, block) != place or size >= chunk_bytes):
                    out = packed()
                    yield out
                    before ^= out.column("parity")[0].as_py()
                    chunk, held, size = chunk + 1, [], 0
                if (file, block) != place:
                    place, chunk, before = (file, block), 0, 0
                held.append(value)
                size += len(value) + 1
        if held:
            yield packed()

    return lines.mapInArrow(pack, CHUNK_TYPES)


def split_states(chunks: DataFrame) -> DataFrame:
    """``file, block, open, returns``: whether a split begins inside a quoted value, and whether the first line
    of its file ends with a carriage return (a row per split)."""
    lead = (F.col("block") == 0) & (F.col("chunk") == 0)
    splits = chunks.groupBy("file", "block").agg((F.sum("parity") % 2).alias("parity"), F.max(lead & F.col("crlf")).alias("crlf"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select("file", "block", (F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2).cast("int").alias("open"),
                         F.max("crlf").over(Window.partitionBy("file").orderBy("block")).alias("returns"))


def cut_records(text: str, inside: bool, separator: str) -> tuple[list[int], bool]:
    """Ends of the records of a chunk (after their line feeds), given whether it begins inside a value;
    and whether a quote was found inside an unquoted value."""
    import numpy as np

    data = np.frombuffer(text.encode(), np.uint8)
    quotes = data == QUOTE
    depth = (np.cumsum(quotes) + int(inside)) & 1              # after each byte
    ends = np.flatnonzero((data == FEED) & (depth == 0)) + 1
    opening = np.flatnonzero(quotes & (depth == 1))
    behind = data[opening[opening > 0] - 1]
    return ends.tolist(), bool((~np.isin(behind, [QUOTE, FEED, RETURN, ord(separator)])).any())


def record_pieces(chunks: DataFrame, separator: str, fragments: bool) -> DataFrame:
    """Pieces of the chunks (with ``open``): whole records, or with ``fragments`` what crosses their borders."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, block, chunk, text, inside, returns in zip(*(c.to_pylist() for c in batch.columns)):
                ends, stray = cut_records(text, inside, separator)
                if stray:
                    raise ValueError(f"a quote inside an unquoted value in {file}, at or after byte {block}")
                data = text.encode()
                starts = [0, *ends]
                pieces = [(WHOLE, data[a:b]) for a, b in zip(starts, ends)] if not fragments or inside else []
                if inside:
                    head = data[:ends[0]] if ends else data
                    pieces = [(CONTINUES, head), *pieces[1:]]
                if ends and ends[-1] < len(data) or not ends and not inside:
                    pieces.append((BEGINS, data[starts[-1]:]))
                # The header is the first record with any text.
                lead = not inside and not block and not chunk
                out = []
                for i, (kind, piece) in enumerate(pieces):
                    blank = kind == WHOLE and not piece.rstrip(b"\r\n")
                    first = lead and not blank and (not fragments or not any(data[a:b].rstrip(b"\r\n") for a, b in zip(starts, ends)))
                    lead = lead and blank
                    if not blank and (kind != WHOLE) == fragments:
                        piece = piece.replace(b"\r\n", b"\n") if returns else piece
                        out.append((kind, first, piece.decode()))
                for k in range(0, len(out), 4096):
                    kinds, firsts, texts = zip(*out[k:k + 4096])
                    n = len(kinds)
                    yield pa.RecordBatch.from_arrays([pa.array([file] * n), pa.array([block] * n), pa.array([chunk] * n), pa.array(kinds, pa.int32()),
                                                      pa.array(firsts), pa.array(texts)], ["file", "block", "chunk", "kind", "first", "text"])

    inside = (F.col("open") != F.col("before")).alias("inside")
    return chunks.select("file", "block", "chunk", "text", inside, "returns").mapInArrow(cut, PIECE_TYPES)


def joined_fragments(pieces: DataFrame) -> DataFrame:
    """``file, first, text`` of the records that cross borders: a beginning and what continues it, in file order."""
    order = [F.col("block"), F.col("chunk"), (F.col("kind") == BEGINS).cast("int")]
    number = F.sum((F.col("kind") == BEGINS).cast("long")).over(Window.partitionBy("file").orderBy(*order))
    numbered = pieces.withColumn("record", number)
    parts = F.array_sort(F.collect_list(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], "first", "text")))
    whole = numbered.groupBy("file", "record").agg(parts.alias("parts"))
    return whole.select("file", F.col("parts")[0]["first"].alias("first"),
                        F.array_join(F.transform("parts", lambda x: x["text"]), "").alias("text"))


def csv_records(spark: SparkSession, path: str | Sequence[str], options: dict[str, str], recursive: bool = False,
                chunk_bytes: int = 1 << 20) -> DataFrame:
    """``file, first, line``: every record of the files at ``path``; ``first`` marks the first of its file."""
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", str(recursive).lower())
    if "pathGlobFilter" in options:
        reader = reader.option("pathGlobFilter", options["pathGlobFilter"])
    lines = reader.text([path] if isinstance(path, str) else list(path)).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    scratch = scratch_path(spark, "csv-chunks")
    line_chunks(lines, chunk_bytes).write.parquet(scratch)
    chunks = spark.read.parquet(scratch)
    placed = chunks.join(split_states(chunks.select("file", "block", "chunk", "parity", "crlf")), ["file", "block"])
    separator = options.get("sep", ",")
    records = record_pieces(placed, separator, False).select("file", "first", "text").unionByName(
        joined_fragments(record_pieces(placed, separator, True)))
    return records.select("file", "first", F.regexp_replace("text", "\r?\n\\z", "").alias("line"))


def _parsed(names: Sequence[str] | StructType, options: dict[str, str]):
    if not isinstance(names, StructType):
        names = StructType([StructField(n, StringType()) for n in names])
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in names.fields)
    return F.from_csv("line", ddl, {k: v for k, v in options.items() if k not in READER_ONLY})


#: Options of the reader that mean nothing to a single line.
READER_ONLY = ("header", "pathGlobFilter", "recursiveFileLookup", "enforceSchema")


def read_csv_splits(spark: SparkSession, path: str | Sequence[str], schema: StructType, options: dict[str, str],
                    recursive: bool = False, chunk_bytes: int = 1 << 20) -> DataFrame:
    """Rows of multi-line CSV files with a header, by split (see the module). ``options`` are the reader's."""
    records = csv_records(spark, path, options, recursive, chunk_bytes)
    if options.get("header", "true").lower() == "true":
        records = records.where(~F.col("first"))
    return records.select(_parsed(schema, options).alias("row")).select("row.*")


def header_names(line: str, separator: str = ",") -> list[str]:
    """Column names of a header record, as the reader gives them: ``_c0`` for an empty name, and the position
    after names that occur twice."""
    names = next(csv.reader(io.StringIO(line, newline=""), delimiter=separator), [])
    low = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if low.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def union_csv_splits(spark: SparkSession, path: str | Sequence[str], options: dict[str, str], recursive: bool = False,
                     chunk_bytes: int = 1 << 20) -> DataFrame | None:
    """All files at ``path`` as one table, each file's columns by the names of its own header.

    Headers are found by the tasks that read the files; only the distinct ones reach the driver, so the
    number of jobs does not grow with the files. None if no file has a record.
    """
    records = csv_records(spark, path, options, recursive, chunk_bytes)
    scratch = scratch_path(spark, "csv-headers")
    records.where("first").select("file", F.col("line").alias("header")).write.parquet(scratch)
    headers = spark.read.parquet(scratch)
    found = headers.groupBy("header").agg(F.min("file").alias("file")).orderBy("file").collect()
    if not found:
        return None
    numbers = spark.createDataFrame([(r["header"], i) for i, r in enumerate(found)], "header string, number int")
    rows = records.where(~F.col("first")).join(headers.join(F.broadcast(numbers), "header").select("file", "number"), "file")
    names = [header_names(r["header"], options.get("sep", ",")) for r in found]
    parsed = rows.select(*[F.when(F.col("number") == i, _parsed(own, options)).alias(f"row{i}") for i, own in enumerate(names)])
    columns: dict[str, list] = {}
    spelling: dict[str, str] = {}
    for i, own in enumerate(names):
        for name in own:
            spelling.setdefault(name.lower(), name)
            columns.setdefault(name.lower(), []).append(F.col(f"row{i}")[name])
    return parsed.select(*[F.coalesce(*parts).alias(spelling[key]) for key, parts in columns.items()])
