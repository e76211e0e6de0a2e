"""Token files of patched frame-of-reference (PFOR) blocks, in ascending doc_id order.

A block holds up to ``BLOCK`` values. Their minimum is subtracted; the width is the fewest bits
that ``PERCENTILE`` % of the rest fit into; the low bits are packed at that width as byte planes
and bit planes; the values that do not fit are exceptions, a list of positions and missing high
bits. A file holds the id blocks, the documents' ids and lengths (lengths are PFOR blocks too), an
index of block starts, and a fixed-size footer, so a reader can seek to any block.

``write_token_files`` range-partitions documents by doc_id and writes one file per partition, each
by its own task and in bounded memory. ``read_token_files`` reads them back, one file per task, and
yields a row per document. Global token offsets are the running sum of the files' counts.

Edge cases. Null and empty texts have only the end id. Null doc_ids come first and stay null. Rows
of equal doc_id are ordered by a hash of their text, so they split over partitions if there are
many; repeated rows are written once each. Extra columns are ignored. An empty table gives files
without documents, or none, and an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ferry.llm.common import one_per_task
from ferry.llm.files import locate, writing
from ferry.llm.tokenizing import encoder
from ferry.session import scratch_path

BLOCK = 1 << 14
PERCENTILE = 90
MAGIC = b"PFR1"
HEAD = struct.Struct("<IHHBBxx")          # minimum, values, exceptions, width, exception bytes
FOOT = struct.Struct("<QQQIII4s")         # ids, documents' section, index, id blocks, documents, length blocks, magic


def pack_block(values: np.ndarray) -> bytes:
    """One block of 1 to BLOCK uint32 values."""
    low = int(values.min())
    rest = values - np.uint32(low)
    k = min(len(rest) - 1, len(rest) * PERCENTILE // 100)
    width = int(np.partition(rest, k)[k]).bit_length()
    high = rest >> np.uint32(width) if width < 32 else np.zeros(0, np.uint32)
    at = np.flatnonzero(high)
    patch = high[at] if len(at) else np.zeros(0, np.uint32)
    size = 0 if not len(at) else (int(patch.max()).bit_length() + 7) // 8
    parts = [HEAD.pack(low, len(values), len(at), width, size)]
    planes = np.ascontiguousarray(rest, "<u4").view(np.uint8).reshape(-1, 4)
    full, bits = divmod(width, 8)
    parts += [planes[:, j].tobytes() for j in range(full)]
    if bits:
        top = planes[:, full]
        parts += [np.packbits((top >> j) & 1).tobytes() for j in range(bits)]
    if len(at):
        parts += [at.astype("<u2").tobytes(), np.ascontiguousarray(patch, "<u4").view(np.uint8).reshape(-1, 4)[:, :size].tobytes()]
    return b"".join(parts)


def unpack_block(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """The values of the block at ``at``, and where it ends."""
    low, n, exceptions, width, size = HEAD.unpack_from(data, at)
    at += HEAD.size
    planes = np.zeros((n, 4), np.uint8)
    full, bits = divmod(width, 8)
    for j in range(full):
        planes[:, j] = np.frombuffer(data, np.uint8, n, at)
        at += n
    step = (n + 7) // 8
    if bits:
        top = np.zeros(n, np.uint8)
        for j in range(bits):
            top |= np.unpackbits(np.frombuffer(data, np.uint8, step, at), count=n) << j
            at += step
        planes[:, full] = top
    values = planes.view("<u4").reshape(n)
    if exceptions:
        where = np.frombuffer(data, "<u2", exceptions, at)
        at += 2 * exceptions
        patch = np.zeros((exceptions, 4), np.uint8)
        patch[:, :size] = np.frombuffer(data, np.uint8, exceptions * size, at).reshape(exceptions, size)
        at += exceptions * size
        values[where] |= patch.view("<u4").reshape(exceptions) << np.uint32(width)
    return values + np.uint32(low), at


class TokenFileWriter:
    """Appends documents to an output stream; holds one block of ids and the document index."""

    def __init__(self, out) -> None:
        self.out, self.at = out, 0
        self.pending: list[np.ndarray] = []
        self.waiting = self.tokens = 0
        self.starts: list[int] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _flush(self, whole: bool) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, np.uint32)
        end = len(ids) if whole else len(ids) // BLOCK * BLOCK
        for k in range(0, end, BLOCK):
            self.starts.append(self.at)
            self._put(pack_block(ids[k:min(k + BLOCK, end)]))
        self.pending, self.waiting = [ids[end:]], len(ids) - end

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids))
        self.tokens += len(ids)
        self.pending.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 8 * BLOCK:
            self._flush(False)

    def close(self) -> None:
        self._flush(True)
        documents, blocks = self.at, len(self.starts)
        null = np.array([d is None for d in self.doc_ids], bool)
        self._put(np.packbits(null).tobytes())
        self._put(np.array([0 if d is None else d for d in self.doc_ids], "<i8").tobytes())
        lengths = np.array(self.lengths, "<u4")
        for k in range(0, len(lengths), BLOCK):
            self.starts.append(self.at)
            self._put(pack_block(lengths[k:k + BLOCK]))
        index = self.at
        self._put(np.array(self.starts, "<u8").tobytes())
        self._put(FOOT.pack(self.tokens, documents, index, blocks, len(null), len(self.starts) - blocks, MAGIC))


class TokenFileReader:
    """Reads a token file from a random-access source; blocks are read one at a time."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        tail = self._at(size - FOOT.size, FOOT.size)
        self.tokens, self.documents, self.index, self.blocks, self.n_docs, self.length_blocks, magic = FOOT.unpack(tail)
        if magic != MAGIC:
            raise ValueError("not a token file")
        starts = np.frombuffer(self._at(self.index, 8 * (self.blocks + self.length_blocks)), "<u8").tolist()
        self.starts = starts[:self.blocks] + [self.documents]
        self.length_starts = [*starts[self.blocks:], self.index]

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        return self.source.read(size)

    def block(self, k: int) -> np.ndarray:
        """The ids of block ``k``, found through the index."""
        return unpack_block(self._at(self.starts[k], self.starts[k + 1] - self.starts[k]))[0]

    def doc_table(self) -> tuple[list[int | None], list[int]]:
        head = (self.n_docs + 7) // 8
        data = self._at(self.documents, head + 8 * self.n_docs)
        null = np.unpackbits(np.frombuffer(data, np.uint8, head), count=self.n_docs).astype(bool)
        ids = np.frombuffer(data, "<i8", self.n_docs, head).tolist()
        lengths: list[int] = []
        for a, b in zip(self.length_starts, self.length_starts[1:]):
            lengths += unpack_block(self._at(a, b - a))[0].tolist()
        return [None if n else d for d, n in zip(ids, null)], lengths

    def documents_ids(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) in file order; holds one document and one block."""
        doc_ids, lengths = self.doc_table()
        ids, at, k = np.zeros(0, np.uint32), 0, 0
        for doc_id, n in zip(doc_ids, lengths):
            parts, need = [], n
            while need:
                if at == len(ids):
                    ids, at, k = self.block(k), 0, k + 1
                take = ids[at:at + need]
                parts.append(take)
                at, need = at + len(take), need - len(take)
            yield doc_id, parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.uint32), *parts])


MANIFEST = "part int, path string, n_docs long, n_tokens long"


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 0) -> DataFrame:
    """Write ``docs`` (doc_id, text) as token files below ``folder``; returns the written manifest."""
    spark = docs.sparkSession
    ordered = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    ordered = ordered.repartitionByRange(F.col("doc_id").asc_nulls_first(), "h") \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h").select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        path = f"{folder}/part-{part:06d}.pfr"
        enc, end = encoder(tokenizer_path), np.array([end_id], np.uint32)
        with writing(path) as out:
            writer = TokenFileWriter(out)
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    writer.add(doc_id, np.concatenate([enc.ids(text.as_py()), end]))
            writer.close()
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "path": [path],
            "n_docs": [len(writer.lengths)], "n_tokens": [writer.tokens]})

    manifest = f"{folder}/manifest.parquet"
    ordered.mapInArrow(write, MANIFEST).write.parquet(manifest)
    return spark.read.parquet(manifest)


READ = "part int, doc_id long, start_in_file long, n_tokens long, ids_crc32 long"


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 for every document, read back from the files."""
    # One small row per file: the running sum needs no shuffle of documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, path in zip(batch.column("part").to_pylist(), batch.column("path").to_pylist()):
                store, place = locate(path)
                with store.open_input_file(place) as source:
                    rows, start = [], 0
                    for doc_id, ids in TokenFileReader(source).documents_ids():
                        rows.append((part, doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(rows) == 20_000:
                            yield _batch(rows)
                            rows = []
                    if rows:
                        yield _batch(rows)

    files = one_per_task(manifest.where("n_docs > 0").select("part", "path"), "part")
    return files.mapInArrow(read, READ).join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["part", "doc_id", "start_in_file", "n_tokens", "ids_crc32"]
    kinds = [pa.int32()] + [pa.int64()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def token_file_digest(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write token files to the shared scratch folder and read them back."""
    spark: SparkSession = docs.sparkSession
    return read_token_files(write_token_files(docs, tokenizer_path, scratch_path(spark, "token-files"), end_id))
