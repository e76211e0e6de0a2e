"""Removal of every byte that lies in a string of ``width`` bytes which starts anywhere else as well.

Texts are UTF-8 bytes. A window is ``width`` bytes of one text; it is repeated if an equal window starts at
another place, in the same text or another one. The bytes of all repeated windows are removed; what is
repeated is judged on the input.

Method. Repeated windows are found by suffix arrays (``suffix_groups``: linear grouping by Lyndon prefixes):
in such an array equal windows are neighbours, so a window is repeated if it equals the one before or
after it. One array over a corpus would have to lie in one task; so windows that can be equal are brought
together first, and an array is built for each such group:

1. The anchor of a window is its ``gram``-byte string of least hash (the leftmost of equal ones), a property
   of the window alone. Consecutive windows with one anchor are a run. Equal windows lie in runs of equal
   anchor, so runs whose anchor string occurs once in the corpus are left out.
2. Runs that are equal byte for byte are counted and one of them is kept as their representative (with a
   count above one, all of its windows are repeated). So copies, however many, enter an array once.
3. Runs of one anchor belong to the home of that anchor: the block of text where its first run lies. As the
   runs of neighbouring anchors mostly have one home, they are joined to regions of text again before an
   array is built per home.
4. A home with more than ``most`` bytes is taken apart, one anchor each; an anchor with more than that
   (a phrase in very many contexts) is refined: its windows are split into those that begin further left and
   further right, whose common core is longer, and the runs of such longer cores are the runs of step 2
   again. After at most some 8 halvings a core is a whole window and all its runs are equal. Nothing is dropped.

On Spark. Documents are written once with a row number. Anchors, runs and spans are narrow rows; texts are
never shuffled: the regions of a document are cut, and its bytes removed, in tasks that scan the written
documents and look the narrow rows of their file up in the shared scratch folder.

Edge cases. A null text counts as empty. Rows are told apart by their number, so ids may be null or repeated,
and repeated rows are copies of each other. Texts of any length are searched in pieces of ``piece`` bytes.
Ties do not matter. Extra columns are ignored; an empty table gives an empty result. Equality of runs
rests on two 64-bit hashes, of the anchor and of the run; equality of windows inside an array on their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ferry.llm.common import written
from ferry.llm.files import locate
from ferry.llm.suffix_groups import suffix_array
from ferry.llm.words import mix
from ferry.operators.salting import reduce_apart
from ferry.session import scratch_path


@dataclass(frozen=True)
class RepeatParams:
    """Length of a window and of an anchor; bytes of a home block, of an array at most, of arrays that are
    built together, and of a piece of text."""

    width: int = 200
    gram: int = 64
    block: int = 4096
    most: int = 1 << 19
    unit: int = 1 << 11
    piece: int = 1 << 19


_RANDOM = np.random.default_rng(13)
_BYTE = _RANDOM.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]))


class Hasher:
    """Hashes of all strings of a buffer: a polynomial over random byte codes, modulo 2**64."""

    def __init__(self, size: int):
        self.up, self.down = _powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size)

    def sums(self, data: np.ndarray) -> np.ndarray:
        return np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[data] * self.up[:len(data)])])

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.down[start])


def window_minima(values: np.ndarray, size: int) -> np.ndarray:
    """The least value of every ``size`` consecutive ones, by minima from both ends of blocks."""
    n = len(values) - size + 1
    blocks = np.concatenate([values, np.full(-len(values) % size, values.max())]).reshape(-1, size)
    from_left = np.minimum.accumulate(blocks, 1).ravel()
    from_right = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(from_right[:n], from_left[size - 1:size - 1 + n])


RUNS = pa.schema([("key", pa.int64()), ("run", pa.int64()), ("ref", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()),
                  ("anchor", pa.int32()), ("near", pa.int32()), ("far", pa.int32())])
RUN_TYPES = "key long, run long, ref long, lo int, hi int, anchor int, near int, far int"


def runs_of(texts: list[tuple[int, int, bytes]], p: RepeatParams, hasher: Hasher) -> pa.RecordBatch:
    """Runs of pieces ``(ref, offset, bytes)`` that are searched as one buffer.

    ``lo`` to ``hi`` are the starts of the run's windows, ``near`` to ``far`` the distances from a window's
    start to its anchor that its key stands for (at first all).
    """
    sizes = np.array([len(t) for *_, t in texts])
    data = np.frombuffer(b"".join(t for *_, t in texts), np.uint8)
    begins = np.cumsum(sizes) - sizes
    if len(data) < p.width:
        return pa.RecordBatch.from_pylist([], RUNS)
    sums = hasher.sums(data)
    start = np.arange(len(data) - p.gram + 1)
    grams = hasher.of(sums, start, start + p.gram)
    place = np.uint64((1 << int(len(data)).bit_length()) - 1)
    anchor = (window_minima((grams & ~place) | start.astype(np.uint64), p.width - p.gram + 1) & place).astype(np.int64)
    inside = np.zeros(len(data) + 1, np.int32)                 # windows that lie in one piece
    whole = sizes >= p.width
    np.add.at(inside, begins[whole], 1)
    np.add.at(inside, (begins + sizes - p.width + 1)[whole], -1)
    windows = np.flatnonzero(np.cumsum(inside)[:len(anchor)])
    if not len(windows):
        return pa.RecordBatch.from_pylist([], RUNS)
    cut = np.flatnonzero((np.diff(anchor[windows]) != 0) | (np.diff(windows) != 1)) + 1
    lo, hi = windows[np.concatenate([[0], cut])], windows[np.concatenate([cut, [len(windows)]]) - 1]
    at = anchor[lo]
    run = mix(hasher.of(sums, lo, hi + p.width) ^ mix(((hi - lo) << 20 | at - lo).astype(np.uint64)))
    piece = np.searchsorted(begins, lo, "right") - 1
    refs = np.array([r for r, *_ in texts], np.int64)
    shift = np.array([o for _, o, _ in texts], np.int64)[piece] - begins[piece]
    columns = [grams[at].view(np.int64), run.view(np.int64), refs[piece], lo + shift, hi + shift, at + shift,
               np.zeros(len(lo)), np.full(len(lo), p.width - p.gram)]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(columns, RUNS)], schema=RUNS)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    """(ref, text) of a batch, one text in memory at a time."""
    texts = batch.column("text").cast(pa.large_binary())
    for i, ref in enumerate(batch.column("ref").to_numpy()):
        yield int(ref), texts[i].as_py()


def corpus_runs(numbered: DataFrame, p: RepeatParams) -> DataFrame:
    """The runs of all windows of all texts."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(2 * p.piece + p.width)
        held, size = [], 0
        for batch in batches:
            for ref, text in _texts(batch):
                for offset in range(0, max(1, len(text) - p.width + 1), p.piece):
                    piece = text[offset:offset + p.piece + p.width - 1]
                    if len(piece) < p.width:
                        continue
                    if size + len(piece) > 2 * p.piece:
                        yield runs_of(held, p, hasher)
                        held, size = [], 0
                    held.append((ref, offset, piece))
                    size += len(piece)
        if held:
            yield runs_of(held, p, hasher)

    return numbered.select("ref", "text").mapInArrow(find, RUN_TYPES)


#: Rows of one file of the numbered documents are told by the high bits of ``ref`` (the task that wrote it).
PART_BITS = 33


def number_documents(documents: DataFrame) -> DataFrame:
    """``ref, doc_id, text``, written; ``ref`` numbers the rows."""
    text = F.coalesce("text", F.lit(""))
    return written(documents.select(F.monotonically_increasing_id().alias("ref"), "doc_id", text.alias("text")), "repeat-documents")


def beside(rows: DataFrame, label: str) -> str:
    """Write narrow rows with a ``ref`` to a folder for each part of the numbered documents."""
    path = scratch_path(rows.sparkSession, label)
    part = F.shiftright("ref", PART_BITS)
    rows.withColumn("part", part).repartition("part").write.partitionBy("part").parquet(path)
    return path


class Beside:
    """Columns of the rows of one ``ref`` from a folder of ``beside``; one part is held at a time."""

    def __init__(self, path: str, width: int):
        self.path, self.width, self.part = path, width, None

    def of(self, ref: int) -> list[np.ndarray]:
        if ref >> PART_BITS != self.part:
            self.part = ref >> PART_BITS
            self.refs, self.columns = self._read()
        a, b = np.searchsorted(self.refs, (ref, ref + 1))
        return [c[a:b] for c in self.columns]

    def _read(self) -> tuple[np.ndarray, list[np.ndarray]]:
        store, folder = locate(f"{self.path}/part={self.part}")
        files = [f.path for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if f.base_name.startswith("part-")]
        if not files:
            return np.zeros(0, np.int64), [np.zeros(0, np.int64)] * self.width
        tables = []
        for path in files:
            with store.open_input_file(path) as f:
                tables.append(pq.ParquetFile(f).read())
        rows = pa.concat_tables(tables).sort_by("ref")
        return rows.column("ref").to_numpy(), [rows.column(c).to_numpy() for c in rows.column_names if c != "ref"]


def repeated_runs(runs: DataFrame) -> DataFrame:
    """The runs whose key occurs more than once, written."""
    keys = runs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return written(runs.join(written(keys, "repeat-keys"), "key", "left_semi"), "repeat-runs")


def homes(distinct: DataFrame, p: RepeatParams, block: int) -> tuple[DataFrame, DataFrame]:
    """The distinct runs with the home of their key (``home_ref``, ``home_at``), and which homes ``fits`` an array."""
    first = reduce_apart(distinct, ["key"], F.min(F.struct("ref", "lo")).alias("home"))
    placed = distinct.join(first, "key").withColumn("home_ref", F.col("home.ref")).withColumn(
        "home_at", F.floor(F.col("home.lo") / block)).drop("home")
    placed = written(placed, "repeat-homes")
    per_text = placed.groupBy("home_ref", "home_at", "ref").agg((F.sum(F.col("hi") - F.col("lo") + 1) + p.width).alias("bytes"))
    sizes = per_text.groupBy("home_ref", "home_at").agg((F.sum("bytes") <= p.most).alias("fits"))
    return placed, written(sizes, "repeat-sizes")


def refined(numbered: DataFrame, runs: DataFrame, p: RepeatParams) -> DataFrame:
    """Each run as the two runs of its nearer and its farther windows, under keys of their longer cores."""
    path = beside(runs.select("ref", "lo", "hi", "anchor", "near", "far"), "repeat-refine")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of, hasher = Beside(path, 5), Hasher(2 * p.width)
        for batch in batches:
            out = []
            for ref, text in _texts(batch):
                for lo, hi, anchor, near, far in zip(*(c.tolist() for c in rows_of.of(ref))):
                    middle = (near + far) // 2
                    for a, b in ((near, middle), (middle + 1, far)) if near < far else ((near, far),):
                        first, last = max(lo, anchor - b), min(hi, anchor - a)
                        if first > last:
                            continue
                        # The core lies in all windows that begin b to a bytes before the anchor.
                        ends = np.array([[anchor - a, anchor - b + p.width], [first, last + p.width]]) - first
                        sums = hasher.sums(np.frombuffer(text[first:last + p.width], np.uint8))
                        core, run = hasher.of(sums, ends[:, 0], ends[:, 1])
                        key, run = mix(np.array([core ^ mix(np.array([a << 20 | b], np.uint64))[0],
                                                 run ^ mix(np.array([last - first << 20 | anchor - first], np.uint64))[0]])).view(np.int64)
                        out.append((int(key), int(run), ref, first, last, anchor, a, b))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), RUNS)], schema=RUNS) if out \
                else pa.RecordBatch.from_pylist([], RUNS)

    return written(numbered.select("ref", "text").mapInArrow(split, RUN_TYPES), "repeat-refined")


REGION_TYPES = ("home_ref long, home_at long, text binary, keys array<long>, runs array<long>, "
                "los array<int>, his array<int>, ns array<long>")
REGIONS = pa.schema([("home_ref", pa.int64()), ("home_at", pa.int64()), ("text", pa.binary()), ("keys", pa.list_(pa.int64())),
                     ("runs", pa.list_(pa.int64())), ("los", pa.list_(pa.int32())), ("his", pa.list_(pa.int32())), ("ns", pa.list_(pa.int64()))])


def regions(numbered: DataFrame, placed: DataFrame, p: RepeatParams) -> DataFrame:
    """The text of the representatives: runs of one home whose windows adjoin are one region."""
    path = beside(placed.select("ref", "home_ref", "home_at", "lo", "hi", "key", "run", "n"), "repeat-regions")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of = Beside(path, 7)
        for batch in batches:
            out = []
            for ref, text in _texts(batch):
                rows = sorted(zip(*(c.tolist() for c in rows_of.of(ref))))
                for home, own in groupby(rows, key=lambda r: r[:2]):
                    joined: list[list[tuple]] = []
                    for row in own:
                        if joined and row[2] <= joined[-1][-1][3] + 1:
                            joined[-1].append(row)
                        else:
                            joined.append([row])
                    for part in joined:
                        begin = part[0][2]
                        _, _, los, his, keys, run_ids, ns = zip(*part)
                        out.append((*home, text[begin:his[-1] + p.width], keys, run_ids, [x - begin for x in los], [x - begin for x in his], ns))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), REGIONS)], schema=REGIONS)

    return numbered.select("ref", "text").mapInArrow(cut, REGION_TYPES)


def repeated_starts(texts: list[bytes], width: int) -> np.ndarray:
    """For texts joined by a separator each: which positions start a window that occurs at another position too."""
    data = b"\0".join(texts)
    symbols = np.frombuffer(data, np.uint8).astype(np.int64) + 1
    starts = np.zeros(len(data) + 1, bool)
    at = 0
    for text in texts:
        starts[at:at + len(text) - width + 1] = True
        at += len(text)
        if at < len(data):
            symbols[at] = 0
        at += 1
    repeated = np.zeros(len(data) + 1, bool)
    order = np.array(suffix_array(symbols.tolist()), np.int64)
    for a, b in pairwise(order[starts[order]].tolist()):
        if data[a:a + width] == data[b:b + width]:
            repeated[a] = repeated[b] = True
    return repeated


MARKS = pa.schema([("key", pa.int64()), ("run", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])


def marked_runs(cut: DataFrame, p: RepeatParams) -> DataFrame:
    """``key, run, first, last``: the repeated windows of every distinct run, counted from its first window."""
    def mark(rows: list[tuple]) -> pa.RecordBatch:
        repeated = repeated_starts([r[2] for r in rows], p.width).tobytes()
        out, at = [], 0
        for _, _, text, *runs in rows:
            for key, run, lo, hi, n in zip(*runs):
                if n > 1:
                    out.append((key, run, 0, hi - lo))
                    continue
                begin, end = at + lo, at + hi + 1
                first = repeated.find(1, begin, end)
                while first >= 0:
                    last = repeated.find(0, first, end)
                    last = end if last < 0 else last
                    out.append((key, run, first - begin, last - 1 - begin))
                    first = repeated.find(1, last, end)
            at += len(text) + 1
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), MARKS)], schema=MARKS) if out \
            else pa.RecordBatch.from_pylist([], MARKS)

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for k in range(0, len(batch), 256):
                for row in zip(*(c.to_pylist() for c in batch.slice(k, 256).columns)):
                    if row[:2] != last and size >= p.unit:
                        yield mark(held)
                        held, size = [], 0
                    last = row[:2]
                    held.append(row)
                    size += len(row[2])
        if held:
            yield mark(held)

    ordered = cut.repartition("home_ref", "home_at").sortWithinPartitions("home_ref", "home_at")
    return ordered.mapInArrow(arrays, "key long, run long, first int, last int")


def repeated_spans(numbered: DataFrame, p: RepeatParams = RepeatParams()) -> DataFrame:
    """``ref, start, end`` of repeated bytes of the numbered documents (spans may overlap), written."""
    runs, spans, level = written(corpus_runs(numbered, p), "repeat-all-runs"), None, 0
    while True:
        hits = repeated_runs(runs)
        first = F.min(F.struct("ref", "lo", "hi")).alias("r")
        distinct = written(hits.groupBy("key", "run").agg(F.count(F.lit(1)).alias("n"), first)
                           .select("key", "run", "n", "r.ref", "r.lo", "r.hi"), "repeat-distinct")
        placed, sizes = homes(distinct, p, p.block if level == 0 else 1)
        marks = written(marked_runs(regions(numbered, placed.join(sizes.where("fits"), ["home_ref", "home_at"]), p), p), "repeat-marks")
        found = hits.join(marks, ["key", "run"]).select(
            "ref", (F.col("lo") + F.col("first")).alias("start"), (F.col("lo") + F.col("last") + p.width).alias("end"))
        spans = found if spans is None else spans.unionByName(found)
        large = sizes.where(~F.col("fits"))
        if large.isEmpty():
            return spans
        keys = placed.join(large, ["home_ref", "home_at"]).select("key").distinct()
        rest = written(hits.join(written(keys, "repeat-large"), "key", "left_semi"), "repeat-rest")
        runs = rest if level == 0 else refined(numbered, rest, p)
        level += 1


def remove_spans(numbered: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (bytes that are left) of every document."""
    path = beside(spans, "repeat-spans")
    doc_id = numbered.schema["doc_id"]
    schema = StructType([doc_id, *[StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")], StructField("kept", BinaryType())])
    shape = to_arrow_schema(schema)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_of = Beside(path, 2)
        for batch in batches:
            facts, kept = [], []
            for ref, text in _texts(batch):
                start, end = rows_of.of(ref)
                start, end = merged(start, end)
                facts.append((len(text), int((end - start).sum()), len(start)))
                kept.append(b"".join(text[a:b] for a, b in zip([0, *end.tolist()], [*start.tolist(), len(text)])))
            columns = [batch.column("doc_id"), *zip(*facts), kept]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if not isinstance(c, pa.Array) else c.cast(f.type)
                                              for c, f in zip(columns, shape)], schema=shape)

    return numbered.mapInArrow(remove, schema)


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of spans that overlap or touch."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    opens = np.concatenate([[True], start[1:] > reach[:-1]])
    return start[opens], reach[np.concatenate([opens[1:], [True]])]


def remove_repeats(documents: DataFrame, p: RepeatParams = RepeatParams()) -> DataFrame:
    """Every document without the bytes of its repeated windows (see ``remove_spans``)."""
    numbered = number_documents(documents)
    return remove_spans(numbered, repeated_spans(numbered, p))
