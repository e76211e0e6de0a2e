"""Benchmark decontamination by a distributed positional inverted index.

``build_index`` scans the documents once and stores, per segment of a few million words, the
postings of every term that a test item uses: for each term its ascending word positions, as PFOR
blocks of gaps, next to the segment's document table. A segment is one row of bounded size, so the
index is sharded by documents and searching it needs no shuffle. ``search_index`` opens one segment
at a time. For each window of test words it starts from the term that is rarest in the segment
and intersects the offset-adjusted lists of the next rarest terms by binary search until none is
left; what survives all terms is an exact phrase. With ``slop`` it also looks for proximity
matches: all terms of a window within ``slop`` words of the rarest one, in any order.

Test items are searched in blocks of at most ``BLOCK_WORDS`` words, so what a task gets has a
fixed bound whatever the number of items.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after folding A-Z, compared by 64-bit hashes. A
window is ``window`` consecutive item words; an item with fewer words, but not none, is one window.

Edge cases. Null and empty texts have no words and are never hit. Null item ids count as the empty
string; items of equal id count once. Positions of neighbouring documents lie further apart than
any match reaches, so no match crosses documents. Repeated documents are judged each by itself.
Null doc_ids stay null. Extra columns are ignored by the search; empty tables give no hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import broadcast_up_to, fresh_name, written
from ferry.llm.token_blocks import BLOCK, pack_block, unpack_block
from ferry.llm.words import ALNUM_TABLE, column_words, hash_bytes
from ferry.session import scratch_path

SEGMENT_WORDS = 4_000_000
SEGMENT_DOCS = 1 << 20
BLOCK_WORDS = 1_000_000
GAP = 64


@dataclass(frozen=True)
class SearchParams:
    window: int = 13
    slop: int = 16

    def __post_init__(self) -> None:
        if not 0 <= self.slop < GAP or self.window < 1:
            raise ValueError(f"slop must lie below {GAP}, window above 0")


class Items:
    """A block of test items: names, terms (sorted hashes) and windows as term numbers."""

    def __init__(self, rows: list[tuple[str, np.ndarray]], window: int) -> None:
        self.names = [name for name, _ in rows]
        self.terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *[w for _, w in rows]]))
        self.windows: list[tuple[int, int, np.ndarray]] = []   # item, offset in the item, terms
        for item, (_, words) in enumerate(rows):
            numbers = np.searchsorted(self.terms, words)
            if len(words):
                for at in range(max(1, len(words) - window + 1)):
                    self.windows.append((item, at, numbers[at:at + window]))


def item_blocks(benchmark: DataFrame, window: int) -> Iterator[Items]:
    """The test items (item_id, text) in blocks of bounded size, fetched one block at a time."""
    rows: list[tuple[str, np.ndarray]] = []
    size = 0
    ids = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")
    for row in benchmark.select(ids, F.coalesce("text", F.lit("")).alias("text")).toLocalIterator():
        words = hash_bytes(np.frombuffer(row.text.encode(), np.uint8), ALNUM_TABLE)
        if rows and size + len(words) > BLOCK_WORDS:
            yield Items(rows, window)
            rows, size = [], 0
        rows.append((row.item, words))
        size += len(words)
    yield Items(rows, window)


INDEX = ("segment long, doc_ids array<bigint>, doc_starts array<bigint>, doc_words array<bigint>, "
         "term_ends array<bigint>, postings binary, doc_rows array<bigint>")


def _pack(values: np.ndarray) -> bytes:
    return b"".join(pack_block(values[k:k + BLOCK]) for k in range(0, len(values), BLOCK))


def _unpack(data: bytes, n: int) -> np.ndarray:
    parts, at, got = [np.zeros(0, np.uint32)], 0, 0
    while got < n:
        values, at = unpack_block(data, at)
        parts.append(values)
        got += len(values)
    return np.concatenate(parts)


class _SegmentBuilder:
    def __init__(self, terms: np.ndarray) -> None:
        self.terms = terms
        self.doc_ids: list[int | None] = []
        self.rows: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.found: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.words = self.next = 0

    def add(self, doc_ids: list, counts: np.ndarray, hashes: np.ndarray, rows: np.ndarray | None = None) -> None:
        ends = np.cumsum(counts)
        starts = self.next + (ends - counts) + GAP * np.arange(len(counts))
        at = np.searchsorted(self.terms, hashes)
        at[at == len(self.terms)] = 0
        known = self.terms[at] == hashes if len(self.terms) else np.zeros(len(hashes), bool)
        place = np.arange(len(hashes)) + np.repeat(starts - (ends - counts), counts)
        self.doc_ids += doc_ids
        if rows is not None:
            self.rows.append(rows)
        self.counts.append(counts)
        self.found.append(at[known].astype(np.int32))
        self.places.append(place[known].astype(np.int64))
        self.words += len(hashes)
        self.next += int(ends[-1]) + GAP * len(counts)

    def finish(self, segment: int) -> pa.RecordBatch:
        counts = np.concatenate(self.counts)
        starts = np.cumsum(counts) - counts + GAP * np.arange(len(counts))
        found, places = np.concatenate(self.found), np.concatenate(self.places)
        order = np.argsort(found, kind="stable")               # places ascend already
        ends = np.searchsorted(found[order], np.arange(len(self.terms)), "right")
        gaps = places[order]
        begins = ends[:-1][np.diff(ends) > 0] if len(ends) else ends
        gaps[1:] = np.diff(gaps)
        gaps[begins] = places[order][begins]                   # each term's first position is whole
        first = (segment >> 32 << 40) + ((segment & 0xFFFFFFFF) << 24)
        rows = np.concatenate(self.rows) if self.rows else np.arange(first, first + len(counts))
        kinds = [pa.int64()] + [pa.list_(pa.int64())] * 4 + [pa.binary(), pa.list_(pa.int64())]
        row = [segment, self.doc_ids, starts, counts, ends, _pack(gaps.astype(np.uint32)), rows]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                          [f.split()[0] for f in INDEX.split(", ")])


def build_index(docs: DataFrame, terms: np.ndarray, path: str, segment_words: int = SEGMENT_WORDS,
                row: str | None = None) -> DataFrame:
    """Store the postings of ``terms`` over ``docs`` (doc_id, text) below ``path``.

    Documents have the number in their column ``row``, or, without one, numbers by their place in this scan.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(terms)               # BLOCK_WORDS terms at most

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        builder = _SegmentBuilder(shared.value)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = batch.column(2).to_numpy() if row else None
            for at, counts, hashes in column_words(batch.column(1), ALNUM_TABLE):
                here = slice(at, at + len(counts))
                builder.add(ids[here], counts, hashes, rows[here] if row else None)
                if builder.words >= segment_words or len(builder.doc_ids) >= SEGMENT_DOCS:
                    yield builder.finish(segment)
                    segment, builder = segment + 1, _SegmentBuilder(shared.value)
        if builder.doc_ids:
            yield builder.finish(segment)

    docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), *([row] if row else [])) \
        .mapInArrow(build, INDEX).write.parquet(path)
    return spark.read.parquet(path)


class Segment:
    """The opened postings of one index row."""

    def __init__(self, doc_starts: np.ndarray, term_ends: np.ndarray, postings: bytes) -> None:
        self.doc_starts, self.ends = doc_starts, term_ends
        self.counts = np.diff(term_ends, prepend=0)
        total = int(term_ends[-1]) if len(term_ends) else 0
        sums = np.cumsum(_unpack(postings, total).astype(np.int64))
        begins = (term_ends - self.counts)
        before = np.where(begins > 0, sums[np.maximum(begins - 1, 0)], 0) if total else np.zeros(len(term_ends), np.int64)
        self.places = sums - np.repeat(before, self.counts)

    def postings(self, term: int) -> np.ndarray:
        return self.places[self.ends[term] - self.counts[term]:self.ends[term]]

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Positions at which the terms stand next to each other, in order."""
        order = np.argsort(self.counts[terms], kind="stable")
        starts = self.postings(terms[order[0]]) - order[0]
        for k in order[1:]:
            if not len(starts):
                break
            places = self.postings(terms[k])
            at = np.searchsorted(places, starts + k)
            at[at == len(places)] = 0
            starts = starts[places[at] == starts + k]
        return starts

    def near(self, terms: np.ndarray, slop: int) -> np.ndarray:
        """Positions of the rarest term with all other terms at most ``slop`` words away."""
        terms = np.unique(terms)
        order = np.argsort(self.counts[terms], kind="stable")
        around = self.postings(terms[order[0]])
        for k in order[1:]:
            if not len(around):
                break
            places = self.postings(terms[k])
            at = np.searchsorted(places, around - slop)
            inside = at < len(places)
            inside[inside] &= places[at[inside]] <= around[inside] + slop
            around = around[inside]
        return around


MATCHES = ("row long, doc_id long, n_words long, "
           "spans array<struct<item:string,item_from:int,doc_from:bigint,words:int>>, near_items array<string>")


def _search(segment: Segment, items: Items, params: SearchParams) -> tuple[dict[int, list], dict[int, set]]:
    """Per document (by ordinal): exact spans, and the items with proximity matches."""
    spans: dict[int, list] = {}
    near: dict[int, set] = {}
    runs: dict[tuple[int, int], list] = {}                     # (item, alignment) -> its last span
    for item, at, terms in items.windows:
        if not segment.counts[terms].min(initial=1):
            continue
        for start in segment.phrase(terms).tolist():
            run = runs.get((item, start - at))
            if run is not None and run[1] + run[3] - len(terms) + 1 == at:
                run[3] += 1                                    # the next window of the same passage
                continue
            doc = int(np.searchsorted(segment.doc_starts, start, "right")) - 1
            run = [items.names[item], at, start - int(segment.doc_starts[doc]), len(terms)]
            runs[item, start - at] = run
            spans.setdefault(doc, []).append(run)
        if params.slop:
            found = segment.near(terms, params.slop)
            for doc in np.unique(np.searchsorted(segment.doc_starts, found, "right") - 1).tolist():
                near.setdefault(doc, set()).add(items.names[item])
    return spans, near


def search_index(index: DataFrame, items: Items, params: SearchParams = SearchParams()) -> DataFrame:
    """A row per indexed document: n_words, exact passages, and items with proximity matches.

    A passage is a maximal run of windows of one item at one place: ``words`` words of the document
    from ``doc_from`` on equal those of the item from ``item_from`` on. ``row`` tells rows apart.
    """
    shared = index.sparkSession.sparkContext.broadcast(items)
    names = [f.split()[0] for f in ("row", "doc_id", "n_words", "spans", "near_items")]
    span = pa.struct([("item", pa.string()), ("item_from", pa.int32()), ("doc_from", pa.int64()), ("words", pa.int32())])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(span), pa.list_(pa.string())]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                _, doc_ids, starts, words, ends, postings, rows = (c[k] for c in batch.columns)
                segment = Segment(starts.values.to_numpy(), ends.values.to_numpy(), postings.as_py())
                spans, near = _search(segment, shared.value, params)
                n = len(words)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((
                    rows.values, doc_ids.values, words.values,
                    [[tuple(s) for s in spans.get(i, ())] for i in range(n)],
                    [sorted(near.get(i, ())) for i in range(n)]), kinds)], names)

    return index.mapInArrow(search, MATCHES)


def find_passages(docs: DataFrame, benchmark: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """``search_index`` over all blocks of test items; the index of a block is written and searched.

    With more than one block, the documents are first written with a row number each. All blocks index
    that table and are merged by the stored number, so it does not matter how their scans cut the files.
    """
    spark = docs.sparkSession
    blocks = item_blocks(benchmark, params.window)
    block, following = next(blocks), next(blocks, None)
    row = None
    if following is not None:
        row = "row"
        docs = written(docs.select(
            "doc_id", "text", F.monotonically_increasing_id().alias(row)), "numbered")
    found = []
    while block is not None:
        index = build_index(docs, block.terms, scratch_path(spark, "postings"), row=row)
        found.append(search_index(index, block, params))
        block, following = following, next(blocks, None)
    if len(found) == 1:
        return found[0]
    together = found[0]
    for more in found[1:]:
        together = together.unionByName(more)
    return together.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("near_items")).alias("near_items"))


def contamination(passages: DataFrame) -> DataFrame:
    """Per document: words, hit words, items, their digest and the verdict 20 * n_hit >= n_words."""
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(
        s["doc_from"].alias("a"), (s["doc_from"] + s["words"]).alias("b"))))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    n_hit = F.aggregate(ordered, zero, lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(s["a"], acc["end"]))).alias("n"),
        F.greatest(acc["end"], s["b"]).alias("end")), lambda acc: acc["n"])
    items = F.sort_array(F.array_distinct(F.transform("spans", lambda s: s["item"])))
    exact = passages.select("row", "doc_id", "n_words", n_hit.alias("n_hit"), items.alias("items"),
                            F.size(F.array_distinct("near_items")).cast("long").alias("n_near_items"))
    return exact.select(
        "row", "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "n_near_items")


#: Rows of a drop list, 8 bytes each, that may be broadcast.
DROP_LIST = 1_000_000


def decontaminate(docs: DataFrame, benchmark: DataFrame, params: SearchParams = SearchParams(slop=0)) -> DataFrame:
    """The rows of ``docs`` (text, ...) that are not contaminated, columns unchanged.

    The verdict depends on the text alone, so texts are named by their hash. Texts do not move unless
    the drop list is too long to broadcast.
    """
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    bad = contamination(find_passages(texts, benchmark, params)).where("contaminated")
    name = fresh_name(docs, "drop_hash")
    drop = written(bad.select(F.col("doc_id").alias(name)).distinct(), "contaminated")
    return docs.join(broadcast_up_to(drop, DROP_LIST), F.xxhash64(docs["text"]) == F.col(name), "left_anti")
