"""Best-fit packing of documents into training sequences, under conflicts.

Documents are cut into pieces of at most ``capacity`` units. Full pieces are bins of their own; the
others are packed best-fit in decreasing length: bins are ordered by residual, and each carries a
bitmap of the sources that have used up their quota there and of the duplicate clusters it holds.
For a piece, the search takes the successor of its length among the residuals and goes on until it
finds the tightest bin whose bitmap does not conflict; only if there is none, a new bin opens.

The residuals are the leaves of a segment tree whose nodes hold the AND of the bitmaps below. A
subtree whose AND has a bit of the piece has no compatible bin and is left out as a whole, so the
search is exact and stays fast when thousands of bins hold the same cluster.

Packing runs in groups of about ``group_rows`` pieces that a hash deals out evenly, each group in one
task and on ids and lengths only; texts do not move. The number of groups follows the row count, so
a source or cluster with a third of all rows spreads over all groups, and every group has the same
bounded size. Every piece is placed; bins never mix groups.

Edge cases. Documents of length 0 (null or empty texts) take no room and are not packed: they have
one row with bin null. A null source is a source; a null cluster conflicts with nothing. Repeated
rows are documents of their own; as they share a cluster they never share a bin. Equal lengths are
taken in order of doc_id and piece. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import ascii_lower, space_words
from ferry.session import scratch_path


@dataclass(frozen=True)
class PackParams:
    capacity: int = 2048           # units of a bin
    per_source: int = 8            # pieces of one source in a bin
    group_rows: int = 20_000       # pieces packed together

    def __post_init__(self) -> None:
        if self.capacity < 1 or self.per_source < 1 or self.group_rows < 1:
            raise ValueError("capacity, per_source and group_rows must be positive")


class ResidualTree:
    """Bins by residual 1..capacity, with the AND of their bitmaps in every subtree."""

    def __init__(self, capacity: int) -> None:
        self.base = 1 << capacity.bit_length()
        self.tree = [-1] * (2 * self.base)                     # AND over no bins: every bit is set
        #: residual: bitmap: heap of the bins with that bitmap
        self.bins: list[dict[int, list[int]]] = [{} for _ in range(capacity + 1)]

    def put(self, residual: int, bin_no: int, bitmap: int) -> None:
        if residual:
            heapq.heappush(self.bins[residual].setdefault(bitmap, []), bin_no)
            # One more bin can only clear bits; where it clears none, it clears none further up.
            at = residual + self.base
            while at and self.tree[at] & bitmap != self.tree[at]:
                self.tree[at] &= bitmap
                at >>= 1

    def take(self, residual: int, bitmap: int) -> int:
        """Remove and return the first bin of the residual and bitmap."""
        heap = self.bins[residual][bitmap]
        bin_no = heapq.heappop(heap)
        if not heap:
            del self.bins[residual][bitmap]
            at, both = residual + self.base, -1
            for other in self.bins[residual]:
                both &= other
            self.tree[at] = both
            while at > 1:
                at >>= 1
                self.tree[at] = self.tree[2 * at] & self.tree[2 * at + 1]
        return bin_no

    def tightest(self, length: int, bits: int) -> tuple[int, int] | None:
        """(residual, bitmap) of the first bin with the least residual >= length and none of ``bits``.

        A subtree is closed if some bit is set in all its bins. An open leaf may still have a
        conflict in every bin, one with this bit, one with that; then the search goes on.
        """
        at = length + self.base
        while True:
            if not self.tree[at] & bits:
                if at < self.base:
                    at *= 2
                    continue
                fits = [(heap[0], bitmap) for bitmap, heap in self.bins[at - self.base].items() if not bitmap & bits]
                if fits:
                    return at - self.base, min(fits)[1]
            while at & 1:                                      # up until there is a right neighbour
                at >>= 1
            if not at:
                return None
            at += 1


def pack_group(pieces: list[tuple[int, int, int, int]], params: PackParams) -> list[tuple[int, int]]:
    """(bin, offset) of each piece (length, source, cluster, order), lengths 1..capacity-1.

    Sources and clusters are small numbers; a negative cluster conflicts with nothing.
    """
    often: dict[int, int] = {}
    for _, _, cluster, _ in pieces:
        often[cluster] = often.get(cluster, 0) + 1
    sources: dict[int, int] = {}
    clusters: dict[int, int] = {}
    for _, source, cluster, _ in pieces:                       # only clusters that recur need a bit
        sources.setdefault(source, len(sources))
        if cluster >= 0 and often[cluster] > 1:
            clusters.setdefault(cluster, len(clusters))
    tree, used, held = ResidualTree(params.capacity), [], {}
    out: list[tuple[int, int]] = [(0, 0)] * len(pieces)
    order = sorted(range(len(pieces)), key=lambda i: (-pieces[i][0], pieces[i][3]))
    for i in order:
        length, source, cluster, _ = pieces[i]
        source_bit = 1 << sources[source]
        cluster_bit = 1 << (len(sources) + clusters[cluster]) if cluster in clusters else 0
        found = tree.tightest(length, source_bit | cluster_bit)
        if found is None:
            residual, bin_no, bitmap = params.capacity, len(used), 0
            used.append(0)
        else:
            residual, bitmap = found
            bin_no = tree.take(residual, bitmap)
        out[i] = (bin_no, used[bin_no])
        used[bin_no] += length
        held[bin_no, source] = held.get((bin_no, source), 0) + 1
        bitmap |= cluster_bit | (source_bit if held[bin_no, source] >= params.per_source else 0)
        tree.put(residual - length, bin_no, bitmap)
    return out


PLACES = "doc_id long, row long, piece int, length int, bin string, offset int"


def word_length(text: Column) -> Column:
    """Words of a text plus one for the separator; 0 without words."""
    n = F.size(space_words(text))
    return F.when(n > 0, n + 1).otherwise(0)


def text_cluster(text: Column) -> Column:
    """Equal for texts of the same words, case folded; null without words."""
    words = space_words(ascii_lower(text))
    return F.when(F.size(words) > 0, F.xxhash64(words))


def pack_documents(docs: DataFrame, length: Column, cluster: Column, params: PackParams = PackParams()) -> DataFrame:
    """doc_id, row, piece, length, bin, offset for every piece of ``docs`` (doc_id, source, ...).

    ``row`` tells rows apart; ``bin`` is group-number, or the row and piece that fill it alone.
    """
    spark = docs.sparkSession
    thin_path = scratch_path(spark, "pack-lengths")
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("\0")).alias("source"),
                length.cast("long").alias("length"), cluster.cast("long").alias("cluster"),
                F.monotonically_increasing_id().alias("row")).write.parquet(thin_path)
    thin = spark.read.parquet(thin_path)
    room = params.capacity
    whole, tail = F.expr(f"length DIV {room}"), F.expr(f"length % {room}")
    full = thin.where(F.col("length") >= room).select("doc_id", "row", "source", "cluster", F.explode(
        F.sequence(F.lit(0).cast("long"), whole - 1)).alias("piece"), F.lit(room).alias("length"))
    done = full.select("doc_id", "row", F.col("piece").cast("int").alias("piece"), "length",
                       F.concat(F.lit("r"), "row", F.lit("-"), "piece").alias("bin"), F.lit(0).alias("offset"))
    empty = thin.where("length = 0 OR length IS NULL").select(
        "doc_id", "row", F.lit(0).alias("piece"), F.lit(0).alias("length"), F.lit(None).cast("string").alias("bin"),
        F.lit(0).alias("offset"))
    open_pieces = thin.where(tail > 0).select(
        "doc_id", "row", "source", "cluster", whole.cast("int").alias("piece"), tail.cast("int").alias("length"))
    groups = max(1, -(-open_pieces.count() // params.group_rows))
    dealt = open_pieces.withColumn("g", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != key and rows:
                    yield _packed(key, rows, params)
                    rows = []
                key = row[0]
                rows.append(row)
        if rows:
            yield _packed(key, rows, params)

    grouped = dealt.select("g", "doc_id", "row", "source", "cluster", "piece", "length").repartition("g").sortWithinPartitions("g")
    return grouped.mapInArrow(pack, PLACES).unionByName(done).unionByName(empty)


def _packed(group: int, rows: list[tuple], params: PackParams) -> pa.RecordBatch:
    # Ties in length go by doc_id (nulls first), piece and row, so the result does not depend on arrival.
    rows.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[5], r[2]))
    names: dict = {}
    pieces = [(r[6], names.setdefault(("s", r[3]), len(names)),
               -1 if r[4] is None else names.setdefault(("c", r[4]), len(names)), k) for k, r in enumerate(rows)]
    places = pack_group(pieces, params)
    columns = (
        pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
        pa.array([r[5] for r in rows], pa.int32()), pa.array([r[6] for r in rows], pa.int32()),
        pa.array([f"{group}-{b}" for b, _ in places], pa.string()), pa.array([o for _, o in places], pa.int32()))
    return pa.RecordBatch.from_arrays(list(columns), ["doc_id", "row", "piece", "length", "bin", "offset"])
