"""N-gram Jaccard join: exact links between word-shingle sets, by T-occurrence search.

Two documents link when the Jaccard similarity of their shingle sets reaches ``percent`` %. All links
between different texts are found or implied: the result is a component per document.

1. *Sets.* One scan hashes each whole text's words (NumPy over UTF-8) to its set of 64-bit shingles.
   Documents with equal sets form a class; from here on a class is one set, whatever its copies.
2. *Routing.* Sets that link differ in few shingles: in k at most, for sizes in a given range. Cut the
   hash space into more than k parts, and some part must be equal in both. So each set gets a key
   per part, and sets that share a key meet in the bucket of that key's smallest set (its pivot).
   Most keys occur once. Which occur twice is found first, from key hashes alone, sorted and packed to
   three or four bytes; a sieve of these keeps the other keys from moving with their sets. Texts with
   equal sets bring their keys once (a few more where ids repeat, are null or agree in a hash).
   Keys hold six or more shingles on average, so unrelated documents with a common passage hardly
   ever meet. Key counts are combined before the shuffle; a hot key has one row per map task.
3. *Sketches.* A bucket is cut into blocks of ``BLOCK_SHINGLES``, each with a copy of the pivot. Sets
   come to their block as parity sketches first, of one to two bits a shingle. Two sketches differ in
   no more bits than their sets in shingles, so sets too far from all others of the block drop out
   before their texts move, and none that links does.
4. *Search.* In a block, sets that link to the pivot join its component at once, by probing. All others are
   queries of a T-occurrence search by DivideSkip over the block's inverted index: the longest
   lists are set aside, the short ones are heap-merged with skipping, and candidates that reach the
   rest of the threshold are probed in the long lists by binary search. Sets that are in one
   component already need no further proof.
5. *Rest.* In buckets of several blocks, sets outside the pivot's component are searched against all
   blocks of the bucket too, sketches first. So no pair that could link is left out, and a group of near copies
   with a third of all rows costs one probe per row, not a pair per pair.
6. *Components* of the found links by alternating large-star and small-star steps.

Edge cases. A text with fewer words than a shingle is one shingle; without words (or null) it has an
empty set, links with nothing and is its own component. Null doc_ids never name a component that
has another id; a component of null ids only has a null id. Repeated rows are copies. Extra columns
are ignored; an empty table gives an empty result. Sets are compared by 64-bit hashes of shingles
and 128-bit hashes of sets.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import dataset
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ferry.llm.common import broadcast_up_to, fresh_name, written
from ferry.llm.files import locate
from ferry.llm.words import SPACE_TABLE, column_words, mix
from ferry.session import scratch_path

#: Shingles of a block, pivot not counted: what one search holds in memory.
BLOCK_SHINGLES = 200_000
#: DivideSkip's weight of a probe against a step of the merge.
PROBE_WEIGHT = 0.0085


@dataclass(frozen=True)
class JoinParams:
    words: int = 3
    percent: int = 90              # least similarity; 50 to 99

    def __post_init__(self) -> None:
        if self.words < 1 or not 50 <= self.percent <= 99:
            raise ValueError("words must be positive and percent lie between 50 and 99")

    def least_overlap(self, a: int, b: int) -> int:
        """100 * overlap >= percent * union."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def largest_partner(self, a: int) -> int:
        return 100 * a // self.percent

    def least_partner(self, a: int) -> int:
        """Also the least overlap with any partner."""
        return -(-self.percent * a // 100)


# --- sets -----------------------------------------------------------------------------------

_MULTIPLIERS = np.random.default_rng(31_013).integers(1, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = np.uint64(0x5851F42D4C957F2D)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a word sequence."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    if n < size:
        total = np.full(1, n, np.uint64) * _SHORT
        for j in range(n):
            total = total + mix(words[j:j + 1]) * _MULTIPLIERS[(j + 32) % 64]
        return mix(total)
    total = words[:n - size + 1] * _MULTIPLIERS[0]
    for j in range(1, size):
        total = total + words[j:n - size + 1 + j] * _MULTIPLIERS[j % 64]
    return np.unique(mix(total))


def set_id(shingles: np.ndarray) -> bytes:
    """128 bits that tell sets apart; the first 8 bytes, as a big-endian signed number, route."""
    a = mix(shingles ^ _MULTIPLIERS[40]).sum(dtype=np.uint64)
    b = mix(shingles ^ _MULTIPLIERS[41]).sum(dtype=np.uint64)
    two = mix(np.array([a, b], np.uint64) + np.uint64(len(shingles)))
    return two.astype(">u8").tobytes()


def parity_sketch(shingles: np.ndarray) -> bytes:
    """A bit per residue of the shingles modulo the least power of two (64 or more) that is not below
    their number: whether an odd number of shingles has it. A shingle more or less flips one bit."""
    bits = max(64, 1 << max(0, len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def _number(cid: bytes) -> int:
    return int.from_bytes(cid[:8], "big", signed=True)


# --- routing keys ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Scheme:
    """How sets of sizes low..high, and their larger partners up to ``reach``, get their keys.

    They are cut into parts. Parts with fewer than ``strong`` shingles are weak; ``spare`` is how many
    parts there are beyond one and those that differing shingles can touch. With ``strong`` 0 the
    sets are too small for that: their least shingles are their keys.
    """

    low: int
    high: int
    reach: int
    spare: int
    strong: int
    bounds: np.ndarray


@lru_cache(maxsize=1024)
def size_range(number: int, params: JoinParams) -> tuple[int, int]:
    """Sizes of a scheme: ranges that grow by half, from the least size at which different sets can link."""
    low = -(-params.percent // (100 - params.percent))
    for _ in range(number):
        low = max(low, low * 3 // 2 - 1) + 1
    return low, max(low, low * 3 // 2 - 1)


def _weak_parts(low: int, parts: int, strong: int) -> float:
    """How many parts of a set of ``low`` shingles are weak, by Poisson with two deviations."""
    mean = low / parts
    share = np.exp(-mean) * (1 + mean if strong == 2 else 1)
    return parts * share + 2 * np.sqrt(parts * share)


@lru_cache(maxsize=256)
def scheme(number: int, params: JoinParams) -> Scheme:
    low, high = size_range(number, params)
    reach = params.largest_partner(high)
    most = (high + reach) * (100 - params.percent) // (100 + params.percent)       # differing shingles
    # Strong parts of two shingles if a few spare parts make up for the weak ones, else of one.
    for strong, limit in ((2, most // 4), (1, most // 2)):
        spare = bisect_left(range(limit + 1), True, key=lambda n: _weak_parts(low, most + 1 + n, strong) <= n)
        if spare <= limit:
            break
    else:
        spare = strong = 0
    parts = most + 1 + spare
    step = (1 << 64) / parts
    bounds = (np.arange(1, parts) * step).astype(np.uint64) if strong else np.zeros(0, np.uint64)
    return Scheme(low, high, reach, spare, strong, bounds)


def routing_keys(shingles: np.ndarray, params: JoinParams) -> np.ndarray:
    """Keys of which any two sets that link, and are not equal, have one in common.

    At least ``1 + spare`` parts of two linking sets are equal. Weak parts make keys that many sets
    share. A set with ``spare`` weak parts at most does without them, as one of the equal parts is
    then a strong one; the few sets with more use all their parts. Small sets use their least
    shingles, one more than a linking partner can lack.
    """
    n, keys, sums = len(shingles), [], None
    for number in range(200):
        low, high = size_range(number, params)
        if n < low:
            break
        if n > params.largest_partner(high):
            continue
        plan = scheme(number, params)
        salt = np.uint64(number << 40)
        if not plan.strong:
            keys.append(mix(shingles[:n - params.least_partner(n) + 1] + mix(np.array([salt]))))
            continue
        if sums is None:
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(mix(shingles ^ _MULTIPLIERS[42]), out=sums[1:])
        edges = np.empty(len(plan.bounds) + 2, np.int64)
        edges[0], edges[-1] = 0, n
        edges[1:-1] = np.searchsorted(shingles, plan.bounds)
        held = np.diff(edges)
        key = mix(np.diff(sums[edges]) + mix(salt + np.arange(len(held), dtype=np.uint64)))
        strong = held >= plan.strong
        keys.append(key[strong] if len(held) - strong.sum() <= plan.spare else key)
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


SETS = "doc_id long, n_shingles long, cid binary, fp long, sketch binary, text_hash long"
KEYS = "fp long, key long"


def _text_sets(column: pa.Array, params: JoinParams) -> Iterator[tuple[int, list[np.ndarray], list[bytes]]]:
    """Runs of texts as (first row, shingle sets, set ids)."""
    for row, counts, hashes in column_words(column, SPACE_TABLE):
        sets = [shingle_set(hashes[e - c:e], params.words) for c, e in zip(counts, np.cumsum(counts))]
        yield row, sets, [set_id(s) for s in sets]


def write_sets(docs: DataFrame, params: JoinParams) -> DataFrame:
    """doc_id, n_shingles, cid (class), fp (its routing number), sketch and text_hash of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets, ids in _text_sets(batch.column(1), params):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, len(ids)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(ids, pa.binary()), pa.array([_number(i) for i in ids], pa.int64()),
                    pa.array([parity_sketch(s) for s in sets], pa.binary()), batch.column(2).slice(row, len(ids))],
                    ["doc_id", "n_shingles", "cid", "fp", "sketch", "text_hash"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text"))
    return written(rows.mapInArrow(run, SETS), "shingle-sets")


def _marked_texts(docs: DataFrame) -> DataFrame:
    """A hash of each doc_id, for marks, and the text."""
    return docs.select(F.xxhash64(F.col("doc_id").cast("long")).alias("h"), F.coalesce("text", F.lit("")).alias("text"))


def _marked(batch: pa.RecordBatch, marks: str | None) -> pa.Array:
    """The second column of the rows whose hash, the first column, is marked."""
    if marks is None:
        return batch.column(1)
    return batch.column(1).filter(pa.array(passes(marks, batch.column(0).to_numpy().view(np.uint64))))


def key_rows(docs: DataFrame, params: JoinParams, sieve: str, marks: str | None = None) -> DataFrame:
    """(fp, key) of the routing keys of every document, or of the marked ones, that the sieve lets pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets, ids in _text_sets(_marked(batch, marks), params):
                keys = [routing_keys(s, params) for s in sets]
                owners = np.repeat(np.array([_number(i) for i in ids], np.int64), [len(k) for k in keys])
                flat = np.concatenate([np.zeros(0, np.uint64), *keys])
                kept = passes(sieve, flat)
                yield pa.RecordBatch.from_arrays([pa.array(owners[kept]), pa.array(flat[kept].view(np.int64))], ["fp", "key"])

    return _marked_texts(docs).mapInArrow(run, KEYS)


# --- keys that occur twice ------------------------------------------------------------------

#: Leading bits of a key that are counted, those of them that name a piece, and most bits that a sieve may use (64 MB).
COUNTED_BITS, PIECE_BITS, SIEVE_BITS = 40, 10, 29
#: Keys that a task holds before it packs them.
HELD_KEYS = 1 << 21


def pack(values: np.ndarray) -> bytes:
    """Ascending numbers as gaps of equal width; the first byte is the width."""
    gaps = np.diff(values, prepend=np.uint64(0))
    width = max(1, -(-int(gaps.max()).bit_length() // 8))
    return bytes([width]) + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(packed: bytes) -> np.ndarray:
    narrow = np.frombuffer(packed, np.uint8, offset=1).reshape(-1, packed[0])
    gaps = np.zeros((len(narrow), 8), np.uint8)
    gaps[:, :packed[0]] = narrow
    return np.cumsum(gaps.view("<u8").ravel(), dtype=np.uint64)


def _packed_pieces(keys: list[np.ndarray]) -> pa.RecordBatch:
    """A row (piece, packed rest of the counted bits) per piece. A key has two entries at most: a hot key stays small."""
    rest = COUNTED_BITS - PIECE_BITS
    counted = np.sort(np.concatenate(keys) >> np.uint64(64 - COUNTED_BITS))
    kept = np.ones(len(counted), bool)
    kept[2:] = counted[2:] != counted[:-2]
    counted = counted[kept]
    parts = np.split(counted & np.uint64((1 << rest) - 1),
                     np.searchsorted(counted, np.arange(1, 1 << PIECE_BITS, dtype=np.uint64) << np.uint64(rest)))
    found = [k for k, part in enumerate(parts) if len(part)]
    return pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array([pack(parts[k]) for k in found], pa.binary())],
                                      ["piece", "packed"])


def write_sieve(docs: DataFrame, params: JoinParams, marks: str | None = None) -> str:
    """The folder of a table (piece, n, packed) of the counted bits that two routing keys or more have.

    Keys of several sets are among them, as are keys of copies (if all documents or several copies are marked) and a few
    that agree in the counted bits only: the exact grouping comes after the sieve.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for _, sets, _ in _text_sets(_marked(batch, marks), params):
                held += [routing_keys(s, params) for s in sets]
                n += sum(len(k) for k in held[-len(sets):])
                if n >= HELD_KEYS:
                    yield _packed_pieces(held)
                    held, n = [], 0
        if n:
            yield _packed_pieces(held)

    return _sieve_of(_marked_texts(docs).mapInArrow(count, PIECES), 2)


def write_marks(hashes: DataFrame) -> str:
    """The folder of a sieve that lets the hashes of a one-column table pass."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield _packed_pieces([batch.column(0).to_numpy().view(np.uint64)])

    return _sieve_of(hashes.mapInArrow(count, PIECES), 1)


PIECES = "piece int, packed binary"


def _sieve_of(pieces: DataFrame, least: int) -> str:
    """Write what occurs ``least`` times (1 or 2) or more."""
    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (piece,), rows in _groups(batches, 1):
            counted = np.sort(np.concatenate([unpack(r[1]) for r in rows]))
            found = np.unique(counted[least - 1:][counted[least - 1:] == counted[:len(counted) - least + 1]])
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([len(found)], pa.int64()),
                                                  pa.array([pack(found)], pa.binary())], ["piece", "n", "packed"])

    path = scratch_path(pieces.sparkSession, "sieve")
    dealt = pieces.repartition("piece").sortWithinPartitions("piece").select("piece", "packed")
    dealt.mapInArrow(often, "piece int, n long, packed binary").write.parquet(path)
    return path


@lru_cache(maxsize=2)
def read_sieve(path: str) -> tuple[int, np.ndarray]:
    """Bits used and a bit table, of 32 bits or more per entry as long as ``SIEVE_BITS`` allow."""
    store, place = locate(path)
    rows = dataset.dataset(place, filesystem=store, format="parquet").to_table().to_pylist()
    bits = min(SIEVE_BITS, max(PIECE_BITS + 3, (32 * sum(r["n"] for r in rows)).bit_length()))
    table = np.zeros((1 << PIECE_BITS, 1 << (bits - PIECE_BITS - 3)), np.uint8)
    for row in rows:
        marked = np.zeros(1 << (bits - PIECE_BITS), bool)
        marked[unpack(row["packed"]) >> np.uint64(COUNTED_BITS - bits)] = True
        table[row["piece"]] = np.packbits(marked, bitorder="little")
    return bits, table.ravel()


def passes(sieve: str, keys: np.ndarray) -> np.ndarray:
    """Which keys may occur twice: all that do, and a few others."""
    bits, table = read_sieve(sieve)
    at = keys >> np.uint64(64 - bits)
    return (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


# --- sketches of a block --------------------------------------------------------------------

#: Words of sketches that are compared at a time.
COMPARED_WORDS = 1 << 21


def linkable(sizes: np.ndarray, sketches: list[bytes], params: JoinParams, labels: np.ndarray | None = None,
             asked: np.ndarray | None = None) -> np.ndarray:
    """Which sets may link with another one: all that do, and a few others.

    With ``labels`` and ``asked``, only pairs count that differ in their label and have an asked set.
    """
    kept, widths = np.zeros(len(sizes), bool), np.array([len(s) // 8 for s in sketches])
    for width in np.unique(widths).tolist():
        # A partner is at most twice as large, so its sketch at most twice as wide; it folds to this width.
        same, wide = np.flatnonzero(widths == width), np.flatnonzero(widths == 2 * width)
        same, wide = same[np.argsort(sizes[same], kind="stable")], wide[np.argsort(sizes[wide], kind="stable")]
        at, held = np.concatenate([same, wide]), np.empty((len(same) + len(wide), width), np.uint64)
        held[:len(same)] = np.frombuffer(b"".join(sketches[i] for i in same), "<u8").reshape(-1, width)
        if len(wide):
            both = np.frombuffer(b"".join(sketches[i] for i in wide), "<u8").reshape(-1, 2, width)
            held[len(same):] = both[:, 0] ^ both[:, 1]
        ascending = sizes[at]
        for n in np.unique(sizes[same]).tolist():
            first = int(np.searchsorted(ascending, n))
            last = int(np.searchsorted(ascending, params.largest_partner(n), "right"))
            ends = min(len(same), int(np.searchsorted(ascending, n, "right")))
            other = ascending[first:last]
            need = -(-params.percent * (n + other) // (100 + params.percent))
            most = n + other - 2 * need
            step = max(1, COMPARED_WORDS // ((last - first) * width))
            for a in range(first, ends, step):
                rows = np.arange(a, min(ends, a + step))
                differ = np.bitwise_count(held[rows][:, None] ^ held[None, first:last]).sum(axis=2, dtype=np.int32)
                near = differ <= most
                near[np.arange(len(rows)), rows - first] = False
                if labels is not None:
                    near &= labels[at[rows]][:, None] != labels[at[first:last]]
                    near &= asked[at[rows]][:, None] | asked[at[first:last]]
                kept[at[rows]] |= near.any(axis=1)
                kept[at[first:last]] |= near.any(axis=0)
    return kept


# --- search within a block ------------------------------------------------------------------

class InvertedIndex:
    """Ascending positions of the sets that hold each shingle, for the shingles of some queries.

    All lists stand one after another in ``keys``, as shingle number x sets + position: ascending as
    a whole, so a probe of any list is a binary search.
    """

    def __init__(self, sets: list[np.ndarray], wanted: np.ndarray) -> None:
        tokens = np.concatenate(sets)
        owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(wanted, tokens)
        at[at == len(wanted)] = 0
        known = wanted[at] == tokens
        self.wanted, self.n = wanted, len(sets)
        self.keys = np.sort(at[known] * self.n + owners[known])
        self.ends = np.searchsorted(self.keys, (np.arange(len(wanted)) + 1) * self.n)
        self.lengths = np.diff(self.ends, prepend=0)

    def numbers(self, query: np.ndarray) -> np.ndarray:
        """The shingle numbers of a query, shortest lists first."""
        at = np.searchsorted(self.wanted, query)
        return at[np.argsort(self.lengths[at], kind="stable")]

    def positions(self, k: int) -> np.ndarray:
        """The sets that hold shingle number ``k``."""
        return self.keys[self.ends[k] - self.lengths[k]:self.ends[k]] - k * self.n

    def count(self, numbers: np.ndarray) -> np.ndarray:
        """In how many of the shingles' lists each set stands, by going through the lists."""
        found = [self.positions(k) for k in numbers]
        return np.bincount(np.concatenate(found), minlength=self.n) if found else np.zeros(self.n, np.int64)

    def probe(self, numbers: np.ndarray, sets: np.ndarray) -> np.ndarray:
        """In how many of the shingles' lists each of ``sets`` stands, by binary search."""
        keys = (numbers[None, :] * self.n + sets[:, None]).ravel()
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return (self.keys[at] == keys).reshape(len(sets), len(numbers)).sum(axis=1)


def merge_skip(lists: list[list[int]], need: int) -> Iterator[tuple[int, int]]:
    """(value, count) of values in at least ``need`` of the ascending lists, by a heap that skips.

    If the smallest value occurs too rarely, ``need - 1`` lists are taken off the heap in all and
    jump, by binary search, to the smallest value that is left: nothing before can occur enough.
    """
    heap = [(values[0], k, 0) for k, values in enumerate(lists) if values]
    heapq.heapify(heap)
    while len(heap) >= need:
        value, taken = heap[0][0], []
        while heap and heap[0][0] == value:
            taken.append(heapq.heappop(heap))
        if len(taken) >= need:
            yield value, len(taken)
            target = value + 1
        else:
            while heap and len(taken) < need - 1:
                taken.append(heapq.heappop(heap))
            if not heap:
                return
            target = heap[0][0]
        for _, k, at in taken:
            at = bisect_left(lists[k], target, at)
            if at < len(lists[k]):
                heapq.heappush(heap, (lists[k][at], k, at))


def divide_skip(index: InvertedIndex, query: np.ndarray, need: int, open_sets: np.ndarray) -> Iterator[tuple[int, int]]:
    """(set, overlap) of the open sets that share ``need`` shingles or more with the query.

    Where the short lists are dense (more entries than sets), counting takes fewer steps than the
    heap; where candidates are so many that the steps of all probes outnumber the entries of the
    long lists, these are gone through instead. The result is the same.
    """
    numbers = index.numbers(query)
    # Lists of length 1 hold only the query.
    if len(numbers) < need or np.count_nonzero(index.lengths[numbers] > 1) < need:
        return
    longest = max(2, int(index.lengths[numbers[-1]]))
    aside = min(need - 1, int(need / (PROBE_WEIGHT * np.log2(longest) + 1)))
    short, long = numbers[:len(numbers) - aside], numbers[len(numbers) - aside:]
    if index.lengths[short].sum() <= index.n:
        lists = [[i for i in index.positions(k).tolist() if open_sets[i]] for k in short]
        found = list(merge_skip(lists, need - aside))
        sets, counts = np.array([i for i, _ in found], np.int64), np.array([c for _, c in found], np.int64)
    else:
        counts = index.count(short)
        sets = np.flatnonzero((counts >= need - aside) & open_sets)
        counts = counts[sets]
    if len(sets) * aside * np.log2(len(index.keys)) <= index.lengths[long].sum():
        total = counts + index.probe(long, sets)
    else:
        total = counts + index.count(long)[sets]
    for j in np.flatnonzero(total >= need):
        yield int(sets[j]), int(total[j])


class _Labels:
    """Components of a block: smaller sides are relabelled."""

    def __init__(self, labels: list) -> None:
        numbers: dict = {}
        self.of = np.array([numbers.setdefault(x, len(numbers)) for x in labels], np.int64)
        self.members: dict[int, list[int]] = {}
        for i, label in enumerate(self.of.tolist()):
            self.members.setdefault(label, []).append(i)

    def join(self, i: int, j: int) -> bool:
        a, b = int(self.of[i]), int(self.of[j])
        if a == b:
            return False
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        self.of[self.members[b]] = a
        self.members[a] += self.members.pop(b)
        return True


def search_block(sets: list[np.ndarray], labels: list, queries: list[int], params: JoinParams,
                 settled: list[int] = ()) -> list[tuple[int, int]]:
    """Links (i, j) that join all components of the block which a link of a query joins.

    ``settled`` sets have been compared with all others already.
    """
    known, links = _Labels(labels), []
    if not queries or len(sets) - len(settled) < 2:
        return links
    unsettled = np.ones(len(sets), bool)
    unsettled[list(settled)] = False
    index = InvertedIndex(sets, np.unique(np.concatenate([sets[q] for q in queries])))
    sizes = np.array([len(s) for s in sets])
    for q in queries:
        n = int(sizes[q])
        low, high = params.least_partner(n), params.largest_partner(n)
        open_sets = unsettled & (known.of != known.of[q]) & (sizes >= low) & (sizes <= high)
        if not open_sets.any():
            continue
        for i, overlap in divide_skip(index, sets[q], params.least_overlap(n, low), open_sets):
            if overlap >= params.least_overlap(n, int(sizes[i])) and known.join(q, i):
                links.append((q, i))
    return links


def probe_pivot(sets: list[np.ndarray], pivot: int, params: JoinParams) -> list[int]:
    """The sets that link to the pivot, by looking all their shingles up in it."""
    tokens = np.concatenate(sets)
    sizes = np.array([len(s) for s in sets])
    at = np.searchsorted(sets[pivot], tokens)
    at[at == len(sets[pivot])] = 0
    hits = np.concatenate([[0], np.cumsum(sets[pivot][at] == tokens)])
    ends = np.cumsum(sizes)
    overlap = hits[ends] - hits[ends - sizes]
    linked = overlap * (100 + params.percent) >= params.percent * (sizes + sizes[pivot])
    return [i for i in np.flatnonzero(linked).tolist() if i != pivot]


def link_block(ids: list[bytes], sets: list[np.ndarray], pivots: list[int], params: JoinParams) -> list[tuple[bytes, bytes]]:
    """(set, least set of its component) for each component of the block's link graph."""
    known = _Labels(list(range(len(ids))))
    for p in pivots:
        for i in probe_pivot(sets, p, params):
            known.join(p, i)
    main = {int(known.of[p]) for p in pivots}
    queries = [i for i in range(len(ids)) if int(known.of[i]) not in main]
    for a, b in search_block(sets, known.of.tolist(), queries, params, pivots):
        known.join(a, b)
    stars = []
    for members in known.members.values():
        root = min(ids[i] for i in members)
        stars += [(ids[i], root) for i in members if ids[i] != root]
    return stars


# --- blocks over the cluster ----------------------------------------------------------------

LINKS = "cid binary, other binary"
PLACED = "pivot long, salt long, fp long, blocks long"
ASKED = "pivot long, salt long, chunk long, fp long, comp binary, query boolean"
#: Rows that a task gathers before it passes them on.
GATHERED = 10_000


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal first ``keys`` columns, of sorted input, across batches."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row)
    if rows:
        yield key, rows


def _set_of(text: str, params: JoinParams) -> np.ndarray:
    from ferry.llm.words import hash_bytes

    return shingle_set(hash_bytes(np.frombuffer(text.encode(), np.uint8), SPACE_TABLE), params.words)


def _blocks(placed: DataFrame, docs: DataFrame, classes: DataFrame, keys: list[str], extra: list[str]) -> DataFrame:
    """The texts of the placed sets, sorted by block. ``placed`` has the block's keys, fp, and ``extra``."""
    named = written(placed.join(classes.select("fp", F.col("rep").alias("r"), F.col("cid").alias("want")), "fp"), "placed")
    marks = write_marks(named.select(F.xxhash64("r")).distinct())

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = pa.array(passes(marks, batch.column(0).to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays([c.filter(kept) for c in batch.columns[1:]], ["rep", "text"])

    rep = F.col("doc_id").cast("long")
    # Texts of documents that stand for no placed set stay where they are.
    texts = docs.select(F.xxhash64(rep).alias("h"), rep.alias("rep"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        marked, "rep long, text string")
    rows = named.join(texts, F.col("r").eqNullSafe(F.col("rep")))
    return rows.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "want", "text", *extra)


def _unique_sets(rows: list[tuple], at: int, params: JoinParams) -> tuple[list[bytes], list[np.ndarray], list[tuple]]:
    """Sets by class. A doc_id on several rows brings all their texts; only the wanted class counts."""
    found: dict[bytes, tuple[np.ndarray, tuple]] = {}
    for row in rows:
        want = bytes(row[at])
        if want not in found:
            shingles = _set_of(row[at + 1], params)
            if set_id(shingles) == want:
                found[want] = (shingles, row)
    return list(found), [s for s, _ in found.values()], [r for _, r in found.values()]


def _linkable_rows(placed: DataFrame, classes: DataFrame, keys: list[str], schema: str, params: JoinParams) -> DataFrame:
    """The rows of ``placed`` whose set may link with another one of its block (in ``ASKED``, one of another component,
    and one of the two a query), by sketches."""
    columns = [c.split(" ")[0] for c in schema.split(", ")]
    judged = "query" in columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types, gathered = None, []

        def gather() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*gathered), types)], columns)

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal types
            for batch in batches:
                types = types or batch.schema.types[:len(columns)]
                yield batch

        for _, rows in _groups(seen(), len(keys)):
            if len(rows) < 2:
                continue
            labels = asked = None
            if judged:
                numbers: dict = {}
                labels = np.array([numbers.setdefault(r[-4], len(numbers)) for r in rows])
                asked = np.array([r[-3] for r in rows], bool)
            kept = linkable(np.array([r[-2] for r in rows]), [r[-1] for r in rows], params, labels, asked)
            gathered += [rows[i][:len(columns)] for i in np.flatnonzero(kept)]
            if len(gathered) >= GATHERED:
                yield gather()
                gathered = []
        if gathered:
            yield gather()

    rows = placed.join(classes.select("fp", "n_shingles", "sketch"), "fp")
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys).select(*columns, "n_shingles", "sketch")
    return dealt.mapInArrow(run, schema)


def _search_buckets(placed: DataFrame, docs: DataFrame, classes: DataFrame, params: JoinParams) -> DataFrame:
    """Links within blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (pivot, _), rows in _groups(batches, 2):
            ids, sets, _ = _unique_sets(rows, 2, params)
            pivots = [i for i, c in enumerate(ids) if _number(c) == pivot]
            links = link_block(ids, sets, pivots, params) if len(ids) > 1 else []
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*links)], ["cid", "other"])

    near = _linkable_rows(placed, classes, ["pivot", "salt"], PLACED, params)
    return _blocks(near, docs, classes, ["pivot", "salt"], []).mapInArrow(run, LINKS)


def _search_rest(placed: DataFrame, docs: DataFrame, classes: DataFrame, params: JoinParams) -> DataFrame:
    """Links of the queries of split buckets against each block of their bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, 3):
            ids, sets, kept = _unique_sets(rows, 3, params)
            asked = {bytes(r[3]) for r in rows if r[6]}
            queries = [i for i, c in enumerate(ids) if c in asked]
            links = search_block(sets, [bytes(r[5]) for r in kept], queries, params)
            if links:
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[a] for a, _ in links], pa.binary()),
                    pa.array([ids[b] for _, b in links], pa.binary())], ["cid", "other"])

    keys = ["pivot", "salt", "chunk"]
    near = _linkable_rows(placed, classes, keys, ASKED, params)
    return _blocks(near, docs, classes, keys, ["comp", "query"]).mapInArrow(run, LINKS)


def bucket_members(docs: DataFrame, classes: DataFrame, params: JoinParams) -> DataFrame:
    """(pivot, fp) of all sets that share a routing key with another set, by the least of these sets."""
    marks = write_marks(classes.select(F.xxhash64("rep")))
    posts = written(key_rows(docs, params, write_sieve(docs, params, marks), marks), "posts")
    shared = written(posts.groupBy("key").agg(F.min("fp").alias("pivot"), F.max("fp").alias("last"), F.count(F.lit(1)).alias("n"))
                      .where(F.col("pivot") < F.col("last")), "shared-keys")
    # A key on two rows is known by its least and its greatest set; rows of the others move once more.
    pairs = shared.where("n = 2").select("pivot", F.explode(F.array("pivot", "last")).alias("fp"))
    several = shared.where("n > 2").select("key", "pivot")
    wanted = write_marks(several.select("key"))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(wanted, batch.column(1).to_numpy().view(np.uint64))))

    rest = written(posts.mapInArrow(marked, KEYS), "several").join(several, "key").select("pivot", "fp")
    return written(pairs.unionByName(rest).distinct(), "buckets")


def find_links(docs: DataFrame, classes: DataFrame, params: JoinParams) -> DataFrame:
    """Links (cid, other) between classes that connect every component of the link graph."""
    members = bucket_members(docs, classes, params)
    sized = members.join(classes.select("fp", "n_shingles"), "fp")
    blocks = written(sized.groupBy("pivot").agg(
        F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).alias("blocks")), "bucket-sizes")
    # A pivot goes to all blocks of its bucket, any other set to one.
    own = F.array(F.pmod(F.xxhash64("fp"), "blocks"))
    salts = F.when(F.col("fp") == F.col("pivot"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(own)
    bucketed = members.join(blocks, "pivot")
    placed = bucketed.select("pivot", "fp", "blocks", F.explode(salts).alias("salt"))
    links = written(_search_buckets(placed, docs, classes, params), "links")

    # The sets of buckets of several blocks, each with its pivot's class.
    large = written(bucketed.where("blocks > 1").select("pivot", "fp"), "split-buckets")
    if large.isEmpty():
        return links
    own_cid = large.join(classes.select("fp", "cid"), "fp")
    pivots = own_cid.where(F.col("fp") == F.col("pivot")).groupBy("pivot").agg(F.min("cid").alias("other"))
    split = own_cid.join(pivots, "pivot").select("pivot", "cid", "other")
    labels = written(components(links), "labels")
    comp = split.join(labels, "cid", "left").select(
        "pivot", "cid", F.col("other"), F.coalesce("root", "cid").alias("comp"))
    heads = labels.select(F.col("cid").alias("other"), F.col("root").alias("pivot_root"))
    judged = written(comp.join(heads, "other", "left").select(
        "pivot", "cid", "comp", (F.col("comp") != F.coalesce("pivot_root", "other")).alias("query")).distinct(), "split")
    asked = judged.where("query").join(classes.select("cid", "n_shingles"), "cid").groupBy("pivot").agg(
        F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).alias("chunks"))
    if asked.isEmpty():
        return links
    todo = judged.join(blocks, "pivot").join(asked, "pivot").join(classes.select("cid", "fp"), "cid")
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    own_chunk = F.pmod(F.xxhash64("cid"), "chunks")
    own_salt = F.pmod(F.xxhash64("fp"), "blocks")
    asking = todo.where("query").select("pivot", "fp", "comp", "query", own_chunk.alias("chunk"), F.explode(every).alias("salt"))
    asked_of = todo.where(~F.col("query")).select(
        "pivot", "fp", "comp", "query", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
        own_salt.alias("salt"))
    # Queries are asked of each other as well: all chunks of a bucket meet all chunks.
    among = todo.where("query").select(
        "pivot", "fp", "comp", F.lit(False).alias("query"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), own_salt.alias("salt"))
    rest = asking.unionByName(asked_of).unionByName(among)
    return links.unionByName(written(_search_rest(rest, docs, classes, params), "more-links"))


def components(links: DataFrame) -> DataFrame:
    """cid, root (the least cid of its component) for every class with a link.

    Alternates large-star and small-star steps until every class points at its root. Neighbours are
    never collected: each step is a minimum per class, map-side combined, and a join that Spark can
    split. Each round is written, so a lost executor costs no earlier round.
    """
    edges = written(links.select(F.greatest("cid", "other").alias("u"), F.least("cid", "other").alias("v"))
                     .where(F.col("u") != F.col("v")).distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "star")
        large = written(both.join(least, "u").where(F.col("v") > F.col("u"))
                         .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct(), "large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "star")
        small = large.join(least, "u").select("u", "v", "m")
        nxt = written(small.where(F.col("v") != F.col("m")).select(
            F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        # Done when every class has one edge and no root has an edge of its own.
        doubled = nxt.groupBy("u").count().where("count > 1").limit(1).count()
        chained = nxt.join(nxt.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
        edges = nxt
        if not doubled and not chained:
            break
    return edges.select(F.col("u").alias("cid"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("cid"), F.col("v").alias("root")).distinct())


def similarity_components(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """doc_id, n_shingles, component_id, text_hash, root for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id that links reach; ``root`` names the component also where
    ids repeat or are null, and is null for documents without words.
    """
    spark: SparkSession = docs.sparkSession
    sets = write_sets(docs, params)
    classes = written(sets.where("n_shingles > 0").groupBy("cid", "fp", "n_shingles", "sketch").agg(
        F.min("doc_id").alias("rep")), "classes")
    labels = written(components(find_links(docs, classes, params)), "labels")
    rooted = classes.join(labels, "cid", "left").select("cid", "rep", F.coalesce("root", "cid").alias("root"))
    roots = written(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "roots")
    answer = written(rooted.join(roots, "root").select("cid", "component_id", "root"), "answer")
    thin = sets.select("doc_id", "n_shingles", "cid", "text_hash")
    return thin.join(answer, "cid", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        .alias("component_id"), "text_hash", "root")


#: Rows of a drop list, 16 bytes each, that may be broadcast.
DROP_LIST = 1_000_000


def keep_one_per_component(docs: DataFrame, params: JoinParams = JoinParams()) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest doc_id stays.

    Ids that are null come last; equal ids are told apart by a hash of their text, and of rows equal
    in both, one stays. Documents without words all stay. The texts do not move unless the drop list
    is too long to broadcast.
    """
    found = written(similarity_components(docs, params).where(F.col("root").isNotNull()), "near-copies")
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    groups = found.groupBy("root").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    judged = found.join(written(groups, "first-copies"), "root").select("doc_id", "text_hash", (key == F.col("first")).alias("stays"))
    drop = written(judged.groupBy("doc_id", "text_hash").agg(
        F.first("stays").alias("stays"), F.count(F.lit(1)).alias("n")).where("NOT stays OR n > 1"), "drop-list")
    d, h, stays, place = (fresh_name(docs, name) for name in ("drop_id", "drop_hash", "stays", "place"))
    named = drop.select(F.col("doc_id").alias(d), F.col("text_hash").alias(h), F.col("stays").alias(stays))
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(d)) & (F.xxhash64(docs["text"]) == F.col(h))
    rest = docs.join(broadcast_up_to(named, DROP_LIST), same, "left_anti")
    repeated = named.where(F.col(stays))
    if repeated.isEmpty():
        return rest
    rank = F.row_number().over(Window.partitionBy(d, h).orderBy(F.lit(0)))
    one = docs.join(broadcast_up_to(repeated, DROP_LIST), same).withColumn(place, rank).where(F.col(place) == 1)
    return rest.unionByName(one.select(*[F.col(f"`{c}`") for c in docs.columns]))
