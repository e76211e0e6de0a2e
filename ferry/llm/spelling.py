"""Spelling variants: words of a corpus that are one edit apart, and the frequent form each belongs to.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. The form of a
word is its most frequent near word, if that is ``ratio`` times as frequent; its root is the last word
reached by following forms.

Method. A word becomes a vector of letter-group counts. One edit adds at most one to one count
(surplus) and takes at most one from one count (deficit). The vectors of the stored words form a trie,
a level per group, a node per distinct prefix. A depth-first search carries (node, surplus spent,
deficit spent) for many words at once: at each level it follows the children whose count is equal, one
more or one less while that budget of one each lasts. Frontiers above a size are halved and searched one
after the other, so memory is bounded. The words of the leaves reached are verified by their longest
common prefix and suffix.

On Spark. Words are counted with map-side aggregation. The vocabulary is routed by the counts of a few
coarse letter groups: a word is stored in the block of its own coarse vector and searched for in this
block and in one half of the neighbouring vectors, so each pair of words meets in one block. The number
of coarse groups is the least whose blocks hold at most ``chunk`` words; blocks beyond that at the finest
routing are dealt out in chunks by hash, and every search goes to all of them. Tasks return the count
of near words and the best of them per word, never pairs.

Edge cases. Null and empty texts have no words; a null doc_id reads as an empty string in the hash.
Repeated documents count each time. Texts are handled whole, by the JVM's regular expressions;
words of any length count (beyond 64 letters they are verified one by one). Ties in frequency go to
the smallest word in code-point order. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import ascii_lower, written

LETTERS = "etaoinsrhldcumfpgwybvkxjqz"
#: Fine groups of the trie, each a level; accented letters form the last one.
FINE = ("e", "a", "i", "n", "o", "t", "r", "s", "l", "cu", "dm", "phg", "bvfwykxjqz")
#: Words up to this length are verified by matrices.
WIDE = 64
MOST = 1000


@dataclass(frozen=True)
class SpellingParams:
    """Least length and count of a word; a form is ``ratio`` times as frequent; words per block and
    searches of one frontier."""

    min_chars: int = 7
    min_count: int = 2
    ratio: int = 10
    chunk: int = 100_000
    frontier: int = 1 << 16


def corpus_words(documents: DataFrame, min_chars: int) -> DataFrame:
    """``word``: every run of letters, lower-cased; where 31 divides the crc32 of ``doc_id:run``, one
    code point of the run is left out (the planted misspellings). Runs too short to count are skipped."""
    runs = F.regexp_extract_all(F.col("text"), F.lit("[A-Za-zÀ-ÿ]{%d,}" % min_chars), F.lit(0))
    lower = documents.select("doc_id", F.explode(runs).alias("run")).withColumn("run", ascii_lower(F.col("run")))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    hashed = lower.select("run", F.crc32(F.encode(name, "UTF-8")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.expr("left(run, cast(h % length(run) as int))"), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= min_chars)


def vocabulary(words: DataFrame, min_count: int) -> DataFrame:
    """``word, n``, written."""
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)
    return written(counts, "vocabulary")


def coarse_counts(word: Column, groups: int) -> list[Column]:
    """How many letters of a word fall into each of ``groups`` letter sets; accented letters are in the last."""
    sets = [LETTERS[k::groups] for k in range(groups - 1)]
    counts = [F.length(word) - F.length(F.translate(word, letters, "")) for letters in sets]
    counts.append(reduce(lambda a, b: a - b, counts, F.length(word)))
    return [F.least(c, F.lit(MOST)).cast("long") for c in counts]


def neighbour_offsets(groups: int) -> list[tuple[int, ...]]:
    """Offsets between coarse vectors of near words, one of each pair v and -v, without zero."""
    units = [tuple(int(i == k) for i in range(groups)) for k in range(groups)]
    pairs = [tuple(int(i == a) - int(i == b) for i in range(groups)) for a in range(groups) for b in range(a + 1, groups)]
    return units + pairs


def packed(vector: list[Column]) -> Column:
    """A coarse vector as one number; counts beyond MOST count as MOST (a neighbour may have one more)."""
    return reduce(lambda a, b: a * (MOST + 2) + b, vector)


def routing(words: DataFrame, chunk: int) -> tuple[int, DataFrame]:
    """The number of coarse groups, and ``block, chunks`` for all blocks."""
    for groups in (3, 4, 5, 6):
        sizes = words.select(packed(coarse_counts(F.col("word"), groups)).alias("block")).groupBy("block").agg(
            F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
        sizes = written(sizes, "spelling-blocks")
        if (sizes.agg(F.max("chunks")).first()[0] or 0) <= 1:
            break
    return groups, sizes


def routed(words: DataFrame, p: SpellingParams) -> DataFrame:
    """``block, chunk, cross, word, n``: stored words (cross 0, searched too) and searches from other blocks (1)."""
    groups, sizes = routing(words, p.chunk)
    counts = coarse_counts(F.col("word"), groups)
    own = F.struct(packed(counts).alias("block"), F.lit(0).alias("cross"))
    others = []
    for offset in neighbour_offsets(groups):
        vector = [c + d if d else c for c, d in zip(counts, offset)]
        real = reduce(lambda a, b: a & b, [c >= 0 for c, d in zip(vector, offset) if d < 0], F.lit(True))
        others.append(F.when(real, F.struct(packed(vector).alias("block"), F.lit(1).alias("cross"))))
    rows = (words.select("word", "n", F.explode(F.array(own, *others)).alias("at")).where("at is not null")
            .select("word", "n", "at.block", "at.cross"))
    home = F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int")
    whole = F.sequence(F.lit(0), F.col("chunks") - 1)
    sent = rows.join(sizes, "block").withColumn("home", home)
    # In a block of several chunks a stored word is searched for in the other chunks as well.
    sent = sent.select("block", "word", "n", "cross", "home", F.explode(whole).alias("chunk")).where("cross = 1 OR chunk >= home")
    return sent.select("block", "chunk", F.when((F.col("cross") == 0) & (F.col("chunk") == F.col("home")), 0).otherwise(1).alias("cross"), "word", "n")


class Words:
    """Words of Arrow columns as flat Latin-1 codes, with their group counts."""

    def __init__(self, parts: list[tuple[int, pa.RecordBatch]]):
        self.words = pa.concat_arrays([b.column("word").cast(pa.string()) for _, b in parts])
        self.place = np.repeat([place for place, _ in parts], [len(b) for _, b in parts])
        self.n = np.concatenate([b.column("n").to_numpy() for _, b in parts])
        self.matrices: dict[tuple[int, bool], np.ndarray] = {}
        self.rank = np.empty(len(self.words), np.int64)        # in code-point order
        self.rank[pc.sort_indices(self.words).to_numpy()] = np.arange(len(self.words))
        data = np.frombuffer(_joined(self.words), np.uint8)
        lead = data == 0xC3                                    # first byte of U+00C0 to U+00FF
        codes = data.copy()
        codes[1:][lead[:-1]] += 0x40
        sizes = pc.binary_length(self.words).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        leads = np.concatenate([[0], np.cumsum(lead)])
        self.codes = codes[~lead]
        self.length = sizes - (leads[ends] - leads[ends - sizes])
        self.start = np.cumsum(self.length) - self.length
        row = np.repeat(np.arange(len(sizes)), self.length)
        self.counts = np.bincount(row * len(GROUPS) + GROUP_OF[self.codes], minlength=len(sizes) * len(GROUPS)).reshape(-1, len(GROUPS))

    def text(self, i: int) -> bytes:
        return self.codes[self.start[i]:self.start[i] + self.length[i]].tobytes()

    def matrix(self, width: int, from_end: bool) -> np.ndarray:
        """The first (or last, reversed) ``width`` codes of every word, filled up with 0; kept for the next call."""
        if (width, from_end) not in self.matrices:
            row = np.repeat(np.arange(len(self.length)), self.length)
            at = np.arange(len(self.codes)) - self.start[row]
            if from_end:
                at = self.length[row] - 1 - at
            out = np.zeros((len(self.length), width), np.uint8)
            fits = at < width
            out[row[fits], at[fits]] = self.codes[fits]
            self.matrices[width, from_end] = out
        return self.matrices[width, from_end]


GROUPS = (*FINE, "")
GROUP_OF = np.full(256, len(FINE), np.int64)
for _k, _letters in enumerate(FINE):
    GROUP_OF[[ord(c) for c in _letters]] = _k


def _joined(words: pa.Array) -> bytes:
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1]
    return data[int(ends[0]):int(ends[-1])].to_pybytes() if len(words) else b""


class Trie:
    """Stored words by their place and successive group counts."""

    def __init__(self, stored: Words):
        self.stored = stored
        self.places, node = np.unique(stored.place, return_inverse=True)
        self.stride = int(stored.counts.max(initial=0)) + 3    # counts are shifted by one; the ends stay free
        self.children = []                                     # per level: sorted (node, count); its index is the child
        for level in range(len(GROUPS)):
            keys, node = np.unique(node * self.stride + stored.counts[:, level] + 1, return_inverse=True)
            self.children.append(np.append(keys, [np.iinfo(np.int64).max] * 3))
        self.by_leaf = np.argsort(node, kind="stable")
        self.leaf_size = np.bincount(node)
        self.leaf_start = np.cumsum(self.leaf_size) - self.leaf_size

    def search(self, queries: Words, frontier: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query rows, stored rows) whose counts lie within a surplus and a deficit of one."""
        node = np.minimum(np.searchsorted(self.places, queries.place), len(self.places) - 1)
        query = np.flatnonzero(self.places[node] == queries.place)
        # Neighbours in the trie are searched for one after the other: their keys are close in memory.
        path = reduce(lambda a, level: a * 8 + np.minimum(queries.counts[query, level], 7), range(len(GROUPS)), node[query])
        query = query[np.argsort(path)]
        spent = np.zeros(len(query), np.int8)                  # 1: surplus, 2: deficit
        stack = [(0, query, node[query], spent)]
        while stack:
            level, query, node, spent = stack.pop()
            size = len(query) if level < len(GROUPS) else int(self.leaf_size[node].sum())
            if size > frontier and len(query) > 1:
                half = len(query) // 2
                stack += [(level, query[half:], node[half:], spent[half:]), (level, query[:half], node[:half], spent[:half])]
            elif level < len(GROUPS):
                stack.append((level + 1, *self._children(level, queries, query, node, spent)))
            elif size:
                reps = self.leaf_size[node]
                offset = np.arange(size) - np.repeat(np.cumsum(reps) - reps, reps)
                yield np.repeat(query, reps), self.by_leaf[np.repeat(self.leaf_start[node], reps) + offset]

    def _children(self, level: int, queries: Words, query: np.ndarray, node: np.ndarray, spent: np.ndarray):
        """The children with one less, equal or one more; they are neighbours in the sorted keys."""
        keys, count = self.children[level], queries.counts[query, level] + 1
        reach = np.flatnonzero(count < self.stride)
        query, spent, wanted = query[reach], spent[reach], node[reach] * self.stride + count[reach]
        less = np.searchsorted(keys, wanted - 1)
        has_less = keys[less] == wanted - 1
        equal = less + has_less
        has_equal = keys[equal] == wanted
        more = equal + has_equal
        found = []
        for child, hit, bit in ((less, has_less & (spent & 2 == 0), 2), (equal, has_equal, 0),
                                (more, (keys[more] == wanted + 1) & (spent & 1 == 0), 1)):
            hit = np.flatnonzero(hit)
            found.append((query[hit], child[hit], spent[hit] | bit))
        return tuple(np.concatenate(x) for x in zip(*found))


def verified(queries: Words, stored: Words, q: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Which pairs differ by exactly one edit: common prefix and suffix leave one code point at most."""
    longest = np.maximum(queries.length[q], stored.length[s])
    close = np.abs(queries.length[q] - stored.length[s]) <= 1
    near = np.zeros(len(q), bool)
    short = np.flatnonzero(close & (longest <= WIDE))
    width = int(min(WIDE, max(queries.length.max(initial=1), stored.length.max(initial=1))))
    for part in np.array_split(short, max(1, -(-len(short) // 50_000))):
        common = []
        for from_end in (False, True):
            differ = queries.matrix(width, from_end)[q[part]] != stored.matrix(width, from_end)[s[part]]
            first = differ.argmax(1)
            common.append(np.where(differ[np.arange(len(part)), first], first, width))
        near[part] = (common[0] < width) & (common[0] + common[1] >= longest[part] - 1)
    for i in np.flatnonzero(close & (longest > WIDE)):
        near[i] = one_edit(queries.text(q[i]), stored.text(s[i]))
    return near


def one_edit(a: bytes, b: bytes) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    least = min(len(a), len(b))
    k = next((i for i in range(least) if a[i] != b[i]), least)
    if len(a) == len(b):
        return a[k + 1:] == b[k + 1:]
    return a[k:] == b[k + 1:] if len(a) < len(b) else a[k + 1:] == b[k:]


NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def _best(target: np.ndarray, other: np.ndarray, targets: Words, others: Words) -> pa.RecordBatch:
    """Per target word: how many near words, and the one of largest n, then least in order."""
    order = np.lexsort((others.rank[other], -others.n[other], target))
    target, other = target[order], other[order]
    first = np.flatnonzero(np.diff(target, prepend=-1))
    counts = np.diff(np.append(first, len(target)))
    return pa.RecordBatch.from_arrays([targets.words.take(pa.array(target[first])), pa.array(counts), pa.array(others.n[other[first]]),
                                       others.words.take(pa.array(other[first]))], schema=NEAR)


class Search:
    """Places taken together: their stored words, and searches that wait for them."""

    def __init__(self, p: SpellingParams):
        self.p, self.trie = p, None
        self.stored: list[tuple[int, pa.RecordBatch]] = []
        self.waiting: list[tuple[int, pa.RecordBatch]] = []

    def full(self) -> bool:
        return self.trie is not None or sum(len(b) for _, b in self.stored) >= self.p.chunk

    def many_waiting(self) -> bool:
        return sum(len(b) for _, b in self.waiting) >= 2 * self.p.chunk

    def answers(self) -> Iterator[pa.RecordBatch]:
        """Answers to all that wait; the stored words are searched for among themselves the first time."""
        if self.stored and self.trie is None:
            self.trie = Trie(Words(self.stored))
            yield from self._near(self.trie.stored, False)
        if self.stored and self.waiting:
            yield from self._near(Words(self.waiting), True)
        self.waiting = []

    def _near(self, queries: Words, cross: bool) -> Iterator[pa.RecordBatch]:
        stored = self.trie.stored
        for q, s in self.trie.search(queries, self.p.frontier):
            near = verified(queries, stored, q, s)
            q, s = q[near], s[near]
            yield _best(q, s, queries, stored)
            if cross:
                yield _best(s, q, stored, queries)


def search_routed(batches: Iterator[pa.RecordBatch], p: SpellingParams) -> Iterator[pa.RecordBatch]:
    """Batches of ``block, chunk, cross, word, n``, sorted by the first three; a place is a chunk of a block.

    Small places are taken together; the searches of a place stream past its stored words.
    """
    unit, place, last = Search(p), 0, None
    for batch in batches:
        state = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("block", "chunk", "cross")])
        cuts = np.flatnonzero((state[:, 1:] != state[:, :-1]).any(0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, state.shape[1]]):
            if hi == lo:
                continue
            if (state[0, lo], state[1, lo]) != last:
                last, place = (state[0, lo], state[1, lo]), place + 1
                if unit.full():
                    yield from unit.answers()
                    unit = Search(p)
            part = batch.slice(lo, hi - lo)
            if state[2, lo]:
                unit.waiting.append((place, part))
                if unit.many_waiting():
                    yield from unit.answers()
            else:
                unit.stored.append((place, part))
    yield from unit.answers()


def near_words(words: DataFrame, p: SpellingParams = SpellingParams()) -> DataFrame:
    """``word, n_near, form_n, form`` of the words that have near words: how many, and the most frequent of them."""
    places = routed(words, p).repartition("block", "chunk").sortWithinPartitions("block", "chunk", "cross")
    parts = places.mapInArrow(lambda batches: search_routed(batches, p), "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("least"), "best"))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.least")).alias("form_n"), F.col("b.best").alias("form"))


def roots(forms: DataFrame, rounds: int) -> DataFrame:
    """``word, root``: the last word that is reached from ``word`` by following ``form``.

    Each round doubles the steps taken; ``2 ** rounds`` steps have to be enough.
    """
    at = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(rounds):
        then = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = written(at.join(then, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return at


def spelling_variants(words: DataFrame, p: SpellingParams = SpellingParams()) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a written vocabulary ``word, n``.

    Along a chain of forms the count grows by ``ratio``, so its length is at most the logarithm of the
    largest count.
    """
    near = written(near_words(words, p), "near-words")
    known = words.join(near, "word", "left")
    known = written(known.withColumn("leads", F.coalesce(F.col("form_n") >= p.ratio * F.col("n"), F.lit(False))), "spelling-forms")
    most = words.agg(F.max("n")).first()[0] or 1
    steps = 1 + int(math.log(most) / math.log(p.ratio)) if p.ratio > 1 else most
    at = roots(known.where("leads"), max(1, math.ceil(math.log2(steps + 1))))
    form = F.when(F.col("leads"), F.col("form")).alias("form")
    return known.join(at, "word", "left").select(
        "word", form, F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("leads"), F.col("form_n")).alias("form_n"))
