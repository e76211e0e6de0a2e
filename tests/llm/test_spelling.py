import random
import zlib
from collections import Counter

import pytest
import regex
from ferry.llm.spelling import (
    SpellingParams, corpus_words, near_words, neighbour_offsets, one_edit, spelling_variants, vocabulary)
from tests.llm.helpers import LOWER, odd_docs, DOCS

LETTERS = regex.compile("[A-Za-zÀ-ÿ]+")


def plain_words(docs):
    out = Counter()
    for doc_id, text in docs:
        for run in LETTERS.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 2}


def plain_edit(a, b):
    """One insertion, deletion or replacement, by trying all."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts):
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and plain_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    rows = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        rows[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return rows


def made_counts(rng, bases, variants, letters):
    out = {}
    for _ in range(bases):
        base = "".join(rng.choice(letters) for _ in range(rng.randint(7, 12)))
        out[base] = int(10 ** rng.uniform(0.4, 4))
        for _ in range(rng.randint(0, variants)):
            w = rng.choice([x for x in out if abs(len(x) - len(base)) < 3][-5:])
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])
            out.setdefault(w, max(2, int(10 ** rng.uniform(0.3, 3))))
    return out


def got(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("seed,letters,p", [
    (1, "abcdefghijklmnopqrstuvwxyzéèüñ×", SpellingParams()),
    (2, "ab", SpellingParams(chunk=50, frontier=64)),        # few vectors: blocks in chunks, halved frontiers
    (3, "aeinrst", SpellingParams(chunk=200, frontier=500)),
])
def test_variants_against_all_pairs(spark, seed, letters, p):
    counts = made_counts(random.Random(seed), 150, 12, letters)
    if seed == 1:
        long = "ab" * 700                                     # beyond the matrices, and beyond the packed counts
        counts.update({long: 900, long[:-1]: 9, long + "q": 5, long[1:]: 3, "x" * 70: 50, "x" * 69 + "y": 2, "x" * 71: 40})
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert got(spelling_variants(words, p)) == plain_variants(counts)


def test_chain_of_forms(spark):
    chain = {"aaaaaaa": 100_000, "aaaaaab": 10_000, "aaaaabb": 1000, "aaaabbb": 100, "aaabbbb": 10}
    words = spark.createDataFrame(list(chain.items()), "word string, n long")
    assert {r.root for r in spelling_variants(words).collect()} == {"aaaaaaa"}


def test_corpus_words_against_plain_version(spark):
    rng = random.Random(6)
    pool = ["Élégance", "straßenbahn", "ABCDEFGH", "lowercase", "×multi÷ply", "shortest", "Ünïcode", "sixsix", "ÀÉÎÕÜÿþ"]
    docs = [(i, " ".join(rng.choice(pool) + rng.choice(["", ".", "1", "’s", "日"]) for _ in range(60))) for i in range(80)]
    docs += [(r[0], r[1]) for r in odd_docs()] + [(None, "Élégance lowercase " * 3), (None, "Élégance lowercase " * 3)]
    df = spark.createDataFrame([(i, t, None, None, None, "w", 1) for i, t in docs], DOCS + ", word string, n long")
    words = vocabulary(corpus_words(df, 7), 2)
    assert {r.word: r.n for r in words.collect()} == plain_words(docs)
    assert got(spelling_variants(words)) == plain_variants(plain_words(docs))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling_variants(empty).count() == 0 and near_words(empty).count() == 0


def test_helpers():
    rng = random.Random(8)
    for _ in range(3000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 6))) for _ in range(2))
        assert one_edit(a.encode(), b.encode()) == plain_edit(a, b)
    for groups in (3, 6):
        half = neighbour_offsets(groups)
        assert len(half) == groups + groups * (groups - 1) // 2
        assert not {tuple(-x for x in v) for v in half} & set(half)
