import random
from collections import Counter

import numpy as np
import pytest
from ferry.llm.repeats import RepeatParams, merged, remove_repeats, repeated_starts, window_minima
from ferry.llm.suffix_groups import suffix_array
from tests.llm.helpers import DOCS, odd_docs, prose


def plain_remove(texts, width):
    """(bytes, removed, spans, kept) of each text, by counting all windows."""
    data = [(t or "").encode() for t in texts]
    count = Counter(t[i:i + width] for t in data for i in range(len(t) - width + 1))
    out = []
    for t in data:
        covered = bytearray(len(t))
        for i in range(len(t) - width + 1):
            if count[t[i:i + width]] > 1:
                covered[i:i + width] = b"\1" * width
        spans = sum(covered[i] and not (i and covered[i - 1]) for i in range(len(t)))
        out.append((len(t), sum(covered), spans, bytes(x for x, c in zip(t, covered) if not c)))
    return out


def test_suffix_array_against_sorting():
    rng = random.Random(1)
    for _ in range(4000):
        s = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.randrange(0, 40))]
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])
    for s in (b"a" * 500, b"ab" * 300, b"abaababaabaab" * 30, bytes(range(256)) * 3, prose(rng, 400).encode()):
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def test_repeated_starts_against_counting():
    rng = random.Random(2)
    for _ in range(300):
        texts = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(5, 40))) for _ in range(rng.randint(1, 5))]
        count = Counter(t[i:i + 5] for t in texts for i in range(len(t) - 4))
        got, at = repeated_starts(texts, 5), 0
        for t in texts:
            assert got[at:at + len(t) - 4].tolist() == [count[t[i:i + 5]] > 1 for i in range(len(t) - 4)]
            at += len(t) + 1


def test_helpers():
    rng = np.random.default_rng(3)
    for size in (1, 4, 9):
        x = rng.integers(0, 50, 40).astype(np.uint64)
        assert window_minima(x, size).tolist() == [min(x[i:i + size]) for i in range(40 - size + 1)]
    a, b = merged(np.array([5, 0, 3, 20]), np.array([9, 3, 4, 22]))
    assert list(zip(a, b)) == [(0, 4), (5, 9), (20, 22)]


def corpus(rng):
    """Copies, near copies, passages in many contexts, periodic and odd texts."""
    base, hot = prose(rng, 300, 5000), prose(rng, 25, 5000)
    texts = [base] * 3 + [base.upper(), base[7:900], base[:500] + "é" + base[500:], "ab" * 700, "a" * 650, "x" * 199, "x" * 200, "日本" * 150]
    texts += [prose(rng, rng.randint(5, 60), 5000) + " " + hot + " " + prose(rng, rng.randint(5, 60), 5000) for _ in range(60)]
    texts += [prose(rng, 150, 5000) for _ in range(20)]
    for _ in range(30):
        words = base.split()
        words[rng.randrange(300)] = "changed"
        texts.append(" ".join(words))
    return [(i, t) for i, t in enumerate(texts)] + [(r[0], r[1]) for r in odd_docs(rng)]


@pytest.mark.parametrize("p", [
    RepeatParams(),
    RepeatParams(width=40, gram=8, block=256, most=2000, unit=500, piece=300),      # homes taken apart, anchors refined
    RepeatParams(width=100, gram=20, most=600, unit=1, piece=1000),
])
def test_removal_against_counting(spark, p):
    docs = corpus(random.Random(5))
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], "doc_id long, text string, key string, ref long, lo int").repartition(4)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_repeats(df, p).collect())
    want = sorted((str(i), *x) for (i, _), x in zip(docs, plain_remove([t for _, t in docs], p.width)))
    assert got == want


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], DOCS)).count() == 0
