import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ferry.llm import packing as P
from tests.llm.helpers import DOCS, odd_docs, prose, space_words


def plain_best_fit(pieces, params):
    """Looks at every bin for every piece."""
    bins, out = [], [None] * len(pieces)
    for i in sorted(range(len(pieces)), key=lambda i: (-pieces[i][0], pieces[i][3])):
        length, source, cluster, _ = pieces[i]
        fits = [b for b, (used, sources, clusters) in enumerate(bins)
                if params.capacity - used >= length and sources[source] < params.per_source and cluster not in clusters]
        best = max(fits, key=lambda b: (bins[b][0], -b), default=None)
        if best is None:
            bins.append([0, Counter(), set()])
            best = len(bins) - 1
        out[i] = (best, bins[best][0])
        bins[best][0] += length
        bins[best][1][source] += 1
        bins[best][2] |= {cluster} if cluster >= 0 else set()
    return out


@pytest.mark.parametrize("seed", range(40))
def test_against_a_look_at_every_bin(seed):
    rng = random.Random(seed)
    for _ in range(10):
        params = P.PackParams(capacity=rng.choice([2, 10, 63, 64, 100]), per_source=rng.randint(1, 4))
        pieces = [(rng.randint(1, params.capacity - 1), rng.randint(0, 4),
                   rng.choice([-1, 50 + rng.randint(0, 5), 100 + rng.randint(0, 99)]), i) for i in range(rng.randint(0, 150))]
        assert P.pack_group(pieces, params) == plain_best_fit(pieces, params)


def test_a_hot_cluster_is_quick():
    rng = random.Random(1)
    pieces = [(300 if i % 3 else rng.randint(1, 2000), i % 2, 7 if i % 3 else 10 + i, i) for i in range(20_000)]
    bins = defaultdict(list)
    for piece, (b, at) in zip(pieces, P.pack_group(pieces, P.PackParams())):
        bins[b].append((at, *piece))
    for held in bins.values():
        assert sum(h[1] for h in held) <= 2048 and Counter(h[3] for h in held)[7] <= 1


def packed(spark, rows, params, schema=DOCS):
    df = spark.createDataFrame(rows, schema)
    return P.pack_documents(df, P.word_length(F.col("text")), P.text_cluster(F.col("text")), params).collect()


def test_documents(spark):
    rng = random.Random(2)
    base = [prose(rng, rng.randint(1, 150)) for _ in range(60)]
    rows = [(i, rng.choice(base), "en", f"s{min(3, rng.randrange(9))}", 0) for i in range(400)]
    params = P.PackParams(capacity=64, per_source=2, group_rows=100)
    got = packed(spark, rows, params)
    of = {r[0]: r for r in rows}
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        bins[r.bin].append(r)
    for i, text, *_ in rows:                                   # whole documents, gapless pieces
        assert sorted(r.piece for r in pieces[i]) == list(range(len(pieces[i])))
        assert sum(r.length for r in pieces[i]) == len(space_words(text)) + 1
    for held in bins.values():
        held.sort(key=lambda r: r.offset)
        assert held[0].offset == 0 and all(a.offset + a.length == b.offset for a, b in zip(held, held[1:]))
        assert held[-1].offset + held[-1].length <= 64
        assert max(Counter(of[r.doc_id][3] for r in held).values()) <= 2
        assert max(Counter(of[r.doc_id][1] for r in held).values()) == 1
    assert len({b.split("-")[0] for b in bins if not b.startswith("r")}) > 1


def test_odd_rows(spark):
    rows = [(*r, "x") for r in odd_docs()]
    got = packed(spark, rows, P.PackParams(capacity=1000), DOCS + ", bin string")
    assert {r.row for r in got if r.bin is None} and all((r.length == 0) == (r.bin is None) for r in got)
    assert sum(r.length for r in got) == sum(len(w) + 1 for w in (space_words(x[1]) for x in rows) if w)
    bins = defaultdict(set)
    for r in got:
        if r.doc_id == 5:
            bins[r.bin].add(r.row)
    assert len(bins) == 2                                      # repeated rows share a cluster


def test_empty_table(spark):
    assert packed(spark, [], P.PackParams()) == []


def test_parameters():
    with pytest.raises(ValueError):
        P.PackParams(capacity=0)
