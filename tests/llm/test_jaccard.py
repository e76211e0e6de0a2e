import random

import numpy as np
import pytest

from ferry.llm import jaccard as J
from ferry.llm.common import written
from ferry.llm.words import SPACE_TABLE, hash_bytes
from tests.llm.helpers import DOCS, jaccard_components, odd_docs, prose


def edited(rng, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def families(rng, n_families=25):
    rows = []
    for _ in range(n_families):
        base = prose(rng, rng.randint(3, 300), 5000)
        for _ in range(rng.randint(1, 9)):
            rows.append(edited(rng, base, rng.randint(0, max(1, len(base.split()) // 40))))
        rows += [base] * rng.randint(0, 2)
    shared = prose(rng, 60, 5000)
    rows += [shared + " " + prose(rng, rng.randint(1, 100), 5000) for _ in range(25)]
    rows += ["", "one", "one", "ONE", "two words", None]
    rng.shuffle(rows)
    return [(i, t, "en", "s", 0) for i, t in enumerate(rows)]


def got(spark, rows, params):
    df = spark.createDataFrame(rows, DOCS)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in J.similarity_components(df, params).collect()}


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80), (2, 60)])
def test_components_against_all_overlaps(spark, words, percent):
    rows = families(random.Random(words * percent))
    assert got(spark, rows, J.JoinParams(words, percent)) == jaccard_components([r[:2] for r in rows], words, percent)


def test_split_buckets_lose_no_link(spark, monkeypatch):
    rng = random.Random(4)
    base = prose(rng, 120, 5000)
    # a drifting family: neighbours link, far relatives do not, so one pivot cannot hold them all
    texts, text = [], base
    for _ in range(40):
        texts += [edited(rng, text, 1) for _ in range(4)]
        text = edited(rng, text, 2)
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    monkeypatch.setattr(J, "BLOCK_SHINGLES", 1200)
    assert got(spark, rows, J.JoinParams()) == jaccard_components([r[:2] for r in rows], 3, 90)


def test_routing_keys_meet_for_every_link():
    rng = np.random.default_rng(5)
    for percent in (60, 80, 90, 99):
        p = J.JoinParams(3, percent)
        least = -(-percent // (100 - percent))
        for _ in range(300):
            n = int(rng.integers(least, least + 3000))
            a = np.unique(rng.integers(0, 2**63, n, np.uint64) * np.uint64(2))
            most = 2 * len(a) * (100 - percent) // (100 + percent)
            drop = int(rng.integers(0, min(most, len(a) - 1) + 1))
            add = int(rng.integers(0, most - drop + 1)) if most > drop else 0
            b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**63, add, np.uint64)]))
            inter = len(np.intersect1d(a, b))
            if 100 * inter >= percent * (len(a) + len(b) - inter) and not np.array_equal(a, b):
                assert set(J.routing_keys(a, p).tolist()) & set(J.routing_keys(b, p).tolist()), (percent, len(a), len(b))


def test_sieve_passes_repeated_keys_only(spark):
    rng = random.Random(7)
    base = [prose(rng, 200, 5000) for _ in range(60)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(base + [edited(rng, t, 2) for t in base[:6]])]
    p, docs = J.JoinParams(5, 80), spark.createDataFrame(rows, DOCS).repartition(5)
    keys = [J.routing_keys(J.shingle_set(hash_bytes(np.frombuffer(r[1].encode(), np.uint8), SPACE_TABLE), 5), p) for r in rows]
    values, counts = np.unique(np.concatenate(keys), return_counts=True)
    moved = [r.key for r in J.key_rows(docs, p, J.write_sieve(docs, p)).collect()]
    assert set(values[counts > 1].view(np.int64).tolist()) <= set(moved)
    assert len(moved) < sum(map(len, keys)) / 2


def test_copies_bring_their_keys_once(spark):
    rng = random.Random(17)
    base = [prose(rng, 200, 5000) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(base * 3)], DOCS).repartition(4)
    p = J.JoinParams(5, 80)
    reps = written(spark.range(20).selectExpr("xxhash64(id)"), "test-reps")
    marks = J.write_marks(reps)
    assert J.key_rows(docs, p, J.write_sieve(docs, p, marks), marks).count() < J.key_rows(docs, p, J.write_sieve(docs, p)).count() / 10


def test_bucket_members_against_all_keys(spark):
    rows = families(random.Random(23))
    p, docs = J.JoinParams(5, 80), spark.createDataFrame(rows, DOCS).repartition(5)
    sets = J.write_sets(docs, p)
    classes = written(sets.where("n_shingles > 0").groupBy("cid", "fp", "n_shingles", "sketch").agg({"doc_id": "min"})
                      .withColumnRenamed("min(doc_id)", "rep"), "test-classes")
    holders = {}
    for _, text, *_ in rows:
        s = J.shingle_set(hash_bytes(np.frombuffer((text or "").encode(), np.uint8), SPACE_TABLE), 5)
        for key in J.routing_keys(s, p).tolist():
            holders.setdefault(key, set()).add(J._number(J.set_id(s)))
    want = {(min(h), fp) for h in holders.values() if len(h) > 1 for fp in h}
    found = [tuple(r) for r in J.bucket_members(docs, classes, p).collect()]
    assert len(found) == len(set(found)) and set(found) == want


def test_sketches_keep_all_that_link():
    rng = np.random.default_rng(29)
    for percent in (50, 80, 90):
        p, sets = J.JoinParams(5, percent), []
        for n in [1, 4, 9, 63, 64, 65, 100, 127, 128, 129, 250, 256, 257, 600]:
            base = rng.integers(0, 2**64, n, np.uint64)
            sets.append(np.unique(base))
            for _ in range(4):
                new = rng.integers(0, 2**64, rng.integers(0, n // 2 + 2), np.uint64)
                sets.append(np.unique(np.concatenate([base[rng.integers(0, n // 3 + 1):], new])))
        sets = [s for s in sets if len(s)]
        sizes, sketches = np.array([len(s) for s in sets]), [J.parity_sketch(s) for s in sets]
        labels, asked = rng.integers(0, 3, len(sets)), rng.random(len(sets)) < 0.3
        linked, judged = np.zeros(len(sets), bool), np.zeros(len(sets), bool)
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                inter = len(np.intersect1d(a, b))
                if 100 * inter >= percent * (len(a) + len(b) - inter):
                    linked[[i, j]] = True
                    judged[[i, j]] |= labels[i] != labels[j] and (asked[i] or asked[j])
        assert linked.sum() > 10 and J.linkable(sizes, sketches, p)[linked].all()
        assert J.linkable(sizes, sketches, p, labels, asked)[judged].all()
    unrelated = [rng.integers(0, 2**64, n, np.uint64) for n in rng.integers(60, 300, 200)]
    assert J.linkable(np.array([len(s) for s in unrelated]), [J.parity_sketch(s) for s in unrelated], J.JoinParams(5, 80)).sum() < 10


def test_texts_of_a_common_passage_do_not_move(spark, monkeypatch):
    rng = random.Random(31)
    passage = prose(rng, 60, 5000)
    base = [prose(rng, 200, 5000) for _ in range(5)]
    texts = [prose(rng, 150, 5000) + " " + passage for _ in range(120)] + base + [edited(rng, t, 1) for t in base]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    moved, blocks = [], J._blocks

    def counted(placed, *rest):
        moved.append(placed.count())
        return blocks(placed, *rest)

    monkeypatch.setattr(J, "_blocks", counted)
    monkeypatch.setattr(J, "BLOCK_SHINGLES", 4000)
    assert got(spark, rows, J.JoinParams(5, 80)) == jaccard_components([r[:2] for r in rows], 5, 80)
    assert 10 <= sum(moved) < 30


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
def test_split_buckets_of_families_and_a_common_passage(spark, monkeypatch, words, percent):
    rows = families(random.Random(37))
    monkeypatch.setattr(J, "BLOCK_SHINGLES", 600)
    assert got(spark, rows, J.JoinParams(words, percent)) == jaccard_components([r[:2] for r in rows], words, percent)


def test_packed_numbers_come_back():
    rng = np.random.default_rng(8)
    for top in (1, 200, 2**17, 2**40, 2**62):
        values = np.sort(rng.integers(0, top, 500, np.uint64))
        assert np.array_equal(J.unpack(J.pack(values)), values)
    one = J._packed_pieces([np.full(9, 2**63 + 5, np.uint64)])
    assert one.column(0).to_pylist() == [512] and J.unpack(one.column(1)[0].as_py()).tolist() == [0, 0]


def test_merge_and_divide_skip_against_counting():
    rng = random.Random(6)
    for _ in range(300):
        lists = [sorted(rng.sample(range(60), rng.randint(0, 40))) for _ in range(rng.randint(1, 30))]
        need = rng.randint(1, len(lists))
        want = {v: c for v in range(60) if (c := sum(v in x for x in lists)) >= need}
        assert dict(J.merge_skip(lists, need)) == want
        # the same lists as an index: list k holds the sets that contain shingle k
        sets = [np.array([k for k, x in enumerate(lists) if v in x], np.uint64) for v in range(60)]
        index = J.InvertedIndex(sets, np.arange(len(lists), dtype=np.uint64))
        open_sets = np.arange(60) % 7 != 0
        got = dict(J.divide_skip(index, np.arange(len(lists), dtype=np.uint64), need, open_sets))
        assert got == {v: c for v, c in want.items() if v % 7}


def test_shingles():
    def sizes(text):
        return len(J.shingle_set(hash_bytes(np.frombuffer(text.encode(), np.uint8), SPACE_TABLE), 3))
    assert [sizes(t) for t in ("", "a", "a b", "a b c", "a b c d", "a b c a b c a b c")] == [0, 1, 1, 1, 2, 3]


def test_components_of_chains_and_stars(spark):
    ids = [bytes([i]) * 16 for i in range(120)]
    links = [(ids[i], ids[i + 1]) for i in range(0, 60)] + [(ids[70], ids[i]) for i in range(71, 100)] + [(ids[110], ids[110])]
    df = written(spark.createDataFrame(links, "cid binary, other binary"), "test-links")
    roots = {bytes(r.cid): bytes(r.root) for r in J.components(df).collect()}
    assert all(roots[ids[i]] == ids[0] for i in range(61)) and all(roots[ids[i]] == ids[70] for i in range(70, 100))
    assert ids[110] not in roots


def test_odd_rows(spark):
    rows = odd_docs()
    df = spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", component_id string")
    out = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.similarity_components(df).collect()), key=str)
    by = {}
    for d, n, c in out:
        by.setdefault(d, []).append((n, c))
    assert len(out) == len(rows)
    assert by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[9] == [(0, 9)]
    assert by[5] == [by[5][0]] * 2 and by[6][0] == by[5][0] and by[5][0][1] == 5      # copies, also in upper case
    assert (by[5][0][0], 5) in by[None] and (0, None) in by[None]
    assert by[8][0][1] == by[7][0][1] == 7


def test_keep_one(spark):
    rows = odd_docs()
    df = spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", __h string")
    kept = J.keep_one_per_component(df)
    assert kept.columns == df.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == [-1, 1, 2, 3, 4, 5, 7, 9, 10, 11, 12]
    only_null = spark.createDataFrame([(None, "a b c d e f", "en", "s", 0)] * 3, DOCS)
    assert J.keep_one_per_component(only_null).count() == 1


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert J.similarity_components(empty).count() == 0 and J.keep_one_per_component(empty).count() == 0
