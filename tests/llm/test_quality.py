import math
import random
from collections import Counter

import numpy as np
import pytest

from ferry.llm import quality as Q
from tests.llm.helpers import DOCS, SPACE_WORDS, odd_docs, prose


def plain_stats(text):
    text = text or ""
    words = SPACE_WORDS.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if SPACE_WORDS.search(x)]
    return (len(words), sum(map(len, words)), sum(c in Q.SYMBOLS for c in text), len(lines), len(lines) - len(set(lines)), len(covered))


def test_statistics_against_plain_python(spark):
    rng = random.Random(3)
    texts = [r[1] for r in odd_docs()]
    texts += ["\n".join(prose(rng, rng.randint(0, 12), 6) for _ in range(rng.randint(0, 20))) for _ in range(150)]
    texts += [" ".join(["a b c d e f g h"] * n) for n in (1, 2, 3)] + ["x " * 40, "# $ % & | < > *"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, text string")
    got = {r.k: tuple(r)[1:] for r in Q.text_stats(df).select(
        "k", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words").collect()}
    for k, t in enumerate(texts):
        assert got[k] == plain_stats(t), t


def plain_mcd(rows, p):
    """The same estimator with NumPy, for one group of raw statistics."""
    def feature(w, c, s, n, d, r):
        return [math.log((c + 250) / (w + 50)), math.sqrt(s / (c + 1)), d / (n + 5), r / (w + 20)]

    q = np.floor(np.array([feature(*r) for r in rows]) * Q.SCALE + 0.5)
    x = q / Q.SCALE
    m = np.median(q, axis=0) / Q.SCALE
    iqr = (np.percentile(q, 75, axis=0) - np.percentile(q, 25, axis=0)) / Q.SCALE / 1.349
    cov = np.diag(np.maximum(iqr, p.floors) ** 2)
    factor = p.support / Q._chi6_cdf(Q.chi4_quantile(p.support))
    for step in range(p.steps + 1):
        d2 = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(cov), x - m)
        if step < p.steps:
            bins = np.floor(64 * np.log2(d2 + 0.0001))
            near, f = bins <= np.percentile(bins, 100 * p.support), factor
        else:
            near, f = d2 <= Q.chi4_quantile(p.reweight), p.reweight / Q._chi6_cdf(Q.chi4_quantile(p.reweight))
        m = x[near].mean(axis=0)
        cov = (x[near].T @ x[near] / near.sum() - np.outer(m, m)) * f + np.diag(np.array(p.floors) ** 2)
    return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(cov), x - m)


def test_mcd_against_numpy(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(300):
        w = int(rng.integers(20, 400))
        c = int(w * rng.normal(5, 0.3))
        junk = i % 4 == 0
        rows.append((w, c, int(c * 0.4) if junk else int(rng.integers(0, 3)), int(rng.integers(1, 20)), int(junk) * 3, 0))
    p = Q.McdParams(min_rows=10)
    df = spark.createDataFrame([(i, "en", "s", *r) for i, r in enumerate(rows)],
                               "k int, lang string, source string, n_words long, word_chars long, n_symbols long, "
                               "n_lines long, n_dup_lines long, n_repeat_words long")
    got = {r.k: r for r in Q.mcd_verdict(df, p).collect()}
    want = plain_mcd(rows, p)
    for i, d2 in enumerate(want):
        assert got[i].d2 == pytest.approx(d2, rel=1e-6, abs=1e-9)
        assert got[i].kept == (d2 <= Q.chi4_quantile(p.reject))
    assert all(not got[i].kept for i in range(0, 300, 4)) and sum(got[i].kept for i in got) >= 220


def test_small_groups_use_the_coarser_level(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, 60), "en" if i % 40 else "xx", f"s{i % 3}", 0) for i in range(160)]
    rows.append((900, "# " * 60, "en", "rare", 0))
    df = spark.createDataFrame(rows, DOCS)
    kept = {r.doc_id: r.kept for r in Q.mcd_verdict(Q.quality_stats(df.select("doc_id", "text", "lang", "source"))).collect()}
    assert not kept[900] and sum(kept.values()) >= 155


def test_odd_rows_and_unchanged_columns(spark):
    df = spark.createDataFrame([(*r, 1, "x") for r in odd_docs()], DOCS + ", kept int, __w string")
    out = Q.quality_filter(df)
    assert out.columns == df.columns
    # too few rows for an estimate: only the base rule rejects
    assert sorted(r.doc_id or -1 for r in out.collect()) == [-1, 5, 5, 6, 7, 8]


def test_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert Q.quality_filter(df).count() == 0


def test_a_run_repeats_itself_however_rows_are_spread(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randint(20, 90)), "en", f"s{i % 2}", 0) for i in range(240)]
    df = spark.createDataFrame(rows, DOCS).select("doc_id", "text", "lang", "source")
    one, two = (sorted(Q.mcd_verdict(Q.quality_stats(df.repartition(n))).select("doc_id", "d2", "kept").collect()) for n in (1, 7))
    assert one == two
