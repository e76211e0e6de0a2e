import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline as CP
from ferry.llm.language import UNDEFINED, predict, train
from ferry.llm.quality import McdParams, mcd_verdict, quality_stats
from tests.llm.helpers import DOCS, alnum_words, jaccard_components, odd_docs, prose, space_words
from tests.conftest import SF_SMALL
from tests.llm.test_language import made
from tests.llm.test_quality import plain_mcd, plain_stats


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [alnum_words(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    windows = {tuple(w[i:i + 13]) for w in items for i in range(len(w) - 12)}
    for name, stage in CP.STAGES:
        rows = docs.collect()
        out = stage(spark, docs, SF_SMALL)
        if name == "packing":
            break
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        left = sorted(out.collect())
        ids = {r.doc_id for r in left}
        assert left == sorted(r for r in rows if r.doc_id in ids) and len(ids) == len(left)
        if name == "quality rules":
            stats = mcd_verdict(quality_stats(docs.select("doc_id", "text", "lang", "source")))
            want = {r.doc_id for r in stats.where("kept").collect()}
        elif name == "language ID":
            judged = predict(docs, train(docs))
            want = {r.doc_id for r in judged.collect() if r.lang_pred != UNDEFINED and not r.ambiguous}
        elif name == "near copies":
            comp = jaccard_components([(r.doc_id, r.text) for r in rows], 5, 80)
            want = {d for d, (_, c) in comp.items() if c == d}
        else:
            want = set()
            for r in rows:
                words = alnum_words(r.text)
                hit = {i + j for i in range(len(words) - 12) if tuple(words[i:i + 13]) in windows for j in range(13)}
                if not (hit and 20 * len(hit) >= len(words)):
                    want.add(r.doc_id)
        assert ids == want, name
        assert len(ids) >= 0.7 * len(rows)
        docs = spark.createDataFrame(left, docs.schema)
    got = out.collect()
    assert {r.doc_id for r in got} == ids
    assert sum(r.length for r in got) == sum(len(space_words(r.text)) + 1 for r in rows)


def test_run_is_the_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in CP.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert CP.run(spark, SF_SMALL).count() == docs.count() > 0


def test_stages_take_odd_rows_and_empty_tables(spark):
    odd = spark.createDataFrame([(*r, "x") for r in odd_docs(random.Random(1))], DOCS + ", __row string")
    for df in (odd, spark.createDataFrame([], odd.schema)):
        for name, stage in CP.STAGES:
            out = stage(spark, df, SF_SMALL)
            if name != "packing":
                assert out.columns == df.columns
            assert out.count() <= max(df.count(), 100)


CLEAN = ("aa", "bb", "cc", "dd")


def test_quality_stage_against_brute_force(spark):
    rng = random.Random(21)
    rows, clean = [], set()
    for lang in CLEAN:
        for k in range(160):
            words = prose(rng, rng.randint(60, 200), 3000).split()
            if k % 16 == 0:
                words = words[:rng.randint(0, 19)]             # too short
            elif k % 16 == 1:
                words += words[:8] * 30                        # repeated
            elif k % 16 == 2:
                words = [w + "#$%&|" * rng.randint(1, 9) for w in words]
            else:
                clean.add(len(rows))
            rows.append((len(rows), " ".join(words), lang, "s", 0))
    want = set()
    for lang in CLEAN:
        stats = {r[0]: plain_stats(r[1]) for r in rows if r[2] == lang}
        stats = {i: x for i, x in stats.items() if x[0] >= 20 and 100 * x[5] <= 30 * x[0]}
        assert len(stats) >= 100
        far = plain_mcd(list(stats.values()), McdParams())
        want |= {i for i, d2 in zip(stats, far) if d2 <= 18.4668}   # 99.9 % of chi-square with 4 degrees
    kept = {r.doc_id for r in CP.quality_rules(spark, spark.createDataFrame(rows, DOCS), SF_SMALL).collect()}
    assert kept == want and clean <= kept and len(kept) < len(rows)


def plain_features(text):
    folded = re.sub(rb"[^a-z\x80-\xff]", b" ", text.encode().lower())
    grams = Counter(g for n in (2, 3) for g in (folded[i:i + n] for i in range(len(folded) - n + 1)) if b"  " not in g)
    return {g: (n / sum(grams.values())) ** 0.5 for g, n in grams.items()}


def plain_language_margins(rows):
    """Codewords of all splits of the languages, and every text's margins of plainly learned bits."""
    code = np.array(list(itertools.product([1], *[[1, -1]] * (len(CLEAN) - 1)))[1:]).T
    texts = [plain_features(r[1]) for r in rows]
    number = {g: k for k, g in enumerate(sorted({g for t in texts for g in t}))}
    x = np.zeros((len(rows), len(number)))
    for i, t in enumerate(texts):
        for g, v in t.items():
            x[i, number[g]] = v
    learn = [i for i, r in enumerate(rows) if r[2] and zlib.crc32(str(r[0]).encode()) % 4 != 2 and re.search("[^\\W\\d_]", r[1])]
    labels = np.array([CLEAN.index(rows[i][2]) for i in learn])
    margins = []
    for bit in code.T:
        y, w, b = bit[labels], np.zeros(len(number)), 0.0
        for _ in range(3000):
            pull = y / (1 + np.exp(y * (x[learn] @ w + b))) / np.bincount(labels)[labels] / len(CLEAN)
            w, b = w + 4 * (x[learn].T @ pull - 1e-4 * w), b + 4 * pull.sum()
        margins.append(x @ w + b)
    return code, np.array(margins).T


def test_language_stage_against_brute_force(spark):
    rng = random.Random(22)
    rows = [(i, made(rng, CLEAN[i % 4], rng.randint(20, 60)), CLEAN[i % 4], "s", 0) for i in range(200)]
    clean = {r[0] for r in rows}
    rows += [(200 + i, t, None, "s", 0) for i, t in enumerate(["", "12 34", "#!? ..", "2024-01-02"])]
    for i in range(300, 380):                                  # two languages by halves: some cannot be told
        a, b = rng.sample(CLEAN, 2)
        rows.append((i, made(rng, a, 20) + " " + made(rng, b, 20), None, "s", 0))
    code, margins = plain_language_margins(rows)
    want, close = set(), set()
    for r, m in zip(rows, margins):
        losses = [np.logaddexp(0, -m * word).sum() for word in code]
        wrong = int((np.sign(m) != code[int(np.argmin(losses))]).sum())
        if re.search("[^\\W\\d_]", r[1]):
            if wrong <= 1:                                     # words of 7 bits that differ in 4: one wrong bit is corrected
                want.add(r[0])
            if np.abs(m).min() < 0.3 or np.diff(sorted(losses)[:2])[0] < 0.3:
                close.add(r[0])                                # either answer is within rounding
    assert not clean & close and clean <= want
    kept = {r.doc_id for r in CP.language_id(spark, spark.createDataFrame(rows, DOCS), SF_SMALL).collect()}
    assert clean <= kept and kept - close == want - close and not kept & {200, 201, 202, 203}
