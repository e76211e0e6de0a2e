import random
import zlib

import numpy as np
import pytest

from ferry.llm import language as L
from tests.llm.helpers import DOCS, odd_docs

ALPHABETS = {"aa": "abcde ", "bb": "cdefg ", "cc": "ghijk ", "dd": "éèàab ", "ee": "xyzab "}


def made(rng, lang, n):
    words = ["".join(rng.choice(ALPHABETS[lang][:-1]) for _ in range(3 + k % 4)) for k in range(30)]
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.mark.parametrize("k", [1, 2, 3, 4, 7, 8, 20])
def test_codewords_differ(k):
    code = L.codewords(k, 1)
    assert code.shape[0] == k and len({tuple(r) for r in code.tolist()}) == k
    if 2 < k <= 7:
        assert code.shape[1] == 2 ** (k - 1) - 1
    assert all(len(set(col)) == 2 for col in code.T.tolist())


def test_decoding_corrects_wrong_bits():
    code = L.codewords(5, 1)
    model = L.EcocModel(list(ALPHABETS), code, np.eye(code.shape[1], dtype=np.float32), np.zeros(code.shape[1]), np.ones(code.shape[1]))
    assert model.radius == 3
    for k, word in enumerate(code):
        wrong = word.copy()
        wrong[:3] *= -1
        best, score, unsure = model.decode(3 * wrong[None])
        assert best[0] == k and not unsure[0] and 0 < score[0] <= 1
        wrong[:4] *= -1
        wrong[:4] *= -1
        wrong[3:5] *= -1
        assert model.decode(3 * wrong[None])[2][0] or model.decode(3 * wrong[None])[0][0] != k


def test_counts_do_not_depend_on_pieces(monkeypatch):
    data = np.frombuffer(("Añb, cde 12 fgh! " * 300).encode(), np.uint8)
    whole = L.count_ngrams(data)
    monkeypatch.setattr(L, "CHUNK", 97)
    assert np.abs(L.count_ngrams(data)[:L.TRIGRAMS] - whole[:L.TRIGRAMS]).sum() == 0


def test_held_out_accuracy_and_blindness(spark):
    rng = random.Random(9)
    rows = [(i, made(rng, lang, rng.randint(5, 80)), lang, "s", 0) for i in range(600) for lang in [rng.choice(list(ALPHABETS))]]
    df = spark.createDataFrame(rows, DOCS)
    model = L.train(df, L.EcocParams(sample=60))
    got = {r.doc_id: r for r in L.predict(df.select("doc_id", "text"), model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert len(held) > 100
    assert np.mean([got[r[0]].lang_pred == r[2] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    # labels of held-out rows teach nothing
    lied = spark.createDataFrame([(i, t, "aa" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, s, n) for i, t, lang, s, n in rows], DOCS)
    assert np.array_equal(L.train(lied, L.EcocParams(sample=60)).weights, model.weights)


def test_held_out_matches_crc32(spark):
    df = spark.createDataFrame([(i,) for i in (None, -5, 0, 7, 10**12, *range(40))], "doc_id long")
    for r in df.select("doc_id", L.held_out(df.doc_id).alias("h")).collect():
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_odd_rows_extra_columns_and_no_letters(spark):
    rng = random.Random(10)
    good = [(i + 100, made(rng, lang, 30), lang, "s", 0) for i in range(80) for lang in ("aa", "cc")]
    rows = odd_docs() + good + [(99, "12345 !!", "aa", "s", 0)]
    df = spark.createDataFrame([(*r, "mine", 1.5) for r in rows], DOCS + ", lang_pred string, score double")
    model = L.train(df)
    assert {"aa", "cc"} <= set(model.languages)
    out = L.predict(df, model)
    assert out.columns == [*df.columns, "_lang_pred", "_score", "ambiguous"]
    for r in out.collect():
        und = not any(c.isalpha() for c in r.text or "")
        assert (r._lang_pred == "und") == und and (r._score == 0) == und and r.lang_pred == "mine"
    kept = L.language_filter(df)
    assert kept.columns == df.columns and {r[0] for r in good} <= {r.doc_id for r in kept.collect()}


def test_nothing_to_learn_and_empty(spark):
    df = spark.createDataFrame([(1, "text", None, "s", 0)], DOCS)
    assert [r.lang_pred for r in L.predict(df, L.train(df)).collect()] == ["und"]
    empty = spark.createDataFrame([], DOCS)
    assert L.language_filter(empty).count() == 0


def test_filter_keeps_texts_when_nothing_can_be_learned(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2)
    texts = ["some clean text", "Ünïcode 日本語", "123 !!", "", None]
    for rows in ([(i, t, None, "s", 0) for i, t in enumerate(texts)], [(None, t, "en", "s", 0) for t in texts],
                 [(held, t, "en", "s", 0) for t in texts],
                 [(i, t, "en" if i > 1 else None, "s", 0) for i, t in enumerate(texts)]):
        df = spark.createDataFrame(rows, DOCS)
        kept = L.language_filter(df)
        assert kept.columns == df.columns
        assert sorted(r.text for r in kept.collect()) == sorted(texts[:2])


def test_one_language(spark):
    df = spark.createDataFrame([(i, "some words here", "en", "s", 0) for i in range(9)], DOCS)
    assert {r.lang_pred for r in L.predict(df, L.train(df)).collect()} == {"en"}
