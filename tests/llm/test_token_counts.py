import random

import pytest

from ferry.llm import token_counts as C
from ferry.llm.queries import tokenizer_file
from ferry.llm.tokenizing import encoder
from tests.llm.helpers import DOCS, odd_docs, prose

PARTS = ["a", "b", " ", "  ", "\n", "'", "re", "'ve", "s", "1", "2", ".", "!", "é", "\t", "ll", "Z", "_", "̀", "²", "<|endoftext|>", "日", "\x85"]


@pytest.fixture(scope="module")
def enc():
    return encoder(tokenizer_file())


def whole(enc, text):
    return len(enc.tokenizer.encode(text, add_special_tokens=False).ids)


def some_text(rng, n, plain):
    return "".join(rng.choice(PARTS[:18] if plain else PARTS) for _ in range(n))


@pytest.mark.parametrize("leaf", [1, 5, 64])
def test_counts_equal_a_full_encoding(enc, monkeypatch, leaf):
    monkeypatch.setattr(C, "LEAF", leaf)
    rng = random.Random(leaf)
    for k in range(700):
        text = some_text(rng, rng.randint(0, 200), k % 10)
        edits = []
        for _ in range(rng.randint(0, 5)):
            a = rng.randint(-2, len(text) + 2)
            edits.append((a, a + rng.randint(-1, 60), some_text(rng, rng.randint(0, 30), k % 10)))
        before, n, after, again, pieces = C.edited_counts(enc, text, edits)
        clean = C.clean_edits(edits, len(text))
        assert (before, n, after) == (whole(enc, text), len(clean), whole(enc, C.apply_edits(text, clean)))


def test_a_kept_tree_takes_edits_one_by_one(enc):
    rng = random.Random(2)
    text = some_text(rng, 3000, True)
    tree = C.TokenTree.load(enc, text, C.TokenTree.of(enc, text).dump())
    for _ in range(150):
        a = rng.randint(0, len(text))
        b, new = min(len(text), a + rng.randint(0, 40)), some_text(rng, rng.randint(0, 60), True)
        tree.replace(a, b, new)
        text = text[:a] + new + text[b:]
        assert tree.n_chars == len(text) and tree.n_tokens == whole(enc, text)
    assert tree.text() == text


def test_runs_that_reach_far_behind_the_edit(enc):
    for text, edit in [("a" + " " * 5000 + "b", (1, 2, "x")), ("x" * 4000, (5, 6, " ")), ("ab " * 2000, (0, 6000, "")),
                       (" " * 3000, (10, 10, "q")), ("", (0, 0, "new text")), ("x", (0, 1, ""))]:
        assert C.edited_counts(enc, text, [edit])[2] == whole(enc, C.apply_edits(text, [edit]))


def test_an_edit_costs_its_surroundings_only(enc):
    text = prose(random.Random(3), 20_000)
    _, _, _, again, pieces = C.edited_counts(enc, text, [(50_000, 50_003, "changed")])
    assert pieces > 20_000 and again < 20


def test_rules_and_edit_columns(spark, enc):
    text = "mail a.b@c.de or 1.2.3.4\nsame\nkey " + "0a" * 20 + "\nsame\n+49 170 1234567 end"
    assert C.apply_edits(text, C.clean_edits(C.scrub_edits(text), len(text))) == \
        "mail <email> or <ip>\nsame\nkey <key>\n<number> end"
    rows = [(1, "some text", [(0, 4, "any"), (5, 5, None), None, (None, 2, "x"), (2, 3, "overlap")]), (2, "other", None),
            (None, None, [(0, 9, "grown")])]
    df = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start:int,end:int,new:string>>")
    got = {r.doc_id: r for r in C.count_edited(df, tokenizer_file(), rule=None).collect()}
    assert (got[1].n_edits, got[1].n_tokens_after) == (2, whole(enc, "any text"))
    assert got[2].n_edits == 0 and got[2].n_tokens_after == got[2].n_tokens
    assert (got[None].n_tokens, got[None].n_tokens_after) == (0, whole(enc, "grown"))


def test_odd_rows_and_empty_table(spark, enc):
    rows = odd_docs()
    df = spark.createDataFrame([(*r, 3) for r in rows], DOCS + ", n_tokens int")
    got = sorted(((r.doc_id, r.n_tokens, r.n_tokens_after) for r in C.count_edited(df, tokenizer_file()).collect()), key=str)
    want = [(r[0], whole(enc, r[1] or ""), whole(enc, C.apply_edits(r[1] or "", C.clean_edits(C.scrub_edits(r[1] or ""), len(r[1] or "")))))
            for r in rows]
    assert got == sorted(want, key=str)
    assert C.count_edited(spark.createDataFrame([], DOCS), tokenizer_file()).count() == 0


UNICODE = [*PARTS, "\u2019", "\u201c", "\u2014", "\u03a9\u03bc", "\u0416", "\u0663", "\u2167", "\u2028", "\u3000", "\U0001f600",
           "e\u0301", "\x1c", "<|endof", "text|>", "<|endoftext|>", " <|endoftext|> "]


@pytest.mark.parametrize("leaf", [1, 5, 64])
def test_every_text_has_its_tree(enc, monkeypatch, leaf):
    monkeypatch.setattr(C, "LEAF", leaf)
    rng = random.Random(100 + leaf)

    def made(n):
        return "".join(rng.choice(UNICODE) for _ in range(rng.randint(0, n)))

    for _ in range(700):
        text, edits = made(200), []
        for _ in range(rng.randint(0, 5)):
            a = rng.randint(0, len(text))
            edits.append((a, a + rng.randint(0, 40), made(10)))
        before, n, after, again, pieces = C.edited_counts(enc, text, edits)
        edits = C.clean_edits(edits, len(text))
        assert (before, pieces) == enc.whole(text)
        assert (n, after) == (len(edits), whole(enc, C.apply_edits(text, edits)))
        tree = C.TokenTree.of(enc, text)
        for edit in reversed(edits):
            tree.replace(*edit)
        assert [p for leaf, _ in tree.leaves for p in leaf] == enc.cut(C.apply_edits(text, edits))


@pytest.mark.parametrize("mark", ["\u2019", "\u0416", "\u65e5\u672c", "\U0001f600", "\x85", "<|endoftext|>"])
def test_an_edit_of_any_text_costs_its_surroundings_only(enc, mark):
    text = f" {mark} ".join([prose(random.Random(3), 5_000)] * 4)
    before, _, after, again, pieces = C.edited_counts(enc, text, [(50_000, 50_003, f"x{mark}")])
    assert pieces == enc.whole(text)[1] > 20_000 and 0 < again < 25
    assert (before, after) == (whole(enc, text), whole(enc, C.apply_edits(text, [(50_000, 50_003, f"x{mark}")])))
