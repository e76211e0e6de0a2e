import hashlib
import random

import pytest

from ferry.llm.chat import ChatTemplate, chat_digest, escape, format_chat, read_back, unescape
from pyspark.sql import functions as F

ROWS = "conv_id long, turn long, role string, text string"


def run(spark, rows, template=ChatTemplate()):
    df = spark.createDataFrame(rows, ROWS)
    return {r.conv_id: r for r in chat_digest(format_chat(df, template), template).collect()}


def test_escape_is_reversible_and_hides_markers(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["<", "|", "\\", "end", "|>", "\n", "a", "<|end|>\n", "<|start|>"]) for _ in range(rng.randint(0, 12)))
             for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, e, u in df.select("t", escape(F.col("t")), unescape(escape(F.col("t")))).collect():
        assert u == t and "<|" not in e


def test_round_trip_of_hostile_texts(spark):
    rng = random.Random(2)
    parts = ["<|start|>", "<|message|>", "<|end|>\n", "<", "\\", "|", "\n", "x", "assistant", "é"]
    rows, want = [], {}
    for c in range(60):
        turns = [(rng.choice(["user", "assistant", "<|end|>", "a|b"]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 8))))
                 for _ in range(rng.randint(1, 6))]
        want[c] = turns
        rows += [(c, i, role, text) for i, (role, text) in enumerate(turns)]
    chats = format_chat(spark.createDataFrame(rows, ROWS))
    for r in chats.select("conv_id", read_back(F.col("formatted")).alias("turns"), "segments", "formatted").collect():
        assert [(t.role, t.text) for t in r.turns] == want[r.conv_id]
        assert "".join(s.text for s in r.segments) == r.formatted
    for c, r in run(spark, rows).items():
        whole = "".join(f"{role}\n{text}\n" for role, text in want[c])
        loss = "".join(text for role, text in want[c] if role == "assistant")
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.n_turns == len(want[c])


@pytest.mark.parametrize("roles, valid, state, bad", [
    (["user", "assistant"], True, "answered", None),
    (["system", "user", "assistant", "tool", "assistant"], True, "answered", None),
    (["assistant"], False, "reject", 0),
    (["user", "user", "assistant"], False, "reject", 1),
    (["system", "system"], False, "reject", 1),
    (["user", "assistant", "user"], False, "asked", None),
    (["robot"], False, "reject", 0),
])
def test_state_machine(spark, roles, valid, state, bad):
    r = run(spark, [(1, i, role, "t") for i, role in enumerate(roles)])[1]
    assert (r.valid, r.end_state, r.bad_turn) == (valid, state, bad)


def test_nulls_ties_repeats_and_order(spark):
    rows = [(None, 1, "assistant", None), (None, 0, "user", "q"), (2, None, None, None), (3, 0, "user", "b"), (3, 0, "user", "a"),
            (3, 0, "user", "a"), (3, 1, "assistant", "x" * 200_000)]
    got = run(spark, rows)
    assert got[None].n_turns == 2 and got[None].valid and got[None].loss_chars == 0
    assert got[2].turns_sha256 == hashlib.sha256(b"\n\n").hexdigest()
    whole = "user\na\nuser\na\nuser\nb\nassistant\n" + "x" * 200_000 + "\n"
    assert got[3].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest() and got[3].bad_turn == 1


def test_empty_table_and_extra_columns(spark):
    assert run(spark, []) == {}
    df = spark.createDataFrame([(1, 0, "user", "q", "f", [1])], ROWS + ", formatted string, turns array<int>")
    assert chat_digest(format_chat(df)).count() == 1


def test_template_is_checked():
    with pytest.raises(ValueError):
        ChatTemplate(start="### ")
    with pytest.raises(ValueError):
        ChatTemplate(start="<|end|>\n")
