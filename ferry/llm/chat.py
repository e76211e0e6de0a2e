"""Chat formatting: a finite-state machine over roles plus a declarative template.

``format_chat`` turns rows (conversation, turn, role, text) into one row per conversation with the
segments of its formatted text, each with a loss flag, and the verdict of the state machine.
``read_back`` parses a formatted text into its turns again. Everything is built from SQL functions.

Markers. Every marker of a template begins with ``<|``. Inside roles and texts, ``<`` followed by
any number of backslashes and ``|`` gets one backslash more, so a formatted text contains ``<|``
only where a marker begins, and the reader takes that backslash away again. All other text,
backslashes and foreign markers included, stays as it is.

Edge cases. Null text and null role count as empty. Rows of equal turn are ordered by role, then
text; repeated rows are turns of their own. Rows with a null conversation id form one conversation.
Null turns come first. An unknown role, or one out of order, leads to the state ``reject``;
``bad_turn`` is the 0-based position where that happened. Such conversations are formatted all the
same (their flag tells), so nothing is lost. Extra input columns are ignored; an empty table gives
an empty result. One conversation is one output row, so its text has to fit into a row (2 GB).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REJECT = "reject"


@dataclass(frozen=True)
class ChatTemplate:
    """Markers, roles under the loss, and the transitions ``(state, role) -> state``."""

    start: str = "<|start|>"
    message: str = "<|message|>"
    end: str = "<|end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    begin: str = "begin"
    accept: tuple[str, ...] = ("answered",)
    transitions: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("begin", "system"): "briefed",
        ("begin", "user"): "asked",
        ("briefed", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
        ("answered", "tool"): "called",
        ("called", "assistant"): "answered",
    })

    def __post_init__(self) -> None:
        for marker in (self.start, self.message, self.end):
            if not marker.startswith("<|") or marker.count("<|") != 1:
                raise ValueError(f"marker {marker!r} must begin with '<|' and hold it once")
        if len({self.start, self.message, self.end}) < 3:
            raise ValueError("the markers must differ")
        if any("\x1f" in state + role or nxt == REJECT for (state, role), nxt in self.transitions.items()):
            raise ValueError(f"states and roles may not hold U+001F; {REJECT!r} is reserved")


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", "<$1|")


def _run_machine(turns: Column, template: ChatTemplate) -> Column:
    """struct(state, at, bad): the end state and the position of the first refused turn."""
    pairs = [F.lit(x) for (state, role), nxt in template.transitions.items() for x in (f"{state}\x1f{role}", nxt)]
    table = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")

    def step(acc: Column, turn: Column) -> Column:
        nxt = F.coalesce(F.try_element_at(table, F.concat(acc["state"], F.lit("\x1f"), turn["role"])), F.lit(REJECT))
        first_bad = acc["bad"].isNull() & (nxt == REJECT)
        return F.struct(nxt.alias("state"), (acc["at"] + 1).alias("at"),
                        F.when(first_bad, acc["at"]).otherwise(acc["bad"]).alias("bad"))

    zero = F.struct(F.lit(template.begin).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))
    return F.aggregate(turns, zero, step)


def format_chat(rows: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """conv_id, segments array<struct<text, loss>>, formatted, valid, end_state, bad_turn."""
    none = F.lit("")
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("turn"), F.coalesce("role", none).alias("role"), F.coalesce("text", none).alias("text")))).alias("turns"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def turn_segments(t: Column) -> Column:
        head = F.concat(F.lit(template.start), escape(t["role"]), F.lit(template.message))
        return F.array(segment(head, F.lit(False)),
                       segment(escape(t["text"]), t["role"].isin(*template.loss_roles)),
                       segment(F.lit(template.end), F.lit(False)))

    machine = turns.select("conv_id", F.flatten(F.transform("turns", turn_segments)).alias("segments"),
                           _run_machine(F.col("turns"), template).alias("m"))
    return machine.select(
        "conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        F.col("m.state").isin(*template.accept).alias("valid"),
        F.col("m.state").alias("end_state"), F.col("m.bad").alias("bad_turn"))


def read_back(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """array<struct<role, text>>: the turns of a formatted text, unescaped."""
    # Markers hold "<|", which roles and texts never do, so cutting at them is unambiguous. The
    # last piece is what follows the last end marker: nothing.
    pieces = F.split(formatted, re.escape(template.end))
    turns = F.slice(pieces, 1, F.size(pieces) - 1)

    def parse(piece: Column) -> Column:
        head = F.substring(piece, len(template.start) + 1, 2**31 - 1)
        at = F.locate(template.message, head)
        return F.struct(unescape(head.substr(F.lit(1), at - 1)).alias("role"),
                        unescape(head.substr(at + len(template.message), F.lit(2**31 - 1))).alias("text"))

    return F.transform(turns, parse)


def chat_digest(chats: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Counts and digests of ``format_chat``'s output, read back from the formatted text."""
    # The mask marks whole segments; under it the segments' texts follow each other directly.
    masked = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    read = chats.select("conv_id", "valid", "end_state", "bad_turn", "formatted",
                        read_back(F.col("formatted"), template).alias("turns"),
                        F.array_join(masked, "").alias("loss_text"))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid", "end_state", "bad_turn")
