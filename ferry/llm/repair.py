"""Conversation structure repair: the cheapest edits that make the roles of a conversation legal.

A legal conversation is empty or an optional system turn followed by user/assistant pairs: its role
initials read ``(s?(ua)+)?``. Edits, in ASCII order: ``D`` delete a row (3), ``I`` insert an empty user
or assistant turn anywhere (2), ``K`` keep a row (0), ``R`` give a row the role user or assistant (2).
Blank and duplicate rows have to be deleted; every truncated row that stays adds 1. Among the cheapest
edit strings the ASCII-least is taken.

Method. The states of the grammar are: nothing yet, after the system turn, after a user turn, after an
assistant turn. ``cost[i][state]`` is the least cost of legalising rows i.. from a state. It is computed
backwards, but stored at every sqrt(n)-th row only; the walk forward recomputes one block of vectors at
a time from the checkpoint at its end and takes the least letter that is still tight. So a conversation
of n rows needs n bytes of codes and some 2 sqrt(n) vectors, less than its own edit string takes.

On Spark. Rows are dealt by range of (conversation, turn, role, text digest), so a conversation that
holds a third of all rows is spread over tasks, and written with their position. Faults are found by
aggregates and joins on narrow columns. A row becomes one hex digit, 4,096 of them one chunk; the chunks
of a conversation meet for the edit string. Rows then stream past that string, sorted by position, in one
task per conversation, with a batch of rows in memory: a digest of its whole text is sequential.

Edge cases. Null roles and texts count as one space. Rows come by turn, null turns first, rows of
equal turn by role and text digest. A null conversation id is a conversation of its own. Roles count by
their first character, ``s``, ``u`` or ``a`` (case matters); any other role, the empty one included, cannot
be kept. Repeated rows are duplicates. Texts of any length pass through in batches. Extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ferry.llm.common import written

INITIALS = "sua"
#: Fault of a row, times four in its code; the rest is the index in INITIALS, or 3.
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
DELETE, INSERT, REROLE, CUT = 3, 2, 2, 1
CHUNK_BITS = 12
#: State after a turn of the role that is due; states: begin, after system, after user, after assistant.
NEXT = (2, 2, 3, 2)
ROLE_OF = {2: "user", 3: "assistant"}
FAR = 1 << 60
COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")


def number_rows(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, digest, pos``: a written table whose ``pos`` gives the order of all rows."""
    space = F.lit(" ")
    keyed = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    keyed = keyed.withColumn("digest", F.unhex(F.sha2("text", 256)))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest")]
    dealt = keyed.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    return written(dealt.withColumn("pos", F.monotonically_increasing_id()), "repair-rows")


def row_codes(numbered: DataFrame) -> DataFrame:
    """``conv_id, pos, code``: initial and first fault of each row as one hex digit."""
    first = numbered.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    solid = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    fault = (F.when(solid == "", BLANK).when(F.col("first").isNull(), DUPLICATE)
             .when(~F.substring(solid, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND))
    initial = F.substring("role", 1, 1)
    kind = F.lit(len(INITIALS))
    for i, c in enumerate(INITIALS):
        kind = F.when(initial == c, i).otherwise(kind)
    return numbered.join(first, "pos", "left").select("conv_id", "pos", F.lower(F.hex((fault * 4 + kind).cast("long"))).alias("code"))


def _with_inserts(direct: list[int]) -> tuple[int, int, int, int]:
    """Costs of all states when turns may be inserted before the next row."""
    user, answer = min(direct[2], INSERT + direct[3]), min(direct[3], INSERT + direct[2])
    return min(direct[0], INSERT + user), min(direct[1], INSERT + user), user, answer


def _moves(code: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that use up a row, in ASCII order."""
    kind, fault = code & 3, code >> 2
    moves = [("D", DELETE, state)]
    if fault in (BLANK, DUPLICATE):
        return moves
    cut = CUT if fault == TRUNCATED else 0
    due = NEXT[state]
    if kind == due - 1:
        moves.append(("K", cut, due))
    elif kind == 0 and state == 0:
        moves.append(("K", cut, 1))
    moves.append(("R", REROLE + cut, due))
    return moves


MOVES = [[_moves(code, state) for state in range(4)] for code in range(16)]
END = _with_inserts([0, FAR, FAR, 0])


def _before(code: int, after: tuple[int, int, int, int]) -> tuple[int, int, int, int]:
    return _with_inserts([min(cost + after[then] for _, cost, then in moves) for moves in MOVES[code]])


def tight_edits(codes: str) -> tuple[int, str]:
    """Least cost of a conversation of such row codes, and its ASCII-least edit string."""
    rows = [int(c, 16) for c in codes]
    n = len(rows)
    block = isqrt(n) + 1
    checkpoints: dict[int, tuple[int, int, int, int]] = {n: END}
    vector = END
    for i in range(n - 1, -1, -1):
        vector = _before(rows[i], vector)
        if i % block == 0:
            checkpoints[i] = vector
    cost, state, out = vector[0], 0, []
    for start in range(0, n, block):
        end = min(start + block, n)
        vectors = [checkpoints[end]]
        for i in range(end - 1, start - 1, -1):
            vectors.append(_before(rows[i], vectors[-1]))
        for i in range(start, end):
            here, after = vectors[end - i], vectors[end - i - 1]
            while True:
                tight = [(letter, then) for letter, cost_of, then in MOVES[rows[i]][state] if cost_of + after[then] == here[state]]
                if here[NEXT[state]] + INSERT == here[state] and not (tight and tight[0][0] == "D"):
                    out.append("I")
                    state = NEXT[state]
                    continue
                letter, state = tight[0]
                out.append(letter)
                break
    while END[state]:
        out.append("I")
        state = NEXT[state]
    return cost, "".join(out)


@lru_cache(1 << 16)
def _short_edits(codes: str) -> tuple[int, str]:
    return tight_edits(codes)


def _faults(codes: str) -> tuple[int, int, int, int]:
    kinds = [int(c, 16) & 3 for c in codes]
    legal = {(0, 1), (1, 2), (2, 1)}
    illegal = sum(pair not in legal for pair in zip(kinds, kinds[1:]))
    return (*(sum(int(c, 16) >> 2 == fault for c in codes) for fault in (BLANK, DUPLICATE, TRUNCATED)), illegal)


@lru_cache(1 << 16)
def _short_faults(codes: str) -> tuple[int, int, int, int]:
    return _faults(codes)


def _row_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096, most_chars: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(x) for x in row if isinstance(x, str))
        if len(held) == most or chars > most_chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def edit_plans(numbered: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per row of ``conversations`` (``conv_id``, any further columns are kept): fault counts, ``cost``, ``audit``."""
    kept = [f for f in conversations.schema.fields if f.name != "conv_id"]
    chunk = F.shiftright("pos", CHUNK_BITS).alias("chunk")
    digits = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"]), "")
    chunks = row_codes(numbered).groupBy("conv_id", chunk).agg(digits.alias("codes"))
    heads = conversations.withColumn("chunk", F.lit(-1).cast("long"))
    both = heads.unionByName(chunks, allowMissingColumns=True).select("conv_id", "chunk", "codes", *[f.name for f in kept])
    key = conversations.schema["conv_id"]
    schema = StructType([key, *kept, *[StructField(c, LongType()) for c in COUNTS], StructField("audit", StringType())])
    shape = _arrow(schema)

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def plans() -> Iterator[tuple]:
            for conv, rows in groupby(_row_stream(batches), key=lambda r: r[0]):
                head, pieces = (), []
                for row in rows:
                    if row[1] < 0:
                        head = row[3:]
                    else:
                        pieces.append(row[2])
                codes = "".join(pieces)
                short = len(codes) <= 64
                cost, audit = (_short_edits if short else tight_edits)(codes)
                yield (conv, *head, *(_short_faults if short else _faults)(codes), cost, audit)

        yield from _batched(plans(), shape)

    return both.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(plan, schema)


def _beside_plans(numbered: DataFrame, plans: DataFrame) -> DataFrame:
    """Each conversation's plan, then its rows by position, in one partition."""
    heads = plans.withColumns({"pos": F.lit(-1).cast("long"), "role": F.lit(None).cast("string"), "text": F.col("audit")}).drop("audit")
    rows = heads.unionByName(numbered.select("conv_id", "pos", "role", "text"), allowMissingColumns=True)
    head_columns = [c for c in plans.columns if c not in ("conv_id", "audit")]
    return (rows.select("conv_id", "pos", "role", "text", *head_columns)
            .repartition("conv_id").sortWithinPartitions("conv_id", "pos"))


def _repaired(rows: Iterator[tuple]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired turns; the first row holds the edit string, the others are the conversation."""
    audit = next(rows)[3]
    state = 0
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            yield letter, ROLE_OF[state], ""
            continue
        _, _, role, text, *_ = next(rows)
        if letter == "K":
            state = 1 if state == 0 and role[:1] == "s" else NEXT[state]
            yield letter, role, text
        elif letter == "R":
            state = NEXT[state]
            yield letter, ROLE_OF[state], text


def repaired_rows(numbered: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, position, edit, role, text``."""
    schema = StructType([numbered.schema["conv_id"], StructField("position", LongType()),
                         *[StructField(c, StringType()) for c in ("edit", "role", "text")]])
    shape = _arrow(schema)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = ((conv, i, *turn) for conv, rows in groupby(_row_stream(batches), key=lambda r: r[0])
                 for i, turn in enumerate(_repaired(rows)))
        yield from _batched(turns, shape)

    return _beside_plans(numbered, plans).mapInArrow(emit, schema)


def repair_digest(numbered: DataFrame, plans: DataFrame) -> DataFrame:
    """The plans with ``repaired_sha256``: the digest of the repaired ``role:text``, joined by line breaks."""
    heads = [f for f in plans.schema.fields if f.name not in ("conv_id", "audit")]
    schema = StructType([plans.schema["conv_id"], *heads, plans.schema["audit"], StructField("repaired_sha256", StringType())])
    shape = _arrow(schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[tuple]:
            for conv, rows in groupby(_row_stream(batches), key=lambda r: r[0]):
                head = next(rows)
                total = hashlib.sha256()
                for i, (_, role, text) in enumerate(_repaired(iter_first(head, rows))):
                    total.update(f"{chr(10) if i else ''}{role}:{text}".encode())
                yield (conv, *head[4:], head[3], total.hexdigest())

        yield from _batched(digests(), shape)

    return _beside_plans(numbered, plans).mapInArrow(digest, schema)


def iter_first(first: tuple, rest: Iterator[tuple]) -> Iterator[tuple]:
    yield first
    yield from rest


def repair_conversations(rows: DataFrame, conversations: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(numbered rows, plans) of ``conv_id, turn, role, text``; ``conversations`` may name further ids and columns.

    Both are written tables; ``repaired_rows`` and ``repair_digest`` take them.
    """
    numbered = number_rows(rows)
    ids = conversations if conversations is not None else numbered.select("conv_id").distinct()
    return numbered, written(edit_plans(numbered, ids), "repair-plans")


def fault_number(conv_id: Column, turn: Column, faults: int = 20) -> Column:
    """Which damage a row gets: crc32 of ``conv_id:turn`` (null: one space), modulo ``faults``."""
    part = [F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv_id, turn)]
    return F.crc32(F.encode(F.concat(part[0], F.lit(":"), part[1]), "UTF-8")) % faults


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with planted faults: 0 drops a row, 1 empties its text, 2 takes its
    ``.!?``, 3 repeats it, 4 makes it a user's. Null roles and texts become one space."""
    kind = fault_number(F.col("conv_id"), F.col("turn"))
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def turn_gaps(conversations: DataFrame) -> DataFrame:
    """``conv_id, gaps`` for every conversation: turns missing between the least and the largest that are left."""
    left = F.when(fault_number(F.col("conv_id"), F.col("turn")) != 0, F.col("turn"))
    gaps = F.max("t") - F.min("t") + 1 - F.count_distinct("t")
    return (conversations.select("conv_id", left.alias("t")).groupBy("conv_id")
            .agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps")))
