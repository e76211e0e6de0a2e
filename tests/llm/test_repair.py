import hashlib
import itertools
import random
import re
import zlib

from ferry.llm.repair import damaged, repair_conversations, repair_digest, repaired_rows, tight_edits, turn_gaps

ROWS = "conv_id long, turn long, role string, text string"
LEGAL = re.compile("(s?(ua)+)?")
COST = {"D": 3, "I": 2, "K": 0, "R": 2}


def plain_faults(rows):
    """The first fault of each (role, text)."""
    out, seen = [], set()
    for role, text in rows:
        solid = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else
                   "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """(cost, edits, repaired rows) by trying every edit string with a partial (cost, edits) per role history."""
    best = {("", 0): (0, "", ())}                   # last role and whether anything was said -> cheapest

    def settle(states):
        """All states that inserts can reach."""
        queue = list(states.items())
        while queue:
            (last, _), (cost, edits, done) = queue.pop()
            for role in ("user", "assistant"):
                if role[0] == ("a" if last == "u" else "u"):
                    key, new = (role[0], 1), (cost + 2, edits + "I", done + ((role, ""),))
                    if key not in states or new[:2] < states[key][:2]:
                        states[key] = new
                        queue.append((key, new))
        return states

    for (role, text), fault in zip(rows, plain_faults(rows)):
        after = {}
        for (last, said), (cost, edits, done) in settle(best).items():
            moves = [("D", 3, last, said, done)]
            if fault not in ("blank", "duplicate"):
                extra = 1 if fault else 0
                due = "a" if last == "u" else "u"
                if role[:1] == due or role[:1] == "s" and not said:
                    moves.append(("K", extra, role[:1], 1, done + ((role, text),)))
                moves.append(("R", 2 + extra, due, 1, done + (("user" if due == "u" else "assistant", text),)))
            for letter, price, now, talked, turns in moves:
                new = (cost + price, edits + letter, turns)
                if (now, talked) not in after or new[:2] < after[now, talked][:2]:
                    after[now, talked] = new
        best = after
    ends = [v for (last, said), v in settle(best).items() if last == "a" or not said]
    cost, edits, turns = min(ends)
    assert LEGAL.fullmatch("".join(r[:1] for r, _ in turns))
    return cost, edits, turns


def codes_of(rows):
    number = {"": 0, "truncated": 1, "blank": 2, "duplicate": 3}
    return "".join("%x" % (4 * number[f] + ("sua".index(r[:1]) if r[:1] in ("s", "u", "a") else 3))
                   for (r, _), f in zip(rows, plain_faults(rows)))


def test_edits_against_all_edit_strings():
    """Every string of edits over short conversations, judged by the contract alone."""
    texts = {"": "Fine.", "truncated": "cut", "blank": " "}
    roles = {"s": "system", "u": "user", "a": "assistant", "t": "tool"}
    for kinds in itertools.product(itertools.product("suat", texts), repeat=2):
        rows = [(roles[r], texts[f] if f == "blank" else f"{i} {texts[f]}") for i, (r, f) in enumerate(kinds)]
        faults, found = plain_faults(rows), []
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            for edits in itertools.product("DKR", repeat=len(rows)):
                if any(e != "D" and f == "blank" for e, f in zip(edits, faults)):
                    continue
                audit = "".join("I" * k + e for k, e in zip(inserts, [*edits, ""]))
                slots = [s for k, e, (role, _) in zip(inserts, [*edits, "D"], [*rows, ("", "")])
                         for s in ["ua"] * k + ([] if e == "D" else [role[0]] if e == "K" else ["ua"])]
                if not any(LEGAL.fullmatch("".join(p)) for p in itertools.product(*slots)):
                    continue
                cost = sum(COST[e] for e in audit) + sum(e != "D" and f == "truncated" for e, f in zip(edits, faults))
                found.append((cost, audit))
        assert tight_edits(codes_of(rows)) == min(found), rows


def test_edits_against_plain_search():
    rng = random.Random(3)
    for n in [*range(0, 30), 80, 300, 1000]:
        for _ in range(8 if n < 50 else 2):
            rows = [(rng.choice(["system", "user", "user", "assistant", "assistant", "tool", ""]),
                     rng.choice(["", " ", f"{rng.randint(0, 5)}.", f"{i}!", f"{i} cut"])) for i in range(n)]
            assert tight_edits(codes_of(rows)) == plain_repair(rows)[:2]


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(name.encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def order(row):
    return row[1] is not None, row[1] or 0, row[2], hashlib.sha256(row[3].encode()).digest()


def test_query_path_against_plain_version(spark):
    rng = random.Random(4)
    rows = []
    for conv in [None, *range(120)]:
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, None, 0]), rng.choice(["system", "user", "assistant", "tool", None, ""]),
                         rng.choice([None, "", "Good.", "Good.", "no end", "Ünï? \n", f"{turn}!", "\x85", "x" * 5000])))
    rows += [(7, 3, "user", "Same.")] * 5
    rows += [(900, t, rng.choice(["user", "assistant"]), rng.choice(["ok.", f"{t}.", "cut"])) for t in range(9000)]   # several chunks
    df = spark.createDataFrame(rows, ROWS).repartition(3).withColumnRenamed("role", "role")
    numbered, plans = repair_conversations(damaged(df), turn_gaps(df))
    got = {r.conv_id: r for r in repair_digest(numbered, plans).collect()}
    texts = {}
    for r in repaired_rows(numbered, plans).orderBy("conv_id", "position").collect():
        texts.setdefault(r.conv_id, []).append((r.role, r.text))
    bad = plain_damage(rows)
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        own = sorted((x for x in bad if x[0] == conv), key=order)
        pairs = [(x[2], x[3]) for x in own]
        turns = {x[1] for x in own} - {None}
        faults = plain_faults(pairs)
        cost, edits, repaired = plain_repair(pairs)
        initials = [role[:1] for role, _ in pairs]
        assert r.gaps == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)
        assert (r.blank, r.duplicate, r.truncated) == tuple(map(faults.count, ("blank", "duplicate", "truncated")))
        assert r.illegal == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        assert (r.cost, r.audit) == (cost, edits)
        assert r.repaired_sha256 == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in repaired).encode()).hexdigest()
        assert texts.get(conv, []) == list(repaired)


def test_empty_table_dropped_conversation_and_extra_columns(spark):
    empty = spark.createDataFrame([], ROWS)
    assert repair_digest(*repair_conversations(damaged(empty), turn_gaps(empty))).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 1, "user", "Hi.", 1, "x")], ROWS + ", pos long, digest string")
    r = repair_digest(*repair_conversations(damaged(df), turn_gaps(df))).first()
    assert (r.cost, r.audit, r.gaps, r.illegal, r.repaired_sha256) == (0, "", 0, 0, hashlib.sha256(b"").hexdigest())
