"""DuckDB SQL of the registered queries, for those that SQL can express."""

from __future__ import annotations

from ferry.llm import quality

# The escape adds a backslash between '<' and '|'; markers take 9, 11 and 8 characters a turn.
CHAT = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), steps AS (
    SELECT *, row_number() OVER w - 1 AS pos, lag(role, 1, 'begin') OVER w AS before,
           row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS is_last
    FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), judged AS (
    SELECT *, NOT ((before = 'begin' AND role IN ('system', 'user')) OR (before = 'system' AND pos = 1 AND role = 'user')
        OR (before IN ('user', 'tool') AND role = 'assistant') OR (before = 'assistant' AND role IN ('user', 'tool'))) AS bad
    FROM steps
), texts AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos) AS whole,
           coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '') AS loss,
           sum(28 + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'))
                  + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) AS chars,
           min(pos) FILTER (bad) AS bad_turn, max(role) FILTER (is_last) AS last_role
    FROM judged GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       chars::BIGINT AS formatted_chars, bad_turn IS NULL AND last_role = 'assistant' AS valid,
       CASE WHEN bad_turn IS NOT NULL THEN 'reject' WHEN last_role = 'assistant' THEN 'answered'
            WHEN last_role = 'user' THEN 'asked' WHEN last_role = 'tool' THEN 'called' ELSE 'briefed' END AS end_state,
       bad_turn::INTEGER AS bad_turn
FROM texts
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

# Windows as joined words; every document word sequence of a window's length is looked up.
DECONTAMINATION = f"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWER}, {ALNUM}) AS w FROM documents
), b AS (
    SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all({LOWER}, {ALNUM}) AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
    FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)
), grams AS (
    SELECT rid, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
    FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i
          FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), hits AS (
    SELECT rid, i, size, item FROM grams JOIN windows USING (size, win)
), words AS (
    SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS p FROM hits) GROUP BY rid
), items AS (
    SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS list FROM hits GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""


def _select(steps: list[tuple[str, str]]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in steps)


def quality_sql(p: quality.McdParams = quality.McdParams()) -> str:
    """The statistics are SQL of their own; the estimation shares its arithmetic with the operator."""
    feats, pairs = quality.FEATURES, quality.PAIRS
    qs = ", ".join(f"q_{x}" for x in feats)
    group = "level, g_lang, g_source"

    def same(a: str, b: str) -> str:
        return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in quality.GROUP)

    sums = ", ".join([f"sum(q_{x}::HUGEINT) AS s_{x}" for x in feats]
                     + [f"sum(q_{a}::HUGEINT * q_{b}) AS s_{a}_{b}" for a, b in pairs])
    start = ", ".join(
        [f"quantile_cont(q_{x}, 0.5) / {quality.SCALE}e0 AS m_{x}" for x in feats]
        + [f"greatest((quantile_cont(q_{x}, 0.75) - quantile_cont(q_{x}, 0.25)) / {quality.SCALE}e0 / 1.349, {floor!r}e0)"
           f" AS l_{x}_{x}" for x, floor in zip(feats, p.floors)]
        + [f"0e0 AS l_{a}_{b}" for a, b in pairs if a != b])
    ctes = [r"""
words AS (
    SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), wins AS (
    SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS win FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM words)
), twice AS (
    SELECT rid, i FROM wins QUALIFY count(*) OVER (PARTITION BY rid, win) > 1
), covered AS (
    SELECT rid, sum(c) AS n FROM (
        SELECT rid, least(8, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 8)) AS c FROM twice) GROUP BY rid
), stats AS (
    SELECT rid, doc_id, lang, source, len(w)::BIGINT AS n_words,
           length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l)::BIGINT AS n_lines,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
           n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
    FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM words)
    LEFT JOIN covered USING (rid)
)""", f"""
scaled AS (SELECT *, {_select([(f'q_{x}', quality.feature_sql(x)) for x in feats])} FROM stats
), rws AS (
    SELECT 0 AS level, lang AS g_lang, source AS g_source, {qs} FROM scaled WHERE NOT base_failed
    UNION ALL SELECT 1, lang, NULL, {qs} FROM scaled WHERE NOT base_failed
    UNION ALL SELECT 2, NULL, NULL, {qs} FROM scaled WHERE NOT base_failed
), est0 AS (SELECT {group}, count(*) AS n_group, {start} FROM rws GROUP BY ALL)"""]
    factor = p.support / quality._chi6_cdf(quality.chi4_quantile(p.support))
    for step in range(p.steps + 1):
        last = step == p.steps
        used = p.reweight / quality._chi6_cdf(quality.chi4_quantile(p.reweight)) if last else factor
        near = f"d2 <= {quality.chi4_quantile(p.reweight)!r}e0" if last else f"bin <= cut{step}.cut"
        cut = "" if last else f"JOIN cut{step} ON {same(f'd{step}', f'cut{step}')}"
        ctes.append(f"""
d{step} AS (SELECT *, {quality.BIN_SQL} AS bin FROM (
    SELECT r.*, {_select(quality.distance_sql())} FROM rws r JOIN est{step} e ON {same('r', 'e')})
), cut{step} AS (SELECT {group}, quantile_cont(bin, {p.support}) AS cut FROM d{step} GROUP BY ALL
), sum{step} AS (SELECT {', '.join(f'd{step}.{k}' for k in quality.GROUP)}, count(*) AS n, {sums}
    FROM d{step} {cut} WHERE {near} GROUP BY ALL
), est{step + 1} AS (SELECT s.{group.replace(', ', ', s.')}, n_group, {_select(quality.scatter_sql(p.floors, used))}
    FROM sum{step} s JOIN (SELECT {group}, n_group FROM est0) o ON {same('s', 'o')})""")
    final = f"est{p.steps + 1}"
    pick = ", ".join(f"coalesce(e0.{c}, e1.{c}, e2.{c}) AS {c}"
                     for c in [f"m_{x}" for x in feats] + [f"l_{a}_{b}" for a, b in pairs])
    ctes.append(f"""
fine AS (SELECT * FROM {final} WHERE n_group >= {p.min_rows}
), judged AS (SELECT *, {_select(quality.distance_sql())} FROM (
    SELECT s.*, {pick} FROM scaled s
    LEFT JOIN fine e0 ON e0.level = 0 AND s.lang IS NOT DISTINCT FROM e0.g_lang AND s.source IS NOT DISTINCT FROM e0.g_source
    LEFT JOIN fine e1 ON e1.level = 1 AND s.lang IS NOT DISTINCT FROM e1.g_lang
    LEFT JOIN fine e2 ON e2.level = 2))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(d2 <= {quality.chi4_quantile(p.reject)!r}e0, true) AS kept
FROM judged""")
    return "WITH" + ",".join(ctes[:-1]) + "," + ctes[-1]


# Base32 of the SHA-1: each 5 hex digits are four characters.
WARC = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), f AS (
    SELECT h, min(page_id) AS first, count(*) AS n FROM p GROUP BY h
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((('0x' || substr(h, (1 + 5 * (j // 4))::INTEGER, 5))::INTEGER >> (15 - 5 * (j % 4))::INTEGER) & 31) + 1), 1)), '')
           AS payload_digest,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p JOIN f USING (h)
"""


# CRC-32 by its table: a row "crc" holds the table as a list. Bytes of a text from its hex form.
CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text, where a row of CRC_TABLE is joined."""
    bytes_of = f"list_transform(range(strlen({text})), lambda k: ('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::BIGINT)"
    return (f"xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], {bytes_of}), "
            "lambda acc, b: xor(acc >> 8, tab[(xor(acc, b) & 255) + 1])))")


def _least(*choices: str) -> str:
    return f"list_min([{', '.join(choices)}])"


def _edit(state: str, cost: str, letter: str, turn: str = "''") -> str:
    """A state (cost, edits, repaired turns) after one more edit."""
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {state}.r || {turn}}}"


def _insert(state: str, role: str) -> str:
    return _edit(state, "2", "I", f"(chr(10) || '{role}:')")


def _stay(state: str, kind: int, due: str) -> str:
    """Keep a row whose role is due, or else give it that role; a cost out of reach where it must go."""
    keep = _edit(state, f"(cut + CASE WHEN kind = {kind} THEN 0 ELSE 1000000 END)", "K", "(chr(10) || role || ':' || text)")
    return f"{keep}, " + _edit(state, "(cut + 2)", "R", f"(chr(10) || '{due}:' || text)")


_FAR = "{'c': 1000000::BIGINT, 'a': '', 'r': ''}"
_AUDIT_USER = _least("q2", _insert("q0", "user"), _insert("q1", "user"), _insert("q3", "user"))

# Forward over the rows of all conversations at once: per state the least (cost, edits).
REPAIR = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}), named AS (
    SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS row_name FROM conversations
), faults AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql("row_name")} % 20 AS f
    FROM named, crc
), damaged AS (
    SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN f = 1 THEN '' WHEN f = 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM faults, (SELECT unnest([0, 1]) AS copy) WHERE f <> 0 AND (copy = 0 OR f = 3)
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos,
           regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS solid FROM damaged
), judged AS (
    SELECT conv_id, turn, role, text, pos, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN strpos('sua', left(role, 1)) - 1 ELSE 3 END AS kind,
           left(role, 1) || lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS pair,
           CASE WHEN solid = '' THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS fault
    FROM ordered
), costed AS (
    SELECT *, CASE fault WHEN 'truncated' THEN 1 WHEN 'sound' THEN 0 ELSE 1000000 END AS cut FROM judged
), facts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM costed GROUP BY conv_id
), steps AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS pos, {{'c': 0::BIGINT, 'a': '', 'r': ''}} AS q0, {_FAR} AS q1, {_FAR} AS q2, {_FAR} AS q3
    FROM conversations
    UNION ALL
    SELECT conv_id, pos, {_edit("q0", "3", "D")}, {_least(_edit("q1", "3", "D"), _edit("q0", "(cut + CASE WHEN kind = 0 THEN 0 ELSE 1000000 END)", "K", "(chr(10) || role || ':' || text)"))},
           {_least(_edit("u", "3", "D"), *(_stay(q, 1, "user") for q in ("q0", "q1", "a")))},
           {_least(_edit("a", "3", "D"), _stay("u", 2, "assistant"))}
    FROM (SELECT s.*, {_AUDIT_USER} AS u, {_least("q3", _insert("q2", "assistant"), _insert(f"({_AUDIT_USER})", "assistant"))} AS a FROM steps s)
        AS s (conv_id, before, q0, q1, q2, q3, u, a)
    JOIN (SELECT conv_id AS conv, pos, role, text, kind, cut FROM costed) AS c ON conv IS NOT DISTINCT FROM conv_id AND pos = before + 1
), ends AS (
    SELECT s.conv_id, {_least("q0", "q3", _insert("q2", "assistant"), _insert(f"({_insert('q1', 'user')})", "assistant"))} AS best,
           gaps, blank, duplicate, truncated, illegal
    FROM steps s LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM s.conv_id
    WHERE s.pos = coalesce(f.n, 0)
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.a AS audit,
       sha256(substr(best.r, 2)) AS repaired_sha256
FROM ends
"""
# Words that differ by one code point share a word with that place left out.
SPELLING = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}), runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS named, run, count(*) AS times FROM (
        SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
    WHERE length(run) >= 7 GROUP BY ALL
), hashed AS (
    SELECT run, times, {crc32_sql("named")} AS h FROM runs, crc
), words AS (
    SELECT word, sum(times)::BIGINT AS n FROM (
        SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times
        FROM hashed)
    WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
), cut AS (
    SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), pairs AS (
    SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word AND length(a.word) = length(b.word)
    UNION SELECT cut.word, w.word, w.n FROM cut JOIN words w ON cut.rest = w.word
    UNION SELECT w.word, cut.word, cut.n FROM cut JOIN words w ON cut.rest = w.word
), near AS (
    SELECT word, count(*) AS n_near, max(n) AS best_n, arg_min(other, {{'least': -n, 'other': other}}) AS best FROM pairs GROUP BY word
), formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN best END AS form,
           CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n
    FROM words w LEFT JOIN near USING (word)
), chain AS (
    SELECT word, word AS reached, 0 AS steps FROM formed
    UNION ALL SELECT c.word, f.form, steps + 1 FROM chain c JOIN formed f ON f.word = c.reached WHERE f.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, arg_max(reached, steps) AS root FROM chain GROUP BY word) USING (word)
"""

# Windows of 200 bytes as 400 hex digits, by their MD5; then islands of covered bytes.
REPEATS = """
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, ''))::BIGINT AS n FROM documents
), windows AS (
    SELECT rid, i, md5(substr(h, 2 * i + 1, 400)) AS w FROM (SELECT rid, h, unnest(range(n - 199)) AS i FROM d WHERE n >= 200)
), repeated AS (
    SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before
    FROM (SELECT rid, i, count(*) OVER (PARTITION BY w) AS times FROM windows) WHERE times > 1
), islands AS (
    SELECT rid, min(i) AS a, max(i) + 200 AS b
    FROM (SELECT rid, i, count(*) FILTER (before IS NULL OR i > before + 200) OVER (PARTITION BY rid ORDER BY i) AS island FROM repeated)
    GROUP BY rid, island
), cuts AS (
    SELECT rid, a, b, lag(b, 1, 0) OVER (PARTITION BY rid ORDER BY a) AS kept_from FROM islands
), kept AS (
    SELECT rid, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS tail,
           string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a) AS head
    FROM cuts JOIN d USING (rid) GROUP BY rid
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""


ORACLE: dict[str, str] = {
    "op5_decontamination": DECONTAMINATION,
    "op6_quality_mcd": quality_sql(),
    "op7_chat_format": CHAT,
    "op8_warc_normaliser": WARC,
    "op11_conversation_repair": REPAIR,
    "op12_spelling_variants": SPELLING,
    "op13_suffix_dedup": REPEATS,
}
