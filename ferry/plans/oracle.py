"""DuckDB SQL for each registered query: the same fixtures and semantics in SQL of its own, so that
the two sides are independent derivations of one answer."""

from __future__ import annotations

from ferry.plans.fixtures import (
    FIXTURE_ALIASES,
    FIXTURE_CANONICAL,
    FIXTURE_CUTOFF,
    FIXTURE_DOMAINS,
    FIXTURE_STATUSES,
)
from ferry.constants import OBJECT_STEPS
from ferry.plans.queries import EXPECTED_LAYOUT, ORDER_TRANSFORM_SQL, RUN_TS, TABLES
from ferry.functions.text import utc_millis_stamp
from ferry.sources.sqltext import statement_text


def _v(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _domain(k: str) -> str:
    a, b, c, d = FIXTURE_DOMAINS
    return f"(CASE ({k}) % 4 WHEN 0 THEN '{a}' WHEN 1 THEN '{b}' WHEN 2 THEN '{c}' ELSE '{d}' END)"


def _key(e: str) -> str:
    aliases = ", ".join(f"'{a}'" for a in FIXTURE_ALIASES)
    label = f"regexp_extract({e}, '@([^.]+)', 1)"
    return (f"lower(split_part({e}, '@', 1) || '@' || CASE WHEN {label} IN ({aliases}) "
            f"THEN '{FIXTURE_CANONICAL}' ELSE {label} END)")


# --- fixtures --------------------------------------------------------------------------------------

RAW_ORDER = (f"SELECT {_v('o_orderkey')} AS Id, {_v('o_custkey')} AS OwnerId, o_orderstatus, "
             "o_totalprice, o_orderpriority FROM orders")
LOADED_LINE = f"SELECT {_v('l_orderkey')} AS Migration_Id__c, l_linenumber, l_suppkey FROM lineitem"
RAW_LINE = (f"SELECT {_v('l_orderkey')} || '-' || {_v('l_linenumber')} AS Id, l_orderkey, l_linenumber, "
            "l_quantity, l_returnflag FROM lineitem")
LINE_AS_RAW = (f"SELECT {_v('l_orderkey')} AS Id, l_linenumber, l_partkey, l_suppkey, l_quantity, "
               "l_extendedprice, l_returnflag, l_linestatus FROM lineitem")
SUCCESS_ORDERS = (f"SELECT {_v('o_orderkey')} AS Migration_Id__c, 'N' || {_v('o_orderkey')} AS sf__Id "
                  "FROM orders WHERE o_orderstatus = 'F'")
SUCCESS_PAIRS = f"SELECT {_v('l_orderkey')} AS Migration_Id__c, 'S' || {_v('l_suppkey')} AS sf__Id FROM lineitem"
OUTCOMES = (f"SELECT 'order' AS object, {_v('o_orderkey')} AS source_id, CAST(o_orderkey % 7 AS BIGINT) AS job_id, "
            "CASE WHEN o_orderstatus = 'F' THEN 'success' WHEN o_orderstatus = 'O' THEN 'error' "
            "ELSE 'unprocessed' END AS outcome, "
            f"CASE WHEN o_orderstatus = 'F' THEN 'N' || {_v('o_orderkey')} END AS target_id FROM orders")
LEGACY_USER = (
    f"SELECT 'L' || lpad({_v('c_custkey')}, 9, '0') AS Id, "
    "CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 50 = 1 THEN 'nodomain' "
    f"ELSE 'U' || {_v('c_custkey % 900')} || '@' || {_domain('c_nationkey')} END AS Email, "
    f"'u' || {_v('c_custkey % 900')} || '@' || {_domain('c_custkey')} AS Username, "
    "CASE WHEN c_acctbal >= 0 THEN 'true' ELSE 'false' END AS IsActive FROM customer")
TARGET_USER = (
    f"SELECT 'T' || lpad({_v('c_custkey')}, 9, '0') AS Id, "
    f"'u' || {_v('c_custkey % 900')} || '@' || "
    f"{_domain('CASE WHEN c_nationkey % 4 = 1 THEN c_nationkey + 1 ELSE c_nationkey END')} AS Email, "
    f"'u' || {_v('c_custkey % 900')} || '@' || {_domain('c_custkey')} AS Username, "
    "CASE WHEN c_mktsegment = 'BUILDING' THEN 'false' ELSE 'true' END AS IsActive "
    "FROM customer WHERE c_custkey % 3 <> 0")
_HAS_TARGET = "c_custkey % 10 NOT IN (0, 1)"
USER_CROSSWALK = (
    f"SELECT ' ' || {_v('c_custkey')} AS legacy_user_id, "
    f"CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN '' ELSE 'T' || {_v('c_custkey')} END AS tfm_user_id, "
    f"c_name AS legacy_email, 'u' || {_v('c_custkey')} AS legacy_username, "
    "CASE WHEN c_acctbal >= 0 THEN ' true ' ELSE 'false' END AS legacy_isactive, "
    f"CASE WHEN {_HAS_TARGET} THEN 'true' END AS tfm_isactive, "
    f"CASE WHEN {_HAS_TARGET} THEN 't' || {_v('c_custkey')} || '@alphaco.net' END AS tfm_email, "
    f"CASE WHEN {_HAS_TARGET} THEN 't' || {_v('c_custkey')} END AS tfm_username "
    "FROM customer WHERE c_custkey % 7 <> 0")
OWNED_ORDER = f"SELECT {_v('o_orderkey')} AS Id, ' ' || {_v('o_custkey')} || ' ' AS OwnerId FROM orders"
DOCUMENT_CRLF = ("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN replace(text, chr(10), chr(13) || chr(10)) "
                 "ELSE text END AS text, lang, source, n_chars FROM documents")
CONTRACTS = (f"SELECT {_v('o_orderkey')} AS Id, {_v('o_custkey')} AS AccountId, o_orderdate AS CreatedDate, "
             "o_orderstatus FROM orders")
ACCOUNTS = f"SELECT {_v('c_custkey')} AS Id, c_mktsegment AS Status FROM customer"
LINE_LINKS = (f"SELECT {_v('l_orderkey')} AS LinkedEntityId, {_v('l_orderkey')} || '-' || {_v('l_linenumber')} "
              "AS ContentDocumentId FROM lineitem")
DOCUMENT_LINKS = (f"SELECT 'C' || {_v('doc_id % 25')} AS LinkedEntityId, {_v('doc_id')} AS ContentDocumentId "
                  "FROM documents")
DOCUMENT_VERSIONS = (
    f"SELECT {_v('c.conv_id')} || '-' || lpad({_v('c.turn')}, 3, '0') AS Id, {_v('c.conv_id')} AS ContentDocumentId, "
    "CASE WHEN c.turn % 5 = 4 THEN NULL ELSE p.url END AS Title, "
    "CASE c.turn % 3 WHEN 0 THEN 'pdf' WHEN 1 THEN '' ELSE NULL END AS FileExtension, "
    "c.turn >= m.last_turn - 1 AS IsLatest "
    "FROM conversations c JOIN (SELECT conv_id, max(turn) AS last_turn FROM conversations GROUP BY conv_id) m "
    "ON c.conv_id = m.conv_id LEFT JOIN pages p ON c.conv_id % 25 + (c.conv_id // 50) * 25 = p.page_id")
CONTRACT_LINKS = (f"SELECT {_v('l_orderkey')} AS LinkedEntityId, {_v('l_partkey')} AS ContentDocumentId FROM lineitem")
CONTRACT_ATTACHMENTS = (f"SELECT 'A' || {_v('page_id')} AS Id, {_v('page_id')} AS ParentId, url AS Name FROM pages")
PAGE_ATTACHMENTS = (f"SELECT 'A' || {_v('page_id')} AS Id, {_v('page_id % 20')} AS ParentId, url AS Name FROM pages")
CONTRACT_PARENTS = (f"SELECT 'P' || lpad({_v('c_custkey')}, 6, '0') AS Id, {_v('c_custkey % 17')} AS Migration_Id__c "
                    "FROM customer")
DOCUMENT_FILES = (f"SELECT {_v('doc_id % 20')} || '_doc' || {_v('doc_id')} || '.txt' AS file_name, "
                  "text FROM documents")


def _with(**ctes: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items()) + "\n"


def _rest(n: str) -> str:
    return f"CASE WHEN strpos({n}, '_') > 0 THEN substr({n}, strpos({n}, '_') + 1) ELSE '' END"


def _file_name(parent: str, name: str, ext: str | None = None) -> str:
    base = f"{parent} || '_' || {name}"
    if ext is None:
        return base
    return f"{base} || CASE WHEN {ext} IS NOT NULL AND {ext} <> '' THEN '.' || {ext} ELSE '' END"


def _safe(x: str) -> str:
    return f"replace(replace({x}, '/', '_'), '\\', '_')"


# A user's target is the one that no other target with equal keys comes before.
IDENTITY = _with(
    legacy_user=LEGACY_USER, target_user=TARGET_USER,
    keyed=(f"SELECT Id, IsActive, Email, Username, {_key('Email')} AS k1, {_key('Username')} AS k2 FROM target_user"),
    firsts=("SELECT k1, k2, min(Id) AS best, arg_min(IsActive, Id) AS act, arg_min(Email, Id) AS mail, "
            "arg_min(Username, Id) AS login FROM keyed WHERE k1 IS NOT NULL AND k2 IS NOT NULL GROUP BY ALL"),
    matched=("SELECT Id AS legacy_user_id, IsActive AS legacy_isactive, Email AS legacy_email, "
             "Username AS legacy_username, best AS tfm_user_id, act AS tfm_isactive, mail AS tfm_email, "
             "k1 AS tfm_email_trimmed, login AS tfm_username, k2 AS tfm_username_trimmed, 1::INTEGER AS rn "
             f"FROM legacy_user LEFT JOIN firsts ON k1 = {_key('Email')} AND k2 = {_key('Username')}"))


def _remap(source_key: str, user_key: str) -> str:
    """Records with a user, and records for which there is none."""
    found = ("tfm_user_id AS owner_id, legacy_email, legacy_username, trim(legacy_isactive) AS legacy_isactive, "
             "tfm_isactive, tfm_email, tfm_username")
    none = ", ".join(f"NULL::VARCHAR AS {c}" for c in ("owner_id", "legacy_email", "legacy_username", "legacy_isactive",
                                                       "tfm_isactive", "tfm_email", "tfm_username"))
    head = "Id AS id, Id AS migration_id, OwnerId AS src_owner_id"
    return _with(
        owned_order=OWNED_ORDER, user_crosswalk=USER_CROSSWALK,
        wanted=f"SELECT *, {source_key} AS want FROM owned_order", known=f"SELECT *, {user_key} AS have FROM user_crosswalk",
        remapped=(f"SELECT {head}, {found} FROM wanted, known WHERE want = have UNION ALL SELECT {head}, {none} FROM wanted "
                  "WHERE NOT EXISTS (SELECT 1 FROM known WHERE have = want)"))


REMAP = _remap("trim(OwnerId)", "trim(legacy_user_id)")
REMAP_EXACT = _remap("rtrim(OwnerId)", "legacy_user_id")

ELIGIBLE = _with(
    contracts=CONTRACTS, accounts=ACCOUNTS, line_links=LINE_LINKS,
    eligible=("SELECT Id, AccountId, o_orderstatus FROM contracts WHERE AccountId IN "
              f"(SELECT Id FROM accounts WHERE Status IN ({', '.join(repr(s) for s in FIXTURE_STATUSES)})) "
              f"AND CAST(CreatedDate AS DATE) <= DATE '{FIXTURE_CUTOFF}'"))

def _manifest(links: str) -> str:
    return MANIFEST_TEMPLATE.replace("/*links*/", links)


MANIFEST_TEMPLATE = _with(
    document_links="/*links*/", document_versions=DOCUMENT_VERSIONS,
    ranked=("SELECT *, ROW_NUMBER() OVER (PARTITION BY ContentDocumentId ORDER BY Id) AS rn "
            "FROM document_versions WHERE IsLatest"),
    manifest=("SELECT l.LinkedEntityId AS linked_entity_id, v.ContentDocumentId AS content_document_id, "
              "v.Id AS version_id, v.Title AS title, v.FileExtension AS file_extension, "
              "CASE WHEN v.Title IS NOT NULL THEN "
              + _file_name("l.LinkedEntityId",
                           _safe("trim(regexp_replace(v.Title, '\\.\\w{3,4}$', ''))"), "v.FileExtension")
              + " END AS file_name, CASE WHEN v.Title IS NULL THEN 'failed' ELSE 'ready' END AS status "
              "FROM document_links l JOIN ranked v ON l.ContentDocumentId = v.ContentDocumentId AND v.rn = 1"))

MANIFEST = _manifest(DOCUMENT_LINKS)
# The links of eligible contracts only.
ELIGIBLE_MANIFEST = _manifest(
    f"SELECT k.* FROM ({CONTRACT_LINKS}) k SEMI JOIN ({ELIGIBLE} SELECT Id FROM eligible) e ON k.LinkedEntityId = e.Id")

PAGE_FILES = _with(
    page_attachments=PAGE_ATTACHMENTS, contract_parents=CONTRACT_PARENTS,
    files=("SELECT Id AS attachment_id, ParentId AS parent_id, Name AS name, "
           f"{_file_name('ParentId', _safe('Name'))} AS file_name, "
           "CASE WHEN Name IS NULL THEN 'failed' ELSE 'ready' END AS status FROM page_attachments"),
    parents="SELECT Migration_Id__c AS key, min(Id) AS parent_id FROM contract_parents GROUP BY Migration_Id__c",
    lookup=("SELECT f.file_name, split_part(f.file_name, '_', 1) AS migration_id, "
            f"{_rest('f.file_name')} AS name, p.parent_id, "
            "CASE WHEN p.parent_id IS NULL THEN 'no_parent' ELSE 'ready' END AS status "
            "FROM files f LEFT JOIN parents p ON split_part(f.file_name, '_', 1) = p.key"))

DOC_FILES = _with(
    document_files=DOCUMENT_FILES, contract_parents=CONTRACT_PARENTS,
    parents="SELECT Migration_Id__c AS key, min(Id) AS parent_id FROM contract_parents GROUP BY Migration_Id__c",
    lookup=("SELECT f.file_name, f.text, split_part(f.file_name, '_', 1) AS migration_id, "
            f"{_rest('f.file_name')} AS name, p.parent_id, "
            "CASE WHEN p.parent_id IS NULL THEN 'no_parent' ELSE 'ready' END AS status "
            "FROM document_files f LEFT JOIN parents p ON split_part(f.file_name, '_', 1) = p.key"))

_TABLE_LIST = ", ".join(f"'{t}'" for t in TABLES)
CATALOG = ("SELECT table_name AS object_name, CAST(ordinal_position AS INTEGER) AS position, column_name "
           f"FROM information_schema.columns WHERE table_name IN ({_TABLE_LIST})")
_EXPECTED_VALUES = ", ".join(f"('{o}', {p}, '{c}')" for o, p, c in EXPECTED_LAYOUT)

_CSV_TRIM = r"regexp_replace({x}, '^[\x01-\x20]+|[\x01-\x20]+$', '', 'g')"


def _csv_text(x: str) -> str:
    return f"NULLIF({_CSV_TRIM.format(x=x)}, '')"


def _scrub(x: str) -> str:
    return f"regexp_replace({x}, '[\\n\\r]', ' ', 'g')"


ORACLE: dict[str, str] = {
    "orphan_records": _with(raw_order=RAW_ORDER, loaded_line=LOADED_LINE) +
        "SELECT * FROM raw_order r WHERE NOT EXISTS (SELECT 1 FROM loaded_line l WHERE l.Migration_Id__c = r.Id)",
    "duplicate_ids": _with(raw_line=RAW_LINE) +
        "SELECT Id, count(*) AS count FROM raw_line GROUP BY Id HAVING count(*) > 1",
    "loaded_delta": _with(line_as_raw=LINE_AS_RAW, success_orders=SUCCESS_ORDERS) +
        "SELECT r.*, s.Migration_Id__c AS migration_id FROM line_as_raw r "
        "JOIN (SELECT DISTINCT Migration_Id__c FROM success_orders) s ON r.Id = s.Migration_Id__c",
    "id_crosswalk": _with(raw_order=RAW_ORDER, success_pairs=SUCCESS_PAIRS) +
        "SELECT r.Id AS source_id, s.Migration_Id__c AS migration_id, s.sf__Id AS target_id FROM raw_order r "
        "JOIN (SELECT DISTINCT Migration_Id__c, sf__Id FROM success_pairs) s ON r.Id = s.Migration_Id__c",
    "crosswalk_ambiguous": _with(success_pairs=SUCCESS_PAIRS) +
        "SELECT Migration_Id__c AS migration_id, count(DISTINCT sf__Id) AS targets "
        "FROM success_pairs WHERE Migration_Id__c IS NOT NULL AND sf__Id IS NOT NULL "
        "GROUP BY Migration_Id__c HAVING count(DISTINCT sf__Id) > 1",
    "crosswalk_accumulate": _with(success_pairs=SUCCESS_PAIRS) +
        f"SELECT {_v('o.o_orderkey')} AS source_id, s.Migration_Id__c AS migration_id, s.sf__Id AS target_id "
        "FROM orders o JOIN (SELECT DISTINCT Migration_Id__c, sf__Id FROM success_pairs) s "
        f"ON {_v('o.o_orderkey')} = s.Migration_Id__c WHERE o.o_orderdate < TIMESTAMP '1997-01-01' "
        f"UNION SELECT {_v('o.o_orderkey')}, s.Migration_Id__c, s.sf__Id "
        "FROM orders o JOIN (SELECT DISTINCT Migration_Id__c, sf__Id FROM success_pairs) s "
        f"ON {_v('o.o_orderkey')} = s.Migration_Id__c WHERE o.o_orderdate >= TIMESTAMP '1996-01-01'",
    "crosswalk_stream": _with(raw_order=RAW_ORDER, success_pairs=SUCCESS_PAIRS) +
        "SELECT DISTINCT r.Id AS source_id, s.Migration_Id__c AS migration_id, s.sf__Id AS target_id "
        "FROM raw_order r JOIN success_pairs s ON r.Id = s.Migration_Id__c",
    "outcome_split": _with(outcomes=OUTCOMES) + "SELECT object, outcome, source_id, job_id, target_id FROM outcomes",
    "outcome_replace": _with(outcomes=OUTCOMES) +
        "SELECT object, outcome, source_id, job_id + 7 AS job_id, target_id, '20250201_000000' AS run_id "
        "FROM outcomes WHERE outcome <> 'error' UNION ALL "
        "SELECT 'case', outcome, source_id, job_id, target_id, '20250101_000000' FROM outcomes WHERE outcome <> 'success'",
    "outcome_by_job": _with(outcomes=OUTCOMES) +
        "SELECT job_id, outcome, count(*) AS records FROM outcomes GROUP BY job_id, outcome",
    "outcome_totals_stream": _with(outcomes=OUTCOMES) +
        "SELECT object, job_id, outcome, count(*) AS records FROM outcomes GROUP BY object, job_id, outcome",
    "run_reconciliation": _with(raw_order=RAW_ORDER, outcomes=OUTCOMES) +
        "SELECT t.input, t.success, t.errors, t.unprocessed, t.input - t.success - t.errors - t.unprocessed AS gap "
        "FROM (SELECT (SELECT count(*) FROM raw_order) AS input, "
        "(SELECT count(*) FROM outcomes WHERE outcome = 'success') AS success, "
        "(SELECT count(*) FROM outcomes WHERE outcome = 'error') AS errors, "
        "(SELECT count(*) FROM outcomes WHERE outcome = 'unprocessed') AS unprocessed) t",
    "batch_assignment":
        "SELECT o_orderkey, o_custkey, o_orderstatus, "
        "CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS BIGINT) AS batch_id FROM orders",
    "outcome_by_batch": _with(
        outcomes=OUTCOMES,
        batched=(f"SELECT {_v('o_orderkey')} AS Id, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS BIGINT) "
                 "AS batch_id FROM orders")) +
        "SELECT b.batch_id, coalesce(o.outcome, 'missing') AS outcome, count(*) AS records "
        "FROM batched b LEFT JOIN outcomes o ON b.Id = o.source_id GROUP BY b.batch_id, coalesce(o.outcome, 'missing')",
    "email_match_key": _with(legacy_user=LEGACY_USER) +
        f"SELECT Id, Email, {_key('Email')} AS email_key, Username, {_key('Username')} AS username_key FROM legacy_user",
    "identity_match": IDENTITY + "SELECT * FROM matched",
    "identity_pairs": IDENTITY +
        "SELECT legacy_user_id, tfm_user_id FROM matched WHERE tfm_user_id IS NOT NULL AND tfm_user_id <> ''",
    "owner_remap": REMAP + "SELECT * FROM remapped",
    "owner_remap_exact_keys": REMAP_EXACT + "SELECT * REPLACE (rtrim(src_owner_id) AS src_owner_id) FROM remapped",
    "owner_matched": REMAP + "SELECT id, owner_id FROM remapped WHERE owner_id IS NOT NULL AND owner_id <> ''",
    "owner_unmatched_summary": REMAP +
        "SELECT src_owner_id, legacy_email, legacy_username, legacy_isactive, count(*) AS count FROM remapped "
        "WHERE owner_id IS NULL OR owner_id = '' GROUP BY src_owner_id, legacy_email, legacy_username, legacy_isactive",
    "scrub_line_breaks": _with(document_crlf=DOCUMENT_CRLF) +
        f"SELECT doc_id, {_scrub('text')} AS text, {_scrub('lang')} AS lang, {_scrub('source')} AS source, n_chars "
        "FROM document_crlf",
    "stamp_load_time":
        "SELECT event_id, event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS event_ts, "
        f"'{utc_millis_stamp(RUN_TS)}' AS Migrated_Date__c FROM events",
    "lookup_enrich":
        "SELECT c.c_custkey, c.c_name, c.c_mktsegment, n.n_name AS nation, r.r_name AS region FROM customer c "
        "LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey",
    "lookup_enrich_fanout":
        "SELECT c_custkey, c_nationkey, s_suppkey, s_name AS supplier FROM customer "
        "LEFT JOIN supplier ON s_nationkey = c_nationkey",
    "bulk_registration": _with(
        success_pairs=SUCCESS_PAIRS,
        pairs=(f"SELECT DISTINCT {_v('o_orderkey')} AS id, s.sf__Id FROM orders JOIN success_pairs s "
               f"ON s.Migration_Id__c = {_v('o_orderkey')}"),
        names="SELECT unnest([" + ", ".join(f"'master_{n.lower()}'" for n, registered, _o, _s in OBJECT_STEPS if registered)
              + "]) AS name",
        published=("SELECT 'master_account' AS name, count(*) AS n_rows, count(DISTINCT id) AS n_ids, "
                   "count(DISTINCT sf__Id) AS n_targets FROM pairs UNION ALL SELECT 'master_contact', count(*), "
                   "count(DISTINCT id), count(DISTINCT sf__Id) FROM pairs WHERE id < '3'")) +
        "SELECT name, CASE WHEN n_rows IS NULL THEN 'missing' ELSE 'registered' END AS status, "
        "CASE WHEN n_rows IS NOT NULL THEN 3 END::INTEGER AS n_columns, n_rows, n_ids, n_targets "
        "FROM names LEFT JOIN published USING (name)",
    "sql_transform": _with(raw_order=RAW_ORDER, t=statement_text(ORDER_TRANSFORM_SQL)) +
        "SELECT " + ", ".join(f"{_scrub(c)} AS {c}" for c in (
            "Migration_Id__c", "Account_Name__c", "Country__c", "Region__c", "Stage__c", "Note__c",
            "Description")) + " FROM t",
    "source_availability":
        "SELECT 'customer' AS name, 'registered' AS status, 5 AS n_columns, CAST(NULL AS VARCHAR) AS detail, "
        "(SELECT count(*) FROM customer) AS n_rows "
        "UNION ALL SELECT 'lineitem', 'registered', 11, NULL, (SELECT count(*) FROM lineitem) "
        "UNION ALL SELECT 'nation', 'registered', 3, NULL, (SELECT count(*) FROM nation) "
        "UNION ALL SELECT 'orders', 'registered', 6, NULL, (SELECT count(*) FROM orders) "
        "UNION ALL SELECT 'master_account', 'missing', NULL, 'PATH_NOT_FOUND', NULL "
        "UNION ALL SELECT 'success_contact', 'missing', NULL, 'PATH_NOT_FOUND', NULL",
    "partition_slice": _with(raw_order=RAW_ORDER) +
        "SELECT r.Id, r.OwnerId, r.o_orderstatus, r.o_totalprice, CAST(year(o.o_orderdate) AS INTEGER) AS year "
        f"FROM raw_order r JOIN orders o ON r.Id = {_v('o.o_orderkey')} WHERE year(o.o_orderdate) = 1997",
    "eligible_contracts": ELIGIBLE + "SELECT * FROM eligible",
    "eligible_documents": ELIGIBLE +
        "SELECT LinkedEntityId, ContentDocumentId FROM line_links WHERE LinkedEntityId IN (SELECT Id FROM eligible)",
    "latest_version_manifest": MANIFEST + "SELECT * FROM manifest",
    "document_name_collisions": MANIFEST +
        "SELECT file_name, count(*) AS count FROM manifest WHERE file_name IS NOT NULL "
        "GROUP BY file_name HAVING count(*) > 1",
    "document_manifest": ELIGIBLE_MANIFEST + "SELECT * FROM manifest",
    "eligible_attachments": ELIGIBLE + "SELECT a.Id AS attachment_id, ParentId AS parent_id, Name AS name, "
        f"{_file_name('ParentId', _safe('Name'))} AS file_name, "
        "CASE WHEN Name IS NULL THEN 'failed' ELSE 'ready' END AS status "
        f"FROM ({CONTRACT_ATTACHMENTS}) a SEMI JOIN eligible e ON ParentId = e.Id",
    "attachment_manifest": PAGE_FILES + "SELECT * FROM files",
    "attachment_parent_lookup": PAGE_FILES + "SELECT * FROM lookup",
    "attachment_payload": DOC_FILES +
        "SELECT name AS Name, parent_id AS ParentId, to_base64(encode(text)) AS Body, "
        "'application/pdf' AS ContentType FROM lookup WHERE status = 'ready'",
    "attachment_summary": DOC_FILES + "SELECT status, count(*) AS count FROM lookup GROUP BY status",
    "exportable_projection": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "filtered_extract":
        "SELECT l_orderkey, l_linenumber, role, '' AS legacy_id FROM (SELECT l_orderkey, l_linenumber, "
        "nullif(l_returnflag, 'N') AS role FROM lineitem) l WHERE l_orderkey IN "
        "(SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') AND role IS NULL",
    "header_catalog": CATALOG + " AND table_name IN ('customer', 'nation', 'supplier', 'events', 'orders', 'lineitem')",
    "header_drift": _with(
        found=CATALOG + " AND table_name IN ('orders', 'customer')",
        expected=f"SELECT * FROM (VALUES {_EXPECTED_VALUES}) v(object_name, position, column_name)") +
        "SELECT coalesce(f.object_name, e.object_name) AS object_name, "
        "coalesce(f.column_name, e.column_name) AS column_name, "
        "CAST(e.position AS INTEGER) AS expected_position, f.position AS found_position, "
        "CASE WHEN f.position IS NULL THEN 'missing' WHEN e.position IS NULL THEN 'extra' "
        "WHEN f.position = e.position THEN 'same' ELSE 'moved' END AS status "
        "FROM found f FULL OUTER JOIN expected e ON f.object_name = e.object_name AND f.column_name = e.column_name",
    "csv_round_trip":
        f"SELECT {_v('doc_id')} AS doc_id, {_csv_text('text')} AS text, {_csv_text('lang')} AS lang, "
        f"{_csv_text('source')} AS source, {_v('n_chars')} AS n_chars FROM documents",
    "csv_split_read":
        f"SELECT {_v('doc_id')} AS doc_id, {_csv_text('text')} AS text, {_csv_text('lang')} AS lang, "
        f"{_csv_text('source')} AS source, {_v('n_chars')} AS n_chars FROM documents",
    "csv_quote_all":
        f"SELECT {_v('doc_id')} AS doc_id, {_csv_text('text')} AS text, {_csv_text('lang')} AS lang, "
        f"{_csv_text('source')} AS source, {_v('quality')} AS quality, {_v('toxic')} AS toxic "
        "FROM documents LEFT JOIN labels USING (doc_id)",
    "union_by_header":
        f"SELECT {_v('o_orderkey')} AS Id, {_v('o_custkey')} AS OwnerId, o_orderstatus AS Status, "
        "CASE WHEN o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O') THEN o_orderpriority END AS Priority "
        "FROM orders",
    "publish_snapshots": _with(raw_order=RAW_ORDER) +
        "SELECT 'current' AS snapshot, '20250201_000000' AS run_id, Id, OwnerId, o_orderstatus, o_totalprice FROM raw_order "
        "UNION ALL SELECT 'previous', '20250101_000000', Id, OwnerId, o_orderstatus, NULL FROM raw_order "
        "WHERE o_orderstatus <> 'P'",
}
