"""Registered queries: one per operator of the inventory, over the shared test tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame. Queries that exercise a writer
write below a fresh folder under the session's checkpoint root and return what they read back.
Column names equal those of the SQL in ``ferry.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.functions.keys import email_match_key
from ferry.functions.text import iso_millis, scrub_line_breaks
from ferry.operators.batches import assign_batches
from ferry.operators.documents import (
    attachment_manifest,
    attachment_parent_lookup,
    eligible_contracts,
    latest_version_manifest,
    linked_to,
    name_collisions,
    transfer_summary,
)
from ferry.operators.enrich import lookup_enrich
from ferry.operators.extract import exportable_fields, field_names, filtered_extract, metadata_from_schema
from ferry.operators.identity import identity_match, identity_pairs
from ferry.operators.owners import owner_matched, owner_remap, owner_unmatched_summary
from ferry.operators.reconcile import (
    ambiguous_targets,
    duplicate_ids,
    id_crosswalk,
    loaded_delta,
    orphan_records,
    outcome_by_batch,
    outcome_by_job,
    run_reconciliation,
)
from ferry.operators.stamp import stamp_load_time
from ferry.plans import fixtures as fx
from ferry.plans.jobs import (
    attachment_uploads,
    crosswalk_sources,
    document_manifest,
    eligible_attachments,
    transform_object,
)
from ferry.session import scratch_path
from ferry.sinks.publish import (
    append_crosswalk,
    publish_snapshot,
    read_crosswalk,
    read_crosswalk_runs,
    read_outcomes,
    read_run,
    write_csv,
    write_outcomes,
)
from ferry.sources.csv import read_csv, union_by_header
from ferry.sources.binary import read_files
from ferry.sources.headers import header_catalog, header_drift
from ferry.sources.registry import register_views
from ferry.streaming.crosswalk import start_crosswalk_stream
from ferry.streaming.outcomes import start_outcome_totals_stream

Query = Callable[[SparkSession, str], DataFrame]

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# A fixed run instant for stamping, so results are reproducible.
RUN_TS = datetime(2025, 1, 2, 3, 4, 5, 678000, tzinfo=timezone.utc)

# The transform of the order object: SQL text as a user keeps it next to the job. The comment
# lines, the comment at a line end, the dashes inside a literal and the trailing semicolon are
# all deliberate.
ORDER_TRANSFORM_SQL = """\
-- Transform of the order object into the new model.
-- Lines like these are comments; the engine skips them.
SELECT
  o.Id AS Migration_Id__c,  -- the old id travels with the new record
  c.c_name AS Account_Name__c,
  n.n_name AS Country__c,
  r.r_name AS Region__c,
  CASE WHEN o.o_orderstatus = 'F' THEN 'Closed' ELSE 'Open' END AS Stage__c,
  'kept -- not a comment' AS Note__c,
  d.text AS Description
FROM raw_order o
JOIN customer c ON c.c_custkey = CAST(o.OwnerId AS BIGINT)
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN documents d ON d.doc_id = CAST(o.Id AS BIGINT)
WHERE o.o_orderpriority <> '5-LOW';
"""


def _lookups(spark: SparkSession, d: str, names) -> dict:
    return {n: (lambda n=n: fx.table(spark, d, n)) for n in names}


# --- reconciliation ----------------------------------------------------------------------------

def q_orphan_records(spark, d):
    return orphan_records(fx.raw_order(spark, d), fx.loaded_line(spark, d), "Id", "Migration_Id__c")


def q_duplicate_ids(spark, d):
    return duplicate_ids(fx.raw_line(spark, d), "Id")


def q_loaded_delta(spark, d):
    return loaded_delta(fx.line_as_raw(spark, d), fx.success_orders(spark, d), "Id",
                        "Migration_Id__c", migration_col="migration_id")


def q_id_crosswalk(spark, d):
    return id_crosswalk(fx.raw_order(spark, d), fx.success_pairs(spark, d))


def q_crosswalk_ambiguous(spark, d):
    """Old ids loaded more than once with different new ids (they fan out in the crosswalk)."""
    success = fx.success_pairs(spark, d)
    return ambiguous_targets(success, "Migration_Id__c", "sf__Id").withColumnRenamed(
        "Migration_Id__c", "migration_id")


def q_crosswalk_accumulate(spark, d):
    """Two load runs with overlapping orders, each published as a run folder, read as one."""
    def raw_between(cond):
        return fx.table(spark, d, "orders").where(cond).select(F.col("o_orderkey").cast("string").alias("Id"))

    day = F.col("o_orderdate")
    run1 = raw_between(day < F.lit("1997-01-01").cast("timestamp_ntz"))
    run2 = raw_between(day >= F.lit("1996-01-01").cast("timestamp_ntz"))
    success = fx.success_pairs(spark, d)
    root = scratch_path(spark, "crosswalk")
    append_crosswalk(id_crosswalk(run1, success), root, "20250101_000000")
    append_crosswalk(id_crosswalk(run2, success), root, "20250201_000000")
    return read_crosswalk(spark, root)


def q_crosswalk_stream(spark, d):
    """Success outcomes land as several CSV files; a file stream grows the crosswalk batch by
    batch (two files per micro-batch); the published crosswalk is read back as one table."""
    landing = scratch_path(spark, "landing")
    write_csv(fx.success_pairs(spark, d), landing)
    root = scratch_path(spark, "stream_crosswalk")
    q = start_crosswalk_stream(spark, landing, fx.raw_order(spark, d), root,
                               scratch_path(spark, "stream_ckpt"), max_files_per_trigger=2)
    q.awaitTermination()
    return read_crosswalk_runs(spark, root)


def q_outcome_split(spark, d):
    root = scratch_path(spark, "outcomes")
    write_outcomes(fx.outcomes(spark, d), root, "20250101_000000")
    return read_outcomes(spark, root).select("object", "outcome", "source_id", "job_id", "target_id")


def q_outcome_replace(spark, d):
    """A second run without errors, of one object: its outcomes replace those of the first run, the
    other object keeps its own, and the first run stays as history."""
    root = scratch_path(spark, "outcomes")
    first = fx.outcomes(spark, d)
    other = first.withColumn("object", F.lit("case")).where("outcome <> 'success'")
    write_outcomes(first.unionByName(other), root, "20250101_000000")
    write_outcomes(first.where("outcome <> 'error'").withColumn("job_id", F.col("job_id") + 7), root, "20250201_000000")
    return read_outcomes(spark, root).select("object", "outcome", "source_id", "job_id", "target_id", "run_id")


def q_outcome_totals_stream(spark, d):
    """Outcome files land, some per outcome folder; a stateful stream keeps the running totals
    per object, job and outcome; the last published totals are read back."""
    landing = scratch_path(spark, "outcome_landing")
    rows = fx.outcomes(spark, d)
    write_outcomes(rows, landing, "20250101_000000")
    totals = scratch_path(spark, "outcome_totals")
    q = start_outcome_totals_stream(spark, f"{landing}/run_id=20250101_000000", rows.schema, totals,
                                    scratch_path(spark, "totals_ckpt"), max_files_per_trigger=6)
    q.awaitTermination()
    return read_run(spark, totals).select("object", "job_id", "outcome", "records")


def q_outcome_by_job(spark, d):
    return outcome_by_job(fx.outcomes(spark, d))


def q_run_reconciliation(spark, d):
    return run_reconciliation(fx.raw_order(spark, d), fx.outcomes(spark, d))


def q_batch_assignment(spark, d):
    orders = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return assign_batches(orders, ["o_orderkey"], batch_size=1000)


def q_outcome_by_batch(spark, d):
    """Raw orders split into load batches of 1,000 in id order, outcomes counted per batch."""
    raw = fx.table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("Id"), "o_orderkey")
    batched = assign_batches(raw, ["o_orderkey"], batch_size=1000)
    return outcome_by_batch(batched, fx.outcomes(spark, d))


# --- identity and owners --------------------------------------------------------------------------

def q_email_match_key(spark, d):
    u = fx.legacy_user(spark, d)
    return u.select(
        "Id", "Email",
        email_match_key("Email", fx.FIXTURE_ALIASES, fx.FIXTURE_CANONICAL).alias("email_key"),
        "Username",
        email_match_key("Username", fx.FIXTURE_ALIASES, fx.FIXTURE_CANONICAL).alias("username_key"))


def _identity(spark, d):
    return identity_match(fx.legacy_user(spark, d), fx.target_user(spark, d),
                          aliases=fx.FIXTURE_ALIASES, canonical=fx.FIXTURE_CANONICAL)


def q_identity_match(spark, d):
    return _identity(spark, d)


def q_identity_pairs(spark, d):
    return identity_pairs(_identity(spark, d))


def _remap(spark, d):
    return owner_remap(fx.owned_order(spark, d), fx.user_crosswalk(spark, d))


def q_owner_remap(spark, d):
    return _remap(spark, d)


def q_owner_remap_exact_keys(spark, d):
    """Keys compared as they are, without trimming."""
    owned = fx.owned_order(spark, d).withColumn("OwnerId", F.rtrim("OwnerId"))
    return owner_remap(owned, fx.user_crosswalk(spark, d), trim_keys=False)


def q_owner_matched(spark, d):
    return owner_matched(_remap(spark, d))


def q_owner_unmatched_summary(spark, d):
    return owner_unmatched_summary(_remap(spark, d))


# --- cleaning, stamping, enrichment, SQL transform ----------------------------------------------

def q_scrub_line_breaks(spark, d):
    return scrub_line_breaks(fx.document_crlf(spark, d))


def q_stamp_load_time(spark, d):
    ev = fx.table(spark, d, "events").select("event_id", "event_type", iso_millis("ts").alias("event_ts"))
    return stamp_load_time(ev, "event", RUN_TS)


def q_lookup_enrich(spark, d):
    cust = fx.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    nation = fx.table(spark, d, "nation")
    region = fx.table(spark, d, "region")
    with_nation = lookup_enrich(cust, nation, "c_nationkey", "n_nationkey",
                                {"n_name": "nation", "n_regionkey": "n_regionkey"})
    with_region = lookup_enrich(with_nation, region, "n_regionkey", "r_regionkey", {"r_name": "region"})
    return with_region.select("c_custkey", "c_name", "c_mktsegment", "nation", "region")


def q_lookup_enrich_fanout(spark, d):
    """Every supplier of a customer's nation: keys that repeat on the lookup side multiply rows."""
    return lookup_enrich(fx.table(spark, d, "customer").select("c_custkey", "c_nationkey"), fx.table(spark, d, "supplier"),
                         "c_nationkey", "s_nationkey", {"s_suppkey": "s_suppkey", "s_name": "supplier"}, fan_out=True)


def _transform(spark, d):
    return transform_object(spark, "raw_order", ORDER_TRANSFORM_SQL, fx.raw_order(spark, d),
                            lookups=_lookups(spark, d, ("customer", "nation", "region", "documents")))


def q_sql_transform(spark, d):
    return _transform(spark, d).result


def q_source_availability(spark, d):
    present = _lookups(spark, d, ("customer", "lineitem", "nation", "orders"))
    missing = {
        "master_account": lambda: spark.read.parquet(f"{d}/master_raw/account"),
        "success_contact": lambda: spark.read.parquet(f"{d}/success/contact"),
    }
    return register_views(spark, {**present, **missing}, required=False, with_counts=True)


def q_bulk_registration(spark, d):
    """All configured objects' crosswalk views: two were published, the others are missing; the
    registered views offer the original column names."""
    root = scratch_path(spark, "crosswalks")
    pairs = id_crosswalk(fx.raw_order(spark, d), fx.success_pairs(spark, d))
    append_crosswalk(pairs, f"{root}/account", "20250101_000000")
    append_crosswalk(pairs.where("source_id < '3'"), f"{root}/contact", "20250101_000000")
    report = register_views(spark, crosswalk_sources(spark, root, original_names=True), required=False, with_counts=True)
    keys = spark.sql("SELECT 'master_account' AS name, count(DISTINCT Id) AS n_ids, count(DISTINCT sf__Id) AS n_targets "
                     "FROM master_account UNION ALL SELECT 'master_contact', count(DISTINCT Id), count(DISTINCT sf__Id) "
                     "FROM master_contact")
    return report.select("name", "status", "n_columns", "n_rows").join(keys, "name", "left")


def q_partition_slice(spark, d):
    root = scratch_path(spark, "by_year")
    dated = fx.table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("Id"), F.col("o_custkey").cast("string").alias("OwnerId"),
        "o_orderstatus", "o_totalprice", F.year("o_orderdate").alias("year"))
    dated.write.partitionBy("year").parquet(root)
    return spark.read.parquet(root).where(F.col("year") == 1997).select(
        "Id", "OwnerId", "o_orderstatus", "o_totalprice", "year")


# --- documents ----------------------------------------------------------------------------------

def _eligible(spark, d):
    return eligible_contracts(fx.contracts(spark, d), fx.accounts(spark, d), "AccountId", "Id",
                              "Status", "CreatedDate", fx.FIXTURE_STATUSES, fx.FIXTURE_CUTOFF)


def q_eligible_contracts(spark, d):
    return _eligible(spark, d).select("Id", "AccountId", "o_orderstatus")


def q_eligible_documents(spark, d):
    return linked_to(fx.line_links(spark, d), _eligible(spark, d), "LinkedEntityId", "Id")


def _manifest(spark, d):
    return latest_version_manifest(fx.document_links(spark, d), fx.document_versions(spark, d))


def q_latest_version_manifest(spark, d):
    return _manifest(spark, d)


def q_document_name_collisions(spark, d):
    return name_collisions(_manifest(spark, d))


def q_attachment_manifest(spark, d):
    return attachment_manifest(fx.page_attachments(spark, d))


def q_attachment_parent_lookup(spark, d):
    files = attachment_manifest(fx.page_attachments(spark, d)).select("file_name")
    return attachment_parent_lookup(files, fx.contract_parents(spark, d))


def q_document_manifest(spark, d):
    """Eligible contracts -> their document links -> latest versions -> file names."""
    return document_manifest(fx.contracts(spark, d), fx.accounts(spark, d), fx.contract_document_links(spark, d),
                             fx.document_versions(spark, d), statuses=fx.FIXTURE_STATUSES,
                             created_on_or_before=fx.FIXTURE_CUTOFF)


def q_eligible_attachments(spark, d):
    """Attachments of eligible contracts with their file names."""
    return eligible_attachments(fx.contract_attachments(spark, d), fx.contracts(spark, d), fx.accounts(spark, d),
                                statuses=fx.FIXTURE_STATUSES, created_on_or_before=fx.FIXTURE_CUTOFF)


def _uploads(spark, d):
    folder = fx.document_files(spark, d, scratch_path(spark, "document_files"))
    files = read_files(spark, folder, with_content=False).select("path", "length", "file_name")
    return attachment_uploads(files, fx.contract_parents(spark, d))


def q_attachment_payload(spark, d):
    """Document files -> new parents by file name -> bodies of the ready files as base64."""
    return _uploads(spark, d)["payload"]


def q_attachment_summary(spark, d):
    """Documents by the names of their files -> new parents -> rows per status; no body is read or written."""
    return transfer_summary(attachment_parent_lookup(fx.document_names(spark, d), fx.contract_parents(spark, d)))


# --- metadata, extracts, headers --------------------------------------------------------------------

# Field metadata of the order object as the source system describes it: types per field, and
# further fields that exist only in the metadata (compound ones and unsupported types).
ORDER_FIELD_TYPES = {"o_orderkey": "id", "o_custkey": "reference", "o_orderstatus": "picklist",
                     "o_totalprice": "currency", "o_orderdate": "location",
                     "o_orderpriority": "anyType"}
EXTRA_FIELDS = [("BillingAddress", "address", None), ("BillingCity", "string", "BillingAddress"),
                ("Secret__c", "encryptedstring", None), ("Body", "base64", None)]


def q_exportable_projection(spark, d):
    orders = fx.table(spark, d, "orders")
    meta = metadata_from_schema(spark, orders, types=ORDER_FIELD_TYPES)
    extra = spark.createDataFrame(
        [(100 + i, n, t, c) for i, (n, t, c) in enumerate(EXTRA_FIELDS)],
        "position int, name string, type string, compoundFieldName string")
    fields = field_names(exportable_fields(meta.unionByName(extra)))
    return filtered_extract(orders, fields)


def q_filtered_extract(spark, d):
    lines = fx.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr("nullif(l_returnflag, 'N')").alias("role"))
    open_orders = fx.table(spark, d, "orders").where(F.col("o_orderstatus") == "O")
    linked = linked_to(lines, open_orders, "l_orderkey", "o_orderkey")
    return filtered_extract(linked, ["l_orderkey", "l_linenumber", "role", "legacy_id"], "role IS NULL")


def _csv_objects(spark, d) -> str:
    """A sample of each table as a CSV folder of objects: the least record of every group; orders and line
    items nested by year. Groups and records come from whole tables, few lines are written."""
    root = scratch_path(spark, "objects")

    def sample(name, group):
        df = fx.table(spark, d, name)
        return df.groupBy(group.alias("__ferry_group")).agg(F.min(F.struct(*df.columns)).alias("r"))

    for name, group in (("customer", "c_nationkey"), ("nation", "n_regionkey"), ("supplier", "s_nationkey"), ("events", "event_type")):
        write_csv(sample(name, F.col(group)).select("r.*"), f"{root}/{name}")
    for name, day in (("orders", "o_orderdate"), ("lineitem", "l_shipdate")):
        sample(name, F.year(day)).select("r.*", F.col("__ferry_group").alias("year")).write.partitionBy("year") \
            .option("header", "true").csv(f"{root}/{name}")
    return root


def q_header_catalog(spark, d):
    return header_catalog(spark, _csv_objects(spark, d))


# The layout the receiving side expects for two objects (an older layout of the tables).
EXPECTED_LAYOUT = [("orders", 1, "o_orderkey"), ("orders", 2, "o_custkey"),
                   ("orders", 3, "o_orderstatus"), ("orders", 4, "o_orderdate"),
                   ("orders", 5, "o_totalprice"), ("orders", 6, "o_comment"),
                   ("customer", 1, "c_custkey"), ("customer", 2, "c_name"),
                   ("customer", 3, "c_nationkey"), ("customer", 4, "c_acctbal")]


def q_header_drift(spark, d):
    found = header_catalog(spark, _csv_objects(spark, d)).where(F.col("object_name").isin("orders", "customer"))
    expected = spark.createDataFrame(EXPECTED_LAYOUT, "object_name string, position int, column_name string")
    return header_drift(found, expected)


# --- CSV and publishing ---------------------------------------------------------------------------

def q_csv_round_trip(spark, d):
    path = scratch_path(spark, "docs_csv")
    write_csv(fx.table(spark, d, "documents"), path)
    return read_csv(spark, path)


def q_csv_split_read(spark, d):
    """Documents with line breaks in quoted values, read by the splits of their files."""
    path = scratch_path(spark, "docs_split")
    write_csv(fx.table(spark, d, "documents"), path)
    return read_csv(spark, path, multiline="split")


def q_csv_quote_all(spark, d):
    """Every value quoted; nulls and empty texts come back as null."""
    path = scratch_path(spark, "docs_quoted")
    labelled = fx.table(spark, d, "documents").join(fx.table(spark, d, "labels"), "doc_id", "left")
    write_csv(labelled.select("doc_id", "text", "lang", "source", "quality", "toxic"), path, quote_all=True)
    return read_csv(spark, path)


def q_union_by_header(spark, d):
    """Orders written by three extracts with different headers, read back as one table."""
    root = scratch_path(spark, "drift")
    o = fx.table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("Id"), F.col("o_custkey").cast("string").alias("OwnerId"),
        F.col("o_orderstatus").alias("Status"), F.col("o_orderpriority").alias("Priority"))
    st = F.col("Status")
    write_csv(o.where(st == "F").select("Id", "OwnerId", "Status"), f"{root}/extract_a")
    write_csv(o.where(st == "O").select("Status", "Id", "OwnerId"), f"{root}/extract_b")
    write_csv(o.where(st.isNull() | ~st.isin("F", "O")).select("Id", "Status", "OwnerId", "Priority"),
              f"{root}/extract_c")
    return union_by_header(spark, root)


def q_publish_snapshots(spark, d):
    root = scratch_path(spark, "snapshots")
    orders = fx.raw_order(spark, d).select("Id", "OwnerId", "o_orderstatus")
    publish_snapshot(orders.where(F.col("o_orderstatus") != "P"), root, "20250101_000000")
    newer = fx.raw_order(spark, d).select("OwnerId", "Id", "o_orderstatus", "o_totalprice")
    publish_snapshot(newer, root, "20250201_000000")
    cur = read_run(spark, root, "current").withColumn("snapshot", F.lit("current"))
    prev = read_run(spark, root, "previous").withColumn("snapshot", F.lit("previous"))
    return cur.unionByName(prev, allowMissingColumns=True)


QUERIES: dict[str, Query] = {
    "orphan_records": q_orphan_records,
    "duplicate_ids": q_duplicate_ids,
    "loaded_delta": q_loaded_delta,
    "id_crosswalk": q_id_crosswalk,
    "crosswalk_ambiguous": q_crosswalk_ambiguous,
    "crosswalk_accumulate": q_crosswalk_accumulate,
    "crosswalk_stream": q_crosswalk_stream,
    "outcome_split": q_outcome_split,
    "outcome_by_job": q_outcome_by_job,
    "outcome_totals_stream": q_outcome_totals_stream,
    "run_reconciliation": q_run_reconciliation,
    "batch_assignment": q_batch_assignment,
    "outcome_by_batch": q_outcome_by_batch,
    "email_match_key": q_email_match_key,
    "identity_match": q_identity_match,
    "identity_pairs": q_identity_pairs,
    "owner_remap": q_owner_remap,
    "owner_matched": q_owner_matched,
    "owner_unmatched_summary": q_owner_unmatched_summary,
    "scrub_line_breaks": q_scrub_line_breaks,
    "stamp_load_time": q_stamp_load_time,
    "lookup_enrich": q_lookup_enrich,
    "sql_transform": q_sql_transform,
    "source_availability": q_source_availability,
    "partition_slice": q_partition_slice,
    "eligible_contracts": q_eligible_contracts,
    "eligible_documents": q_eligible_documents,
    "latest_version_manifest": q_latest_version_manifest,
    "document_name_collisions": q_document_name_collisions,
    "attachment_manifest": q_attachment_manifest,
    "attachment_parent_lookup": q_attachment_parent_lookup,
    "attachment_payload": q_attachment_payload,
    "attachment_summary": q_attachment_summary,
    "exportable_projection": q_exportable_projection,
    "filtered_extract": q_filtered_extract,
    "header_catalog": q_header_catalog,
    "header_drift": q_header_drift,
    "csv_round_trip": q_csv_round_trip,
    "union_by_header": q_union_by_header,
    "publish_snapshots": q_publish_snapshots,
    "outcome_replace": q_outcome_replace,
    "lookup_enrich_fanout": q_lookup_enrich_fanout,
    "bulk_registration": q_bulk_registration,
    "owner_remap_exact_keys": q_owner_remap_exact_keys,
    "document_manifest": q_document_manifest,
    "eligible_attachments": q_eligible_attachments,
    "csv_quote_all": q_csv_quote_all,
    "csv_split_read": q_csv_split_read,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first question of a migration: which source records did not make it through the
    transform? (raw orders -> SQL transform -> scrub -> orphans)."""
    return _transform(spark, sf_dir).orphans
