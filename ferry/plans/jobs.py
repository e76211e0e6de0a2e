"""Composite jobs a user runs: transform an object, process loaded outcomes, match users,
remap owners, build document manifests and attachment uploads.

Each returns DataFrames (lazy); ``publish_*`` helpers write them with one evaluation of the
expensive part (a later output that depends on an earlier one reads the written table back, and
row counts come from ``observe`` during the writes rather than from extra ``count()`` jobs).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.constants import EXTRA_SUCCESS_COPY_OBJECTS, OBJECT_STEPS
from ferry.functions.text import scrub_line_breaks
from ferry.operators.documents import (
    attach_bodies,
    attachment_manifest,
    attachment_parent_lookup,
    attachment_payload,
    eligible_contracts,
    latest_version_manifest,
    linked_to,
    transfer_summary,
)
from ferry.operators.identity import identity_match, identity_pairs
from ferry.operators.owners import owner_matched, owner_remap, owner_unmatched_summary
from ferry.operators.reconcile import duplicate_ids, id_crosswalk, loaded_delta, orphan_records
from ferry.session import scratch_path
from ferry.sinks.publish import append_crosswalk, publish_counted, read_crosswalk, read_outcomes
from ferry.sources.csv import union_by_header
from ferry.sources.registry import register_views, run_registered
from ferry.sources.sqltext import check_view_name, run_sql


def object_steps(spark: SparkSession) -> DataFrame:
    """The per-object step flags as a DataFrame ``(object_name, registered, orphan_checked,
    stamped)``: which objects get a crosswalk view, an orphan check and a load stamp."""
    return spark.createDataFrame(list(OBJECT_STEPS),
                                 "object_name string, registered boolean, orphan_checked boolean, stamped boolean")


def steps_for(object_name: str) -> dict[str, bool]:
    for name, registered, orphan_checked, stamped in OBJECT_STEPS:
        if name == object_name.lower():
            return {"registered": registered, "orphan_checked": orphan_checked, "stamped": stamped}
    return {"registered": False, "orphan_checked": False, "stamped": False}


ORIGINAL_NAMES = {"source_id": "Id", "migration_id": "Migration_Id__c", "target_id": "sf__Id"}


def crosswalk_sources(spark: SparkSession, root: str, partition_year: str | int | None = None,
                      prefix: str = "master", objects=None, fmt: str = "parquet",
                      original_names: bool = False) -> dict[str, Callable[[], DataFrame]]:
    """Loaders of earlier crosswalks for every registered object: view ``{prefix}_{object}``
    reads ``{root}/{object}[/year=Y]``. ``fmt="parquet"`` reads the current run that
    ``append_crosswalk`` publishes; ``fmt="csv"`` reads every CSV file below the folder, by header.
    Meant for ``transform_object(optional=...)``: a missing folder is reported, not fatal.
    ``original_names`` offers the columns as ``Id, Migration_Id__c, sf__Id``, as user SQL knows
    them."""
    names = objects if objects is not None else [n for n, registered, _o, _s in OBJECT_STEPS if registered]
    year = f"/year={partition_year}" if partition_year else ""

    def named(df: DataFrame) -> DataFrame:
        return df.withColumnsRenamed(ORIGINAL_NAMES) if original_names else df

    def loader(name: str) -> Callable[[], DataFrame]:
        path = f"{root.rstrip('/')}/{name.lower()}{year}"
        if fmt == "parquet":
            return lambda: named(read_crosswalk(spark, path))
        return lambda: named(union_by_header(spark, path))

    return {f"{prefix}_{n.lower()}": loader(n) for n in names}


def success_sources(spark: SparkSession, outcomes_root: str,
                    objects=EXTRA_SUCCESS_COPY_OBJECTS) -> dict[str, Callable[[], DataFrame]]:
    """Loaders of ``success_{object}`` views over the routed outcome table (the success
    partition of each object), replacing the extra success copy the original uploaded for a
    few objects. Only the object's last run is read, and of it only that folder."""
    return {f"success_{o.lower()}": (lambda o=o: read_outcomes(spark, outcomes_root, [o.lower()])
                                     .where(F.col("outcome") == "success"))
            for o in objects}


@dataclass
class TransformResult:
    result: DataFrame
    orphans: DataFrame | None
    sources: DataFrame
    raw: DataFrame


def transform_object(spark: SparkSession, object_name: str, sql_text: str, raw: DataFrame,
                     lookups: Mapping[str, Callable[[], DataFrame]] | None = None,
                     optional: Mapping[str, Callable[[], DataFrame]] | None = None,
                     source_key: str = "Id", result_key: str = "Migration_Id__c",
                     orphan_check: bool | None = True, scrub: bool = True,
                     only_named: bool = False) -> TransformResult:
    """Register lookups (required) and earlier crosswalks (optional), register the raw object
    under its own name, run the object's SQL, scrub line breaks, and find orphans.

    With ``only_named`` only those optional sources are opened that the SQL names; the others are
    reported as ``not named`` instead of being looked for.

    ``orphan_check=None`` takes the object's flag from the step config."""
    view = check_view_name(object_name.lower())
    if orphan_check is None:
        orphan_check = steps_for(object_name)["orphan_checked"]
    required_report = register_views(spark, lookups or {}, required=True)
    if only_named:
        raw.createOrReplaceTempView(view)
        result, optional_report = run_registered(spark, sql_text, optional or {}, own=view)
    else:
        optional_report = register_views(spark, optional or {}, required=False)
        raw.createOrReplaceTempView(view)
        result = run_sql(spark, sql_text)
    if scrub:
        result = scrub_line_breaks(result)
    orphans = None
    if orphan_check:
        if result_key not in result.columns:
            raise ValueError(f"the SQL of {object_name} must return a {result_key} column")
        orphans = orphan_records(raw, result, source_key, result_key)
    return TransformResult(result, orphans, required_report.unionByName(optional_report), raw)


def publish_transform(tr: TransformResult, root: str, object_name: str, run_id: str,
                      fmt: str = "csv", source_key: str = "Id",
                      result_key: str = "Migration_Id__c",
                      partition_year: str | int | None = None) -> dict[str, int]:
    """Write the transformed rows, then the orphans, as run ``run_id``; the SQL runs once.
    With ``partition_year`` both land below ``year=Y`` (a slice of the object per year).

    The orphan check reads the key column back from a written table instead of evaluating the SQL
    a second time or caching it on executors. A CSV cannot serve for that, as it drops outer blanks:
    then the result is first written as Parquet to the shared scratch folder, and the CSV export
    and the check both read that. Without rows nothing is published.
    Row counts come from ``observe`` during the writes.
    """
    obj = object_name.lower() + (f"/year={partition_year}" if partition_year else "")
    counts: dict[str, int] = {}
    written = staged(tr.result, "transformed")
    counts["transformed"] = publish_counted(written, f"{root}/transformed/{obj}", run_id, fmt)
    if tr.orphans is not None:
        orphans = orphan_records(tr.raw, written.select(result_key), source_key, result_key)
        counts["orphaned"] = publish_counted(staged(orphans, "orphaned"), f"{root}/orphaned/{obj}", run_id, fmt)
    return counts


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write once as Parquet to the shared scratch folder and read back: exact values, one evaluation."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def after_load(raw: DataFrame, success: DataFrame, source_key: str = "Id",
               success_key: str = "Migration_Id__c", target_col: str = "sf__Id") -> dict[str, DataFrame]:
    """Duplicate input ids, the loaded delta, and the id crosswalk of one load."""
    return {
        "duplicates": duplicate_ids(raw, source_key),
        "delta": loaded_delta(raw, success, source_key, success_key),
        "crosswalk": id_crosswalk(raw, success, source_key, success_key, target_col),
    }


def match_users(legacy: DataFrame, target: DataFrame, **kwargs) -> dict[str, DataFrame]:
    matched = identity_match(legacy, target, **kwargs)
    return {"matched": matched, "pairs": identity_pairs(matched)}


def remap_owners(source: DataFrame, crosswalk: DataFrame, **kwargs) -> dict[str, DataFrame]:
    remapped = owner_remap(source, crosswalk, **kwargs)
    return {"remapped": remapped, "matched": owner_matched(remapped),
            "unmatched": owner_unmatched_summary(remapped)}


def publish_owner_remap(remapped: DataFrame, root: str, object_name: str, run_id: str,
                        fmt: str = "csv") -> dict[str, int]:
    """Write the remapped records once (Parquet, below ``{root}/remapped``), then the update rows
    and the unmatched summary from that written table: the owner join runs once, and each output
    reads only the columns it needs."""
    obj = object_name.lower()
    written = staged(remapped, "remapped")
    return {"remapped": publish_counted(written, f"{root}/remapped/{obj}", run_id, "parquet"),
            "matched": publish_counted(owner_matched(written), f"{root}/matched/{obj}", run_id, fmt),
            "unmatched_groups": publish_counted(owner_unmatched_summary(written), f"{root}/unmatched/{obj}", run_id, fmt)}


def publish_user_match(matched: DataFrame, root: str, run_id: str, fmt: str = "csv") -> dict[str, int]:
    """Write the full user crosswalk and the matched pairs, both from one written table."""
    written = staged(matched, "user-matched")
    return {"matched": publish_counted(written, f"{root}/user_matched", run_id, fmt),
            "pairs": publish_counted(identity_pairs(written), f"{root}/user", run_id, fmt)}


def publish_after_load(raw: DataFrame, success: DataFrame, root: str, object_name: str, run_id: str,
                       fmt: str = "csv") -> dict[str, int]:
    """Duplicate ids, delta and crosswalk of one load; raw rows and outcomes are read once."""
    parts = after_load(staged(raw, "raw"), staged(success, "success"))
    crosswalk = staged(parts["crosswalk"], "crosswalk")
    counts = {"duplicates": publish_counted(parts["duplicates"], f"{root}/duplicates/{object_name}", run_id, fmt),
              "delta": publish_counted(parts["delta"], f"{root}/joined_output/{object_name}", run_id, fmt),
              "crosswalk": crosswalk.count()}
    if counts["crosswalk"]:
        append_crosswalk(crosswalk, f"{root}/prod_data/{object_name}", run_id)
    return counts


def document_manifest(contracts: DataFrame, accounts: DataFrame, links: DataFrame,
                      versions: DataFrame, contract_account_col: str = "AccountId",
                      account_status_col: str = "Status", created_col: str = "CreatedDate",
                      **eligibility) -> DataFrame:
    """Eligible contracts -> their document links -> latest versions -> file names."""
    ok = eligible_contracts(contracts, accounts, contract_account_col, "Id", account_status_col,
                            created_col, **eligibility)
    eligible_links = linked_to(links, ok, "LinkedEntityId", "Id")
    return latest_version_manifest(eligible_links, versions)


def eligible_attachments(attachments: DataFrame, contracts: DataFrame, accounts: DataFrame,
                         contract_account_col: str = "AccountId", account_status_col: str = "Status",
                         created_col: str = "CreatedDate", parent_col: str = "ParentId", **eligibility) -> DataFrame:
    """Attachments of eligible contracts, with their file names."""
    ok = eligible_contracts(contracts, accounts, contract_account_col, "Id", account_status_col,
                            created_col, **eligibility)
    return attachment_manifest(linked_to(attachments, ok, parent_col, "Id"), parent_col=parent_col)


def attachment_uploads(files: DataFrame, parents: DataFrame) -> dict[str, DataFrame]:
    """Files (path, length, file_name ``{old parent}_{name}``) -> new parents -> payload rows and a summary.

    The parent join sees names and paths only; bodies are read afterwards, of ready files only, dealt out by bytes."""
    looked_up = attachment_parent_lookup(files, parents, keep_cols=["path", "length"])
    return {"lookup": looked_up, "payload": attachment_payload(attach_bodies(looked_up)),
            "summary": transfer_summary(looked_up)}


def publish_attachment_uploads(files: DataFrame, parents: DataFrame, root: str, run_id: str) -> dict:
    """Write the upload payload rows and the status summary; the lookup join runs once."""
    looked_up = staged(attachment_parent_lookup(files, parents, keep_cols=["path", "length"]), "parent-lookup")
    payload = publish_counted(attachment_payload(attach_bodies(looked_up)), f"{root}/payload", run_id, "parquet")
    # At most one row per status.
    return {"payload": payload, "summary": {r["status"]: r["count"] for r in transfer_summary(looked_up).collect()}}
