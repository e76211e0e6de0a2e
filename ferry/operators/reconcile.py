"""Reconciliation: what made it, what did not, and how old ids map to new ids.

Scale notes (shared by all operators here):

* Semi- and anti-joins take the key side as it is, without a distinct: the join needs no unique
  keys, and a plain shuffle on both sides lets AQE split a hot key of the probing side.
* The reduced side of an inner join is aggregated with ``reduce_apart``, for the same reason.
* Counts are single aggregates, never chains of ``count()`` actions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.constants import OUTCOMES
from ferry.operators.salting import reduce_apart


def _keys(df: DataFrame, key: str, alias: str) -> DataFrame:
    return df.select(F.col(key).alias(alias)).where(F.col(alias).isNotNull())


def orphan_records(source: DataFrame, result: DataFrame, source_key: str = "Id",
                   result_key: str = "Migration_Id__c") -> DataFrame:
    """Source rows whose key does not appear among the result's migration ids.

    A source row with a null key is an orphan (null never matches); duplicate source rows are
    all kept.
    """
    keys = _keys(result, result_key, "__ferry_key")
    return source.join(keys, source[source_key] == keys["__ferry_key"], "left_anti")


def duplicate_ids(df: DataFrame, key: str = "Id", count_name: str = "count") -> DataFrame:
    """Keys that occur more than once, with their count; a null key is a group of its own."""
    return (df.groupBy(F.col(key)).agg(F.count(F.lit(1)).alias(count_name))
            .where(F.col(count_name) > 1))


def loaded_delta(raw: DataFrame, success: DataFrame, raw_key: str = "Id",
                 success_key: str = "Migration_Id__c",
                 migration_col: str = "Migration_Id__c") -> DataFrame:
    """Raw rows that loaded successfully, with the migration id column set to the raw key.

    Multiplicity of the raw side is kept; a raw table that already holds ``migration_col`` gets
    that column overwritten rather than duplicated. A caller who knows the outcomes' bound may
    pass ``F.broadcast(success)``; else AQE decides from measured sizes.
    """
    keys = _keys(success, success_key, "__ferry_key")
    loaded = raw.join(keys, raw[raw_key] == keys["__ferry_key"], "left_semi")
    return loaded.withColumn(migration_col, F.col(raw_key))


def id_crosswalk(raw: DataFrame, success: DataFrame, raw_key: str = "Id",
                 success_key: str = "Migration_Id__c", target_col: str = "sf__Id") -> DataFrame:
    """``(source_id, migration_id, target_id)`` for every raw row x distinct loaded pair.

    A key loaded twice with two targets fans out; duplicate raw keys multiply. The success side
    must carry ``target_col``.
    """
    if target_col not in success.columns:
        raise ValueError(f"success outcomes lack the target id column {target_col!r}")
    pairs = reduce_apart(success.select(F.col(success_key).alias("migration_id"), F.col(target_col).alias("target_id"))
                         .where(F.col("migration_id").isNotNull()), ["migration_id", "target_id"],
                         F.count(F.lit(1)).alias("n")).drop("n")
    ids = raw.select(F.col(raw_key).alias("source_id"))
    return (ids.join(pairs, ids["source_id"] == pairs["migration_id"], "inner")
            .select("source_id", "migration_id", "target_id"))


def ambiguous_targets(crosswalk: DataFrame, key_col: str = "migration_id",
                      target_col: str = "target_id") -> DataFrame:
    """Keys that map to more than one distinct target (the rows that fan out in the crosswalk
    join): ``(key, targets)``. Two-phase: distinct pairs (a partial aggregate), then a count per
    key, so a key with many rows is collapsed before it moves; both phases are hash aggregates
    (no string min/max that would force a sort-based one)."""
    pairs = (crosswalk.select(F.col(key_col).alias(key_col), F.col(target_col).alias(target_col))
             .where(F.col(key_col).isNotNull() & F.col(target_col).isNotNull()).distinct())
    return (pairs.groupBy(key_col)
            .agg(F.count(F.lit(1)).alias("targets"))
            .where(F.col("targets") > 1))


def accumulate_crosswalk(existing: DataFrame | None, new: DataFrame,
                         key_cols: Sequence[str] | None = None) -> DataFrame:
    """Grow a crosswalk by one run: union by name, then one row per key (all columns by default)."""
    merged = new if existing is None else existing.unionByName(new, allowMissingColumns=True)
    return merged.dropDuplicates(list(key_cols)) if key_cols else merged.distinct()


def outcome_rows(success: DataFrame | None = None, error: DataFrame | None = None,
                 unprocessed: DataFrame | None = None) -> DataFrame:
    """Stack the three outcome sets of a bulk load into one table with an ``outcome`` column."""
    parts = []
    for name, frame in zip(OUTCOMES, (success, error, unprocessed)):
        if frame is not None:
            parts.append(frame.withColumn("outcome", F.lit(name)))
    if not parts:
        raise ValueError("no outcome set given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def outcome_by_job(outcomes: DataFrame, job_col: str = "job_id", outcome_col: str = "outcome") -> DataFrame:
    """Record counts per bulk job and outcome (partial aggregation, a few rows out)."""
    return (outcomes.groupBy(F.col(job_col).alias("job_id"), F.col(outcome_col).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("records")))


def outcome_by_batch(batched: DataFrame, outcomes: DataFrame, key: str = "Id",
                     outcome_key: str = "source_id", batch_col: str = "batch_id",
                     outcome_col: str = "outcome") -> DataFrame:
    """Outcome counts per load batch: ``(batch_id, outcome, records)``; input rows without an
    outcome count as ``missing``. The join is on the record id (both sides large: a shuffle
    join, or a broadcast if AQE measures one side small)."""
    out = outcomes.select(F.col(outcome_key).alias("__ferry_id"), F.col(outcome_col).alias("__ferry_outcome"))
    joined = batched.select(F.col(key).alias("__ferry_id"), F.col(batch_col).alias("batch_id")).join(
        out, "__ferry_id", "left")
    return (joined.groupBy("batch_id", F.coalesce("__ferry_outcome", F.lit("missing")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("records")))


def run_reconciliation(input_df: DataFrame, outcomes: DataFrame, outcome_col: str = "outcome") -> DataFrame:
    """One row: input, success, errors, unprocessed and the gap input - (sum of outcomes).

    Input and outcome rows are tagged and counted in a single aggregate (one pass, no join).
    """
    tags = (input_df.select(F.lit("input").alias("tag"))
            .unionByName(outcomes.select(F.col(outcome_col).cast("string").alias("tag"))))

    def n(tag: str) -> Column:
        return F.count_if(F.col("tag") == F.lit(tag)).cast("long")

    totals = tags.agg(n("input").alias("input"), n("success").alias("success"),
                      n("error").alias("errors"), n("unprocessed").alias("unprocessed"))
    return totals.withColumn(
        "gap", F.col("input") - F.col("success") - F.col("errors") - F.col("unprocessed"))
