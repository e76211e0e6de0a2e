"""Plan-shape guards over every registered query: no cross joins, no window that moves all rows
into one task, and filters/projections that reach the scans where the query allows it."""

import pytest

import __spark_entry__ as entry
from ferry.operators.documents import attachment_parent_lookup, latest_version_manifest
from ferry.operators.identity import identity_match
from ferry.operators.owners import owner_remap
from ferry.operators.reconcile import id_crosswalk, loaded_delta, orphan_records
from ferry.plans.queries import QUERIES as PLAIN
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
QUERIES = {name: fn for name, fn in entry.queries().items() if name in PLAIN}
#: Their one window runs over a row per range of the batch assignment, a number set by a parameter.
BOUNDED_WINDOW = {"batch_assignment", "outcome_by_batch"}


def _top_level_lists(text: str) -> int:
    depth, lists = 0, 0
    for ch in text:
        if ch in "[(":
            if ch == "[" and depth == 0:
                lists += 1
            depth += 1
        elif ch in "])":
            depth -= 1
    return lists


def test_window_guard_detects_a_global_window(spark):
    from pyspark.sql import Window, functions as F
    df = spark.range(10).withColumn("g", F.col("id") % 2)
    one = df.withColumn("rn", F.row_number().over(Window.orderBy("id")))
    per = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("id")))
    args = [[l for l in _final_plan(spark, x).splitlines() if l.startswith("Arguments:") and "windowspec" in l][0]
            for x in (one, per)]
    assert [_top_level_lists(a[len("Arguments:"):]) for a in args] == [2, 3]


def _final_plan(spark, df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()          # run it so that the adaptive plan is final
    return spark._jvm.PythonSQLUtils.explainString(qe, "formatted")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_or_global_window(spark, name):
    plan = _final_plan(spark, QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for line in plan.splitlines():
        if name not in BOUNDED_WINDOW and line.startswith("Arguments:") and "windowspecdefinition(" in line:
            # Window arguments are [expressions], [partition keys], [order]; a window without
            # partition keys (all rows in one task) shows only two lists.
            assert _top_level_lists(line[len("Arguments:"):]) == 3, line


def test_scans_are_pruned(spark):
    plan = _final_plan(spark, QUERIES["orphan_records"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan
    plan = _final_plan(spark, QUERIES["eligible_contracts"](spark, SF))
    assert "LessThan(o_orderdate" in plan and "In(c_mktsegment" in plan
    plan = _final_plan(spark, QUERIES["partition_slice"](spark, SF))
    assert "PartitionFilters: [isnotnull(year" in plan


SKEW = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k"}


def _hot(spark):
    """Third of the rows on one key, the rest spread; several input tasks, so that a key can be split."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 997))
    return spark.range(0, 30_000, 1, 8).select(key.alias("Id"), F.sha2(F.col("id").cast("string"), 256).alias("v"))


def _keys(spark):
    keys = spark.range(0, 997, 1, 2).select(F.concat(F.lit("k"), "id").alias("k")).unionByName(
        spark.range(1).select(F.lit("hot").alias("k")))
    return keys.select(F.col("k").alias("Migration_Id__c"), F.concat(F.lit("N"), "k").alias("sf__Id"))


def _users(df):
    return df.select(F.monotonically_increasing_id().alias("Id"), F.lit("true").alias("IsActive"),
                     F.concat("k", F.lit("@x.org")).alias("Email"), F.concat("k", F.lit("@x.org")).alias("Username"))


CASES = {
    "orphans": lambda s: orphan_records(_hot(s), _keys(s)),
    "delta": lambda s: loaded_delta(_hot(s), _keys(s)),
    "crosswalk": lambda s: id_crosswalk(_hot(s), _keys(s)),
    "identity": lambda s: identity_match(_users(_hot(s).withColumnRenamed("Id", "k")),
                                         _users(_keys(s).withColumnRenamed("Migration_Id__c", "k"))),
    "manifest": lambda s: latest_version_manifest(
        _hot(s).select(F.col("v").alias("LinkedEntityId"), F.col("Id").alias("ContentDocumentId")),
        _keys(s).select(F.col("Migration_Id__c").alias("ContentDocumentId"), F.col("sf__Id").alias("Id"),
                        F.lit("t").alias("Title"), F.lit("x").alias("FileExtension"), F.lit(True).alias("IsLatest"))),
    "owners": lambda s: owner_remap(
        _hot(s).select(F.col("v").alias("Id"), F.col("Id").alias("OwnerId")),
        _keys(s).select(F.col("Migration_Id__c").alias("legacy_user_id"), F.col("sf__Id").alias("tfm_user_id"), *[
            F.lit("x").alias(c) for c in ("legacy_email", "legacy_username", "legacy_isactive", "tfm_isactive", "tfm_email", "tfm_username")]),
        dedupe_crosswalk=True),
    "parents": lambda s: attachment_parent_lookup(
        _hot(s).select(F.concat("Id", F.lit("_"), "v").alias("file_name")), _keys(s).withColumnRenamed("sf__Id", "Id")),
}


@pytest.mark.parametrize("name", CASES)
def test_hot_keys_are_split(spark, name):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    try:
        df = CASES[name](spark)
        plan = _final_plan(spark, df)
        rows = df.count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan, plan[:3000]
    assert rows == CASES[name](spark).count()
