"""The whole hand-over between jobs: transform -> load outcomes -> crosswalk -> the next
object's transform maps its parent ids through ``master_<object>``."""

from pyspark.sql import functions as F

from ferry.operators import outcome_rows, run_reconciliation
from ferry.plans import fixtures as fx
from ferry.plans.jobs import after_load, crosswalk_sources, publish_transform, transform_object
from ferry.sinks.publish import append_crosswalk, read_run

SF = "/root/testdata/sf0.001"

ORDER_SQL = """
-- new orders keep their old id; priority 5-LOW is not migrated
SELECT Id AS Migration_Id__c, OwnerId AS Account__c, o_orderstatus AS Status
FROM order_raw WHERE o_orderpriority <> '5-LOW'
"""

LINE_SQL = """
-- a line points at its order's NEW id, looked up in the crosswalk of the orders
SELECT l.Id AS Migration_Id__c, m.target_id AS Order__c, l.l_quantity AS Quantity
FROM line_raw l JOIN master_order m ON m.migration_id = l.OrderId
"""


def test_transform_load_crosswalk_next_transform(spark, tmp_dir):
    orders = fx.raw_order(spark, SF)
    tr = transform_object(spark, "order_raw", ORDER_SQL, orders, orphan_check=True)
    counts = publish_transform(tr, f"{tmp_dir}/out", "order", "r1", fmt="parquet")
    n = orders.count()
    assert counts["transformed"] + counts["orphaned"] == n

    # the load: every transformed order succeeds except the open ones, which fail
    loaded = read_run(spark, f"{tmp_dir}/out/transformed/order")
    success = loaded.where(F.col("Status") != "O").select(
        "Migration_Id__c", F.concat(F.lit("NEW"), F.col("Migration_Id__c")).alias("sf__Id"))
    error = loaded.where(F.col("Status") == "O").select("Migration_Id__c")
    totals = run_reconciliation(loaded, outcome_rows(success, error)).first()
    assert totals.gap == 0 and totals.success + totals.errors == counts["transformed"]

    parts = after_load(orders, success)
    append_crosswalk(parts["crosswalk"], f"{tmp_dir}/prod/order", "r1")

    # the next object reads the orders' crosswalk as master_order
    lines = fx.table(spark, SF, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("Id"),
        F.col("l_orderkey").cast("string").alias("OrderId"), "l_quantity")
    tr2 = transform_object(spark, "line_raw", LINE_SQL, lines,
                           optional=crosswalk_sources(spark, f"{tmp_dir}/prod", objects=["order", "account"]))
    status = {r.name: r.status for r in tr2.sources.collect()}
    assert status == {"master_order": "registered", "master_account": "missing"}
    got = tr2.result
    assert got.where(~F.col("Order__c").startswith("NEW")).count() == 0
    expected = lines.join(success, lines.OrderId == success.Migration_Id__c, "left_semi").count()
    assert got.count() == expected
    # orphans of the line transform are the lines whose order did not load
    assert tr2.orphans.count() == lines.count() - expected
