"""The command-line jobs end to end on CSV folders made from the smallest test tables."""

import os

from ferry.cli import main
from pyspark.sql import functions as F

from ferry.constants import ELIGIBLE_ACCOUNT_STATUSES
from ferry.plans import fixtures as fx
from ferry.plans.queries import ORDER_TRANSFORM_SQL
from ferry.sinks.publish import read_crosswalk, read_run, write_csv

SF = "/root/testdata/sf0.001"


def test_cli_jobs(spark, tmp_dir):
    raw = f"{tmp_dir}/raw/raw_order"
    write_csv(fx.raw_order(spark, SF), raw)
    for t in ("customer", "nation", "region", "documents"):
        write_csv(fx.table(spark, SF, t), f"{tmp_dir}/lookups/{t}")
    os.makedirs(f"{tmp_dir}/sql")
    with open(f"{tmp_dir}/sql/raw_order.sql", "w") as f:
        f.write(ORDER_TRANSFORM_SQL)
    out = f"{tmp_dir}/out"
    lookups = [f"--lookup={t}={tmp_dir}/lookups/{t}" for t in ("customer", "nation", "region", "documents")]
    c = main(["transform", "--object", "raw_order", "--sql", f"{tmp_dir}/sql", "--raw", raw, "--out", out,
              "--run-id", "r1", *lookups, "--crosswalk-root", f"{tmp_dir}/prod", "--orphan-check", "yes"], spark)
    n_raw = fx.raw_order(spark, SF).count()
    assert c["transformed"] > 0 and c["orphaned"] > 0 and c["transformed"] + c["orphaned"] == n_raw
    assert c["sources"]["customer"] == "registered" and c["sources"]["master_account"] == "missing"
    assert read_run(spark, f"{out}/transformed/raw_order", "current", "csv").count() == c["transformed"]

    # a year slice: input and outputs below year=Y
    write_csv(fx.raw_order(spark, SF).where("o_orderstatus = 'F'"), f"{raw}_by_year/year=2024")
    c = main(["transform", "--object", "raw_order", "--sql", f"{tmp_dir}/sql", "--raw", f"{raw}_by_year",
              "--year", "2024", "--out", out, "--run-id", "r2", *lookups, "--orphan-check", "yes"], spark)
    assert os.path.isdir(f"{out}/transformed/raw_order/year=2024/run_id=r2")
    assert c["transformed"] + c["orphaned"] == fx.raw_order(spark, SF).where("o_orderstatus = 'F'").count()

    success = f"{tmp_dir}/success"
    write_csv(fx.success_pairs(spark, SF), success)
    c = main(["after-load", "--object", "order", "--raw", raw, "--success", success, "--out", out,
              "--run-id", "r1"], spark)
    assert c["crosswalk"] > 0 and c["delta"] > 0

    legacy, target = f"{tmp_dir}/legacy", f"{tmp_dir}/target"
    write_csv(fx.legacy_user(spark, SF), legacy)
    write_csv(fx.target_user(spark, SF), target)
    c = main(["match-users", "--legacy", legacy, "--target", target, "--out", out, "--run-id", "r1"], spark)
    assert c["matched"] == fx.legacy_user(spark, SF).count()

    owned, users = f"{tmp_dir}/owned", f"{tmp_dir}/users"
    write_csv(fx.owned_order(spark, SF), owned)
    write_csv(fx.user_crosswalk(spark, SF), users)
    c = main(["remap-owners", "--object", "order", "--source", owned, "--users", users, "--out", out,
              "--run-id", "r1", "--salt", "4"], spark)
    assert c["matched"] > 0 and c["unmatched_groups"] > 0

    c = main(["headers", "--root", f"{tmp_dir}/lookups", "--out", out, "--run-id", "r1"], spark)
    assert c["columns"] == sum(len(fx.table(spark, SF, t).columns) for t in ("customer", "nation", "region", "documents"))

    c = main(["batches", "--input", raw, "--order-by", "Id", "--size", "100", "--out", out, "--run-id", "r1",
              "--format", "parquet", "--object", "Account", "--run-ts", "2025-01-02T03:04:05.678+00:00"], spark)
    assert c["rows"] == n_raw
    b = read_run(spark, f"{out}/batches", "current")
    assert {r.Migrated_Date__c for r in b.select("Migrated_Date__c").distinct().collect()} == {"2025-01-02T03:04:05.678Z"}
    assert b.agg({"batch_id": "max"}).first()[0] == (n_raw - 1) // 100


def test_cli_documents_and_reconcile(spark, tmp_dir):
    from ferry.sinks.publish import write_outcomes
    paths = {}
    for name, fn in (("contracts", fx.contracts), ("accounts", fx.accounts), ("links", fx.contract_document_links),
                     ("versions", fx.document_versions), ("parents", fx.contract_parents)):
        paths[name] = f"{tmp_dir}/{name}"
        write_csv(fn(spark, SF), paths[name])
    # accounts become active customers, contracts old enough, so that the job's own rules let them pass
    write_csv(fx.accounts(spark, SF).withColumn("Status", F.lit(ELIGIBLE_ACCOUNT_STATUSES[0])), paths["accounts"])
    write_csv(fx.contracts(spark, SF).withColumn("CreatedDate", F.when(F.col("Id") == "1", "n/a").otherwise("2001-02-03")), paths["contracts"])
    out = f"{tmp_dir}/out"
    c = main(["manifest", "--contracts", paths["contracts"], "--accounts", paths["accounts"], "--links", paths["links"],
              "--versions", paths["versions"], "--out", out, "--run-id", "r1"], spark)
    want = fx.contract_document_links(spark, SF).where("LinkedEntityId <> '1'").join(
        fx.document_versions(spark, SF).where("IsLatest").select("ContentDocumentId").distinct(), "ContentDocumentId", "left_semi")
    assert c["documents"] == want.count() > 0

    files = f"{tmp_dir}/files"
    os.makedirs(files)
    for name, body in (("3_a.pdf", b"%PDF-1"), ("19_b.pdf", b"%PDF-2"), ("nounderscore", b"x")):
        with open(f"{files}/{name}", "wb") as fh:
            fh.write(body)
    c = main(["attachments", "--files", files, "--parents", paths["parents"], "--out", out, "--run-id", "r1"], spark)
    assert c["payload"] == 1 and c["summary"] == {"ready": 1, "no_parent": 2}

    raw = f"{tmp_dir}/raw"
    write_csv(fx.raw_order(spark, SF), raw)
    write_outcomes(fx.outcomes(spark, SF), f"{tmp_dir}/outcomes", "r1")
    c = main(["reconcile", "--input", raw, "--outcomes", f"{tmp_dir}/outcomes", "--out", out], spark)
    assert c["totals"]["gap"] == 0 and c["totals"]["input"] == fx.raw_order(spark, SF).count()
    by_job = read_run(spark, f"{out}/outcome_by_job", "current", "csv")
    assert sum(int(r["records"]) for r in by_job.collect()) == c["totals"]["input"]
    assert c["job_outcome_rows"] == by_job.count()


def test_jobs_read_the_current_run_by_header(spark, tmp_dir):
    legacy, target = f"{tmp_dir}/legacy", f"{tmp_dir}/target"
    write_csv(fx.legacy_user(spark, SF), legacy)
    write_csv(fx.target_user(spark, SF), target)
    out = f"{tmp_dir}/out"
    for run in ("r1", "r2"):
        main(["match-users", "--legacy", legacy, "--target", target, "--out", out, "--run-id", run], spark)
    first = read_run(spark, f"{out}/user", "current", "csv").first()
    owned = f"{tmp_dir}/owned"
    write_csv(spark.createDataFrame([("R1", first.legacy_user_id)], "Id string, OwnerId string"), owned)
    args = ["remap-owners", "--object", "order", "--source", owned, "--users", f"{out}/user_matched", "--out", out]
    c = main([*args, "--run-id", "r1"], spark)
    assert (c["remapped"], c["matched"]) == (1, 1)             # not once per published run

    # files with columns in another order are matched by name
    mixed = f"{tmp_dir}/mixed"
    os.makedirs(mixed)
    for name, text in (("a.csv", f"Id,OwnerId\nR1,{first.legacy_user_id}\n"), ("b.csv", f"OwnerId,Id\n{first.legacy_user_id},R2\n")):
        with open(f"{mixed}/{name}", "w") as fh:
            fh.write(text)
    c = main(["remap-owners", "--object", "lead", "--source", mixed, "--users", f"{out}/user_matched", "--out", out, "--run-id", "r1"], spark)
    assert sorted(r.id for r in read_run(spark, f"{out}/matched/lead", fmt="csv").collect()) == ["R1", "R2"]


def test_a_run_without_rows_leaves_the_current_one(spark, tmp_dir):
    raw, hit, miss, out = (f"{tmp_dir}/{n}" for n in ("raw", "hit", "miss", "out"))
    write_csv(spark.createDataFrame([("1", "x")], "Id string, v string"), raw)
    write_csv(spark.createDataFrame([("1", "N1")], "Migration_Id__c string, sf__Id string"), hit)
    write_csv(spark.createDataFrame([("2", "N2")], "Migration_Id__c string, sf__Id string"), miss)
    args = ["after-load", "--object", "order", "--raw", raw, "--out", out]
    assert main([*args, "--success", hit, "--run-id", "r1"], spark)["crosswalk"] == 1
    c = main([*args, "--success", miss, "--run-id", "r2"], spark)
    assert (c["crosswalk"], c["delta"], c["duplicates"]) == (0, 0, 0)
    assert read_crosswalk(spark, f"{out}/prod_data/order").count() == 1
    assert read_run(spark, f"{out}/joined_output/order", fmt="csv").count() == 1


def test_published_checks_do_not_go_through_csv(spark, tmp_dir):
    from ferry.plans.jobs import publish_transform, transform_object
    raw = spark.createDataFrame([(" 1 ", "a")], "Id string, v string")
    tr = transform_object(spark, "blank_keys", "SELECT Id AS Migration_Id__c, v FROM blank_keys", raw)
    assert publish_transform(tr, f"{tmp_dir}/out", "blank_keys", "r1", "csv") == {"transformed": 1, "orphaned": 0}
