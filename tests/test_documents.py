import os
from datetime import datetime

from pyspark.sql import functions as F

from ferry.operators import (
    attachment_manifest,
    attachment_parent_lookup,
    attach_bodies,
    attachment_payload,
    unreadable_dates,
    eligible_contracts,
    latest_version_manifest,
    linked_to,
    name_collisions,
    transfer_summary,
)
from ferry.plans import fixtures as fx
from ferry.plans.jobs import attachment_uploads, document_manifest
from ferry.sources.binary import read_files


def test_eligible_contracts_status_and_day_cutoff(spark):
    contracts = spark.createDataFrame([
        ("C1", "A1", datetime(2025, 11, 20, 23, 59, 59)),
        ("C2", "A1", datetime(2025, 11, 21, 0, 0, 0)),
        ("C3", "A2", datetime(2025, 1, 1)),
        ("C4", None, datetime(2025, 1, 1)),
    ], "Id string, AccountId string, CreatedDate timestamp")
    accounts = spark.createDataFrame([("A1", "Migrated-PROD"), ("A2", "Not migrated")], "Id string, Status string")
    out = eligible_contracts(contracts, accounts, "AccountId", "Id", "Status", "CreatedDate")
    assert sorted(r.Id for r in out.collect()) == ["C1"]


def test_eligible_contracts_pushes_day_filter_to_scan(spark, tmp_dir):
    contracts = spark.createDataFrame([("C1", "A1", datetime(2025, 1, 1))],
                                      "Id string, AccountId string, CreatedDate timestamp_ntz")
    contracts.write.parquet(f"{tmp_dir}/c")
    accounts = spark.createDataFrame([("A1", "Migrated-PROD")], "Id string, Status string")
    out = eligible_contracts(spark.read.parquet(f"{tmp_dir}/c"), accounts, "AccountId", "Id", "Status", "CreatedDate")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(CreatedDate" in plan


def _versions(spark):
    return spark.createDataFrame([
        ("V2", "D1", "Plan v1.2024", "pdf", True),
        ("V1", "D1", "Other", "pdf", True),
        ("V0", "D1", "Old", "pdf", False),
        ("V5", "D2", "a/b\\c.docx", "", True),
        ("V7", "D3", None, "pdf", True),
        ("V8", "D4", "x.PDF", None, False),
        ("V9", "D5", "Same", "txt", True),
        ("V10", "D6", "Same", "txt", True),
    ], "Id string, ContentDocumentId string, Title string, FileExtension string, IsLatest boolean")


def test_latest_version_manifest(spark):
    links = spark.createDataFrame([("E1", "D1"), ("E1", "D2"), ("E2", "D3"), ("E2", "D4"),
                                   ("E3", "D5"), ("E3", "D6")], "LinkedEntityId string, ContentDocumentId string")
    m = {r.content_document_id: r for r in latest_version_manifest(links, _versions(spark)).collect()}
    assert set(m) == {"D1", "D2", "D3", "D5", "D6"}          # D4 has no latest version: skipped
    assert m["D1"].version_id == "V1" and m["D1"].file_name == "E1_Other.pdf"
    assert m["D2"].file_name == "E1_a_b_c"
    assert m["D3"].status == "failed" and m["D3"].file_name is None
    coll = [tuple(r) for r in name_collisions(latest_version_manifest(links, _versions(spark))).collect()]
    assert coll == [("E3_Same.txt", 2)]
    summary = {r.status: r["count"] for r in transfer_summary(latest_version_manifest(links, _versions(spark))).collect()}
    assert summary == {"ready": 4, "failed": 1}


def test_document_manifest_job(spark):
    contracts = spark.createDataFrame([("E1", "A1", datetime(2024, 1, 1)), ("E2", "A2", datetime(2024, 1, 1))],
                                      "Id string, AccountId string, CreatedDate timestamp")
    accounts = spark.createDataFrame([("A1", "Migrated-PREPROD"), ("A2", "x")], "Id string, Status string")
    links = spark.createDataFrame([("E1", "D1"), ("E2", "D2")], "LinkedEntityId string, ContentDocumentId string")
    out = document_manifest(contracts, accounts, links, _versions(spark))
    assert [r.file_name for r in out.collect()] == ["E1_Other.pdf"]


def test_linked_to_semi_join(spark):
    kids = spark.createDataFrame([("K1", "P1"), ("K2", "P1"), ("K3", "P9"), ("K4", None)], "Id string, ParentId string")
    parents = spark.createDataFrame([("P1",), ("P1",), (None,)], "Id string")
    assert sorted(r.Id for r in linked_to(kids, parents, "ParentId", "Id").collect()) == ["K1", "K2"]


def test_attachment_manifest_and_lookup(spark):
    att = spark.createDataFrame([("A1", "003A", "x/y.pdf"), ("A2", "004B", None)], "Id string, ParentId string, Name string")
    man = {r.attachment_id: r for r in attachment_manifest(att).collect()}
    assert man["A1"].file_name == "003A_x_y.pdf" and man["A2"].status == "failed"
    files = spark.createDataFrame([("003A_Some_File.pdf",), ("nounderscore",), ("_x",), ("9_z",)], "file_name string")
    parents = spark.createDataFrame([("N2", "003A"), ("N1", "003A"), ("N3", "nounderscore")],
                                    "Id string, Migration_Id__c string")
    got = {r.file_name: (r.migration_id, r.name, r.parent_id, r.status)
           for r in attachment_parent_lookup(files, parents).collect()}
    assert got == {"003A_Some_File.pdf": ("003A", "Some_File.pdf", "N1", "ready"),
                   "nounderscore": ("nounderscore", "", "N3", "ready"),
                   "_x": ("", "x", None, "no_parent"),
                   "9_z": ("9", "z", None, "no_parent")}


def test_attachment_payload_and_summary(spark, tmp_dir):
    for name, body in (("K1_a.pdf", bytes(range(100))), ("K2_b.pdf", b"x")):
        with open(f"{tmp_dir}/{name}", "wb") as f:
            f.write(body)
    files = read_files(spark, tmp_dir, with_content=False).select("path", "length", "file_name")
    parents = spark.createDataFrame([("N1", "K1")], "Id string, Migration_Id__c string")
    up = attachment_uploads(files, parents)
    pay = up["payload"].collect()
    assert len(pay) == 1 and pay[0].Name == "a.pdf" and pay[0].ParentId == "N1"
    assert len(pay[0].Body) == 136 and pay[0].ContentType == "application/pdf"
    assert {r.status: r["count"] for r in up["summary"].collect()} == {"ready": 1, "no_parent": 1}
    # bodies are read after the join: nothing of them is shuffled or sorted
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = up["payload"]._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep["spark.sql.autoBroadcastJoinThreshold"])
    moved = [line for line in plan.splitlines() if "Exchange" in line or "Sort" in line]
    assert moved and not any("content" in line for line in moved)
    # string content is encoded as UTF-8
    sfiles = spark.createDataFrame([("K1_t.txt", "hé")], "file_name string, content string")
    body = attachment_payload(attachment_parent_lookup(sfiles, parents, keep_cols=["content"])).first().Body
    assert body == "aMOp"


def test_bodies_are_dealt_out_by_bytes(spark, tmp_dir):
    """200 names in one partition, one file much larger: many tasks of even bytes, every body read once."""
    for i in range(200):
        open(f"{tmp_dir}/K{i}_f.bin", "wb").write(bytes([i]) * (300_000 if i == 7 else 2000 if i % 2 else 1))
    looked_up = read_files(spark, tmp_dir, with_content=False).select("path", "length", "file_name").withColumn("status", F.lit("ready")).coalesce(1)
    got = attach_bodies(looked_up, task_bytes=1 << 20)
    rows = got.select("file_name", "length", F.length("content").alias("n"), F.spark_partition_id().alias("p")).collect()
    assert len(rows) == 200 and all(r.n == r.length for r in rows)
    tasks = {}
    for r in rows:
        tasks[r.p] = tasks.get(r.p, 0) + r.n + (64 << 10)
    assert len(tasks) >= 10 and max(tasks.values()) < (1 << 20) + 300_000 + (64 << 10)
    assert attach_bodies(looked_up.where("false")).count() == 0


def test_small_files_share_tasks_and_batches(spark, tmp_dir):
    for i in range(200):
        open(f"{tmp_dir}/K{i}_f.bin", "wb").write(bytes([i]) * (1 + i % 3))
    files = read_files(spark, tmp_dir, with_content=False)
    assert files.rdd.getNumPartitions() == 1
    got = attach_bodies(files.select("path", "length", "file_name").withColumn("status", F.lit("ready")))
    assert got.rdd.getNumPartitions() == 1
    assert {r.file_name: bytes(r.content) for r in got.collect()} == {f"K{i}_f.bin": bytes([i]) * (1 + i % 3) for i in range(200)}


def test_document_files_are_written_where_documents_are_read(spark, tmp_dir):
    """Enough tasks read the documents: only texts that share a name are shuffled, of which one is kept whole."""
    rows = [(i if i < 77 else 76 if i < 79 else None, f"{i} é " * (i * 50), "en", "s", 1) for i in range(81)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(40).write.parquet(f"{tmp_dir}/documents.parquet")
    texts = {}
    for i, text, *_ in rows:
        texts.setdefault("None" if i is None else f"{i % 20}_doc{i}.txt", []).append(text.encode())
    moved = []
    for most in ("4m", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        folder = fx.document_files(spark, tmp_dir, f"{tmp_dir}/files{most}")
        parts = fx.dealt_by_name(fx.document_names(spark, tmp_dir), "file_name")
        moved.append([p.count() for p in parts if "Exchange hashpartitioning" in p._jdf.queryExecution().executedPlan().toString()])
        assert sum(p.count() for p in parts) == len(rows)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert sorted(os.listdir(folder)) == sorted(texts)
        assert all(open(f"{folder}/{name}", "rb").read() in any_of for name, any_of in texts.items())
    assert moved == [[5], [81]]


def test_a_date_that_is_none_stops_nothing(spark):
    contracts = spark.createDataFrame([("E1", "A1", "2020-01-01"), ("E2", "A1", "n/a"), ("E3", "A1", None), ("E4", "A1", " ")],
                                      "Id string, AccountId string, CreatedDate string")
    accounts = spark.createDataFrame([("A1", "Migrated-PROD")], "Id string, Status string")
    out = eligible_contracts(contracts, accounts, "AccountId", "Id", "Status", "CreatedDate")
    assert [r.Id for r in out.collect()] == ["E1"]
    assert [r.Id for r in unreadable_dates(contracts, "CreatedDate").collect()] == ["E2"]


def test_manifest_from_text_columns(spark):
    # everything read from CSV is text: the latest flag and dates arrive as strings
    versions = spark.createDataFrame([("V1", "D1", "A.pdf", "pdf", "TRUE"), ("V2", "D1", "B", "pdf", "false")],
                                     "Id string, ContentDocumentId string, Title string, FileExtension string, IsLatest string")
    links = spark.createDataFrame([("E1", "D1")], "LinkedEntityId string, ContentDocumentId string")
    assert [r.file_name for r in latest_version_manifest(links, versions).collect()] == ["E1_A.pdf"]
    contracts = spark.createDataFrame([("E1", "A1", "2025-11-20T23:00:00.000+0000"), ("E2", "A1", "2025-11-21T00:00:00.000+0000")],
                                      "Id string, AccountId string, CreatedDate string")
    accounts = spark.createDataFrame([("A1", "Migrated-PROD")], "Id string, Status string")
    out = eligible_contracts(contracts, accounts, "AccountId", "Id", "Status", "CreatedDate")
    assert [r.Id for r in out.collect()] == ["E1"]
