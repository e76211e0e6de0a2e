import os
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ferry.operators import align_to_fields, attach_bodies, exportable_fields, field_names, filtered_extract, metadata_from_schema
from ferry.sinks import publish_snapshot, read_crosswalk, read_outcomes, read_run, run_ids, write_csv, write_outcomes, append_crosswalk
from ferry.sinks import publish
from ferry.sinks.publish import publish_counted
from ferry.sources import (
    header_catalog,
    header_drift,
    read_csv,
    read_files,
    register_views,
    run_registered,
    run_sql,
    statement_text,
    union_by_header,
)
from ferry.sources.sqltext import check_view_name, read_sql_text


def test_csv_round_trip_dialect(spark, tmp_dir):
    df = spark.createDataFrame([("1", None), ("2", ""), ("3", 'say "hi"'), ("4", "two\nlines"), ("5", "  pad  ")],
                               "Id string, v string")
    write_csv(df, f"{tmp_dir}/out")
    back = {r.Id: r.v for r in read_csv(spark, f"{tmp_dir}/out").collect()}
    assert back == {"1": None, "2": None, "3": 'say "hi"', "4": "two\nlines", "5": "pad"}


def test_csv_quote_all(spark, tmp_dir):
    df = spark.createDataFrame([("1", None), ("2", "")], "Id string, v string")
    write_csv(df, f"{tmp_dir}/qa", quote_all=True, single_file=True)
    files = [f for f in os.listdir(f"{tmp_dir}/qa") if f.endswith(".csv")]
    assert len(files) == 1
    text = open(f"{tmp_dir}/qa/{files[0]}").read()
    assert '"1",""' in text and '"2",""' in text


def test_csv_missing_and_empty_paths(spark, tmp_dir):
    with pytest.raises(AnalysisException):
        read_csv(spark, f"{tmp_dir}/nope")
    os.makedirs(f"{tmp_dir}/empty")
    with pytest.raises(AnalysisException):
        read_csv(spark, f"{tmp_dir}/empty")


def test_union_by_header_aligns_drifting_files(spark, tmp_dir):
    write_csv(spark.createDataFrame([("1", "a")], "Id string, A string"), f"{tmp_dir}/r/x")
    write_csv(spark.createDataFrame([("b", "2")], "A string, Id string"), f"{tmp_dir}/r/y")
    write_csv(spark.createDataFrame([("3", "c", "e")], "Id string, A string, B string"), f"{tmp_dir}/r/z")
    got = sorted(tuple(r) for r in union_by_header(spark, f"{tmp_dir}/r").select("Id", "A", "B").collect())
    assert got == [("1", "a", None), ("2", "b", None), ("3", "c", "e")]


def test_union_by_header_drift_inside_a_folder(spark, tmp_dir):
    d = f"{tmp_dir}/mixed"
    os.makedirs(d)
    with open(f"{d}/a.csv", "w") as f:
        f.write("Id,A\n1,a\n")
    with open(f"{d}/b.csv", "w") as f:
        f.write("A,Id\nb,2\n")
    with open(f"{d}/c.csv", "w") as f:
        f.write("Id,A,B\n3,c,e\n")
    got = sorted(tuple(r) for r in union_by_header(spark, d).select("Id", "A", "B").collect())
    assert got == [("1", "a", None), ("2", "b", None), ("3", "c", "e")]
    # trusting one header per folder is refused loudly, never read by position
    with pytest.raises(Exception, match="(?s)header|conform"):
        union_by_header(spark, d, group_by="directory").collect()


def test_header_catalog_and_drift(spark, tmp_dir):
    write_csv(spark.createDataFrame([("1", "a")], "Id string, A string"), f"{tmp_dir}/h/account")
    write_csv(spark.createDataFrame([("1", "a", "b")], "Id string, Name string, Extra string"), f"{tmp_dir}/h/contact")
    os.makedirs(f"{tmp_dir}/h/nofiles")
    cat = header_catalog(spark, f"{tmp_dir}/h", "csv")
    assert sorted(tuple(r) for r in cat.collect()) == [
        ("account", 1, "Id"), ("account", 2, "A"), ("contact", 1, "Id"), ("contact", 2, "Name"),
        ("contact", 3, "Extra")]
    expected = spark.createDataFrame([("account", 1, "A"), ("account", 2, "Id"), ("contact", 1, "Id"),
                                      ("contact", 2, "Name"), ("contact", 3, "Gone")],
                                     "object_name string, position int, column_name string")
    st = {(r.object_name, r.column_name): r.status for r in header_drift(cat, expected).collect()}
    assert st == {("account", "A"): "moved", ("account", "Id"): "moved", ("contact", "Id"): "same",
                  ("contact", "Name"): "same", ("contact", "Gone"): "missing", ("contact", "Extra"): "extra"}
    with pytest.raises(FileNotFoundError):
        header_catalog(spark, f"{tmp_dir}/h/nofiles")


def test_catalog_takes_the_first_file_of_each_object(spark, tmp_dir):
    """Files of a folder before those below it, empty files skipped; quoted, blank and repeated names."""
    root = f"{tmp_dir}/objects/x/objects"
    for path, text in {"a/b.csv": "Id,B\n1,2\n", "a/a.csv": "", "a/0/a.csv": "Sub\n", "n/year=1/run_id=2/p.csv": '\n"two\nlines",,x,X\n1,2,3,4\n',
                       "n/year=2/p.csv": "Later\n", "objects/c.csv": "Last", "_hidden/h.csv": "H\n", "none/readme.txt": "x"}.items():
        os.makedirs(os.path.dirname(f"{root}/{path}"), exist_ok=True)
        open(f"{root}/{path}", "w").write(text)
    assert sorted(tuple(r) for r in header_catalog(spark, root).collect()) == [
        ("a", 1, "Id"), ("a", 2, "B"), ("n", 1, "two\nlines"), ("n", 2, "_c1"), ("n", 3, "x2"), ("n", 4, "X3"), ("objects", 1, "Last")]
    spark.createDataFrame([(1, "x")], "Key int, Name string").write.parquet(f"{tmp_dir}/tables/t/run_id=1")
    assert sorted(tuple(r) for r in header_catalog(spark, f"{tmp_dir}/tables", "parquet").collect()) == [("t", 1, "Key"), ("t", 2, "Name")]


def test_union_of_many_files_takes_a_constant_number_of_jobs(spark, tmp_dir):
    def jobs(folder):
        group = folder.rsplit("/", 1)[-1]
        spark.sparkContext.setJobGroup(group, group)
        rows = union_by_header(spark, folder)
        n = rows.count()
        return n, set(rows.columns), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    found = {}
    for files in (6, 60):
        os.makedirs(f"{tmp_dir}/many{files}")
        for i in range(files):
            header = ("Id,A", "A,Id", "Id,A,B")[i % 3]
            open(f"{tmp_dir}/many{files}/{i}.csv", "w").write(f"{header}\n1,2{',3' if i % 3 == 2 else ''}\n")
        found[files] = jobs(f"{tmp_dir}/many{files}")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found[6][:2] == (6, {"Id", "A", "B"}) and found[60][:2] == (60, {"Id", "A", "B"})
    # Spark itself lists more than 32 paths by a job.
    assert 0 < found[60][2] <= found[6][2] + 2


def test_sql_text_comments_literals_semicolon(spark, tmp_dir):
    text = "-- full line comment\nSELECT 1 AS a, -- at the line end\n  '--not a comment' AS b\n  -- another\n;\n"
    assert statement_text(text).endswith("-- another")
    assert [tuple(r) for r in run_sql(spark, text).collect()] == [(1, "--not a comment")]
    p = f"{tmp_dir}/account.sql"
    with open(p, "w") as f:
        f.write(text)
    assert read_sql_text(spark, p) == text
    with pytest.raises(ValueError):
        check_view_name("prod-account")


def _opened(spark, names, opened):
    def loader(name):
        def load():
            opened.append(name)
            return spark.createDataFrame([(1, name)], "id int, origin string")
        return load
    return {n: loader(n) for n in names}


def test_only_named_sources_are_opened(spark, tmp_dir):
    opened = []
    sources = _opened(spark, [f"named_{i}" for i in range(36)], opened)
    sources["named_gone"] = lambda: spark.read.parquet(f"{tmp_dir}/none")
    spark.range(5).createOrReplaceTempView("named_own")
    result, report = run_registered(
        spark, """WITH named_9 AS (SELECT id, 'cte' AS origin FROM named_own)
                  -- named_4 is not read
                  SELECT n.origin, c.origin AS cte, 'named_5' AS word FROM Named_3 n JOIN named_9 c USING (id)
                  WHERE EXISTS (SELECT 1 FROM named_17 s WHERE s.id = n.id);""", sources, own="named_own")
    assert [tuple(r) for r in result.collect()] == [("named_3", "cte", "named_5")]
    # A common table expression hides the source of its name, which may be opened all the same.
    assert sorted(opened) == ["named_17", "named_3", "named_9"]
    status = {r["name"]: r["status"] for r in report.collect()}
    assert len(status) == 37
    assert sorted(n for n, s in status.items() if s != "not named") == ["named_17", "named_3", "named_9"]


def test_named_sources_that_are_missing_or_stale(spark, tmp_dir):
    spark.range(3).createOrReplaceTempView("stale_source")
    gone = {"stale_source": lambda: spark.read.parquet(f"{tmp_dir}/none")}
    with pytest.raises(AnalysisException, match="stale_source"):
        run_registered(spark, "SELECT * FROM stale_source", gone)
    result, report = run_registered(spark, "SELECT 1 AS one", gone)
    assert result.count() == 1 and report.collect()[0]["status"] == "not named"
    assert not spark.catalog.tableExists("stale_source")
    # The statement's own object stands before a source of its name, and other failures are raised.
    spark.range(4).createOrReplaceTempView("own_object")
    opened = []
    result, _ = run_registered(spark, "SELECT * FROM own_object", _opened(spark, ["own_object"], opened), own="own_object")
    assert result.count() == 4 and opened == []
    with pytest.raises(AnalysisException, match="no_such_column"):
        run_registered(spark, "SELECT * FROM bad", {"bad": lambda: spark.range(1).select("no_such_column")})
    with pytest.raises(AnalysisException, match="elsewhere"):
        run_registered(spark, "SELECT * FROM elsewhere", {})


def test_counts_of_all_views_in_one_job(spark):
    views = {"full_view": lambda: spark.range(7), "empty_view": lambda: spark.range(0)}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("count-views", "")
    try:
        report = register_views(spark, views, with_counts=True)
        jobs = len(tracker.getJobIdsForGroup("count-views"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r["name"]: r["n_rows"] for r in report.collect()} == {"full_view": 7, "empty_view": 0}
    assert jobs <= 2              # adaptive execution runs the map stage and the result as two jobs


def test_register_views_reports_missing(spark, tmp_dir):
    ok = spark.createDataFrame([(1,)], "x int")
    report = register_views(spark, {"present_view": lambda: ok,
                                    "absent_view": lambda: spark.read.parquet(f"{tmp_dir}/missing")},
                            required=False, with_counts=True)
    rows = {r.name: (r.status, r.n_rows, r.detail) for r in report.collect()}
    assert rows["present_view"] == ("registered", 1, None)
    assert rows["absent_view"][0] == "missing" and rows["absent_view"][2] == "PATH_NOT_FOUND"
    with pytest.raises(AnalysisException):
        register_views(spark, {"absent_view": lambda: spark.read.parquet(f"{tmp_dir}/missing")})


def test_snapshots_current_previous_and_idempotent_rerun(spark, tmp_dir):
    root = f"{tmp_dir}/snap"
    publish_snapshot(spark.createDataFrame([(1,)], "x int"), root, "20250101_000000")
    publish_snapshot(spark.createDataFrame([(2,), (3,)], "x int"), root, "20250102_000000")
    assert run_ids(spark, root) == ["20250101_000000", "20250102_000000"]
    assert sorted(r.x for r in read_run(spark, root, "current").collect()) == [2, 3]
    assert [r.x for r in read_run(spark, root, "previous").collect()] == [1]
    # a retried run replaces its own folder only
    publish_snapshot(spark.createDataFrame([(2,), (3,)], "x int"), root, "20250102_000000")
    assert sorted(r.x for r in read_run(spark, root, "current").collect()) == [2, 3]
    assert [r.x for r in read_run(spark, root, "previous").collect()] == [1]


def test_crosswalk_accumulates_across_runs(spark, tmp_dir):
    schema = "source_id string, migration_id string, target_id string"
    root = f"{tmp_dir}/xw"
    append_crosswalk(spark.createDataFrame([("1", "1", "A"), ("2", "2", "B")], schema), root, "r1")
    append_crosswalk(spark.createDataFrame([("2", "2", "B"), ("2", "2", "C")], schema), root, "r2")
    assert sorted(tuple(r) for r in read_crosswalk(spark, root).collect()) == [
        ("1", "1", "A"), ("2", "2", "B"), ("2", "2", "C")]


def test_crosswalk_runs_write_their_new_rows_only(spark, tmp_dir):
    """Against a plain set, over more runs than a bucket keeps versions; a failed run changes nothing."""
    schema, root, want = "source_id string, migration_id string, target_id string", f"{tmp_dir}/xw", set()
    kept, publish.BUCKET_VERSIONS = publish.BUCKET_VERSIONS, 3
    try:
        for run in range(6):
            rows = [(str(i), None if i % 7 == 0 else str(i), f"T{i % 3}") for i in range(run * 20, run * 20 + 40)] + [(None, None, "N")]
            want |= set(rows)
            append_crosswalk(spark.createDataFrame(rows * 2, schema), root, f"r{run}", buckets=4)
            got = [tuple(r) for r in read_crosswalk(spark, root).collect()]
            assert len(got) == len(want) and set(got) == want
    finally:
        publish.BUCKET_VERSIONS = kept
    big = f"{tmp_dir}/big"
    append_crosswalk(spark.range(20_000).selectExpr("cast(id as string) source_id", "cast(id as string) migration_id", "'T' target_id"), big, "r1")
    append_crosswalk(spark.createDataFrame([("5", "5", "T"), ("5", "5", "U")], schema), big, "r2")
    second = [v for v in os.listdir(f"{big}/data") if v.startswith("r2-")][0]
    assert [n for n in os.listdir(f"{big}/data/{second}") if n.startswith("bucket=")].__len__() == 1
    assert spark.read.parquet(f"{big}/data/{second}").count() == 1 and read_crosswalk(spark, big).count() == 20_001
    with pytest.raises(Exception, match="broken"):
        broken = spark.range(9).select(F.when(F.col("id") > 7, F.raise_error(F.lit("broken"))).otherwise("x").alias("source_id"),
                                       F.lit("m").alias("migration_id"), F.lit("t").alias("target_id"))
        append_crosswalk(broken, big, "r3")
    assert run_ids(spark, big) == ["r1", "r2"] and read_crosswalk(spark, big).count() == 20_001


def test_crosswalk_of_plain_run_folders_is_taken_over(spark, tmp_dir):
    schema, root = "source_id string, migration_id string, target_id string", f"{tmp_dir}/old"
    publish_snapshot(spark.createDataFrame([("1", "1", "A")], schema), root, "r1")
    assert read_crosswalk(spark, root).count() == 1
    append_crosswalk(spark.createDataFrame([("1", "1", "A"), ("2", "2", "B")], schema), root, "r2")
    assert sorted(r.source_id for r in read_crosswalk(spark, root).collect()) == ["1", "2"]
    append_crosswalk(spark.createDataFrame([], schema), f"{tmp_dir}/none", "r1")
    assert read_crosswalk(spark, f"{tmp_dir}/none").count() == 0


def test_write_outcomes_partitions(spark, tmp_dir):
    df = spark.createDataFrame([("order", "success", "1"), ("order", "error", "2"), ("order", "unprocessed", "3")],
                               "object string, outcome string, source_id string")
    write_outcomes(df, f"{tmp_dir}/o", "r1")
    assert sorted(os.listdir(f"{tmp_dir}/o/run_id=r1/object=order")) == ["outcome=error", "outcome=success", "outcome=unprocessed"]
    back = read_outcomes(spark, f"{tmp_dir}/o").where(F.col("outcome") == "error")
    assert [r.source_id for r in back.collect()] == ["2"]


def test_last_run_of_an_object_replaces_all_its_outcomes(spark, tmp_dir):
    schema = "object string, outcome string, source_id string"
    first = [("order", "success", "1"), ("order", "error", "2"), ("007", "error", "3")]
    write_outcomes(spark.createDataFrame(first, schema), f"{tmp_dir}/o", "r9")
    write_outcomes(spark.createDataFrame([("order", "success", "2")], schema), f"{tmp_dir}/o", "r10")
    got = sorted((r.object, r.outcome, r.source_id, r.run_id) for r in read_outcomes(spark, f"{tmp_dir}/o").collect())
    assert got == [("007", "error", "3", "r9"), ("order", "success", "2", "r10")]
    assert spark.read.parquet(f"{tmp_dir}/o/run_id=r9").count() == 3              # history stays
    with pytest.raises(FileNotFoundError):
        read_outcomes(spark, f"{tmp_dir}/o", ["lead"])


def test_runs_keep_their_columns_and_order(spark, tmp_dir):
    root = f"{tmp_dir}/runs"
    publish_snapshot(spark.createDataFrame([("1", "a")], "Id string, A string"), root, "9", "csv")
    publish_snapshot(spark.createDataFrame([("b", "2", "c")], "A string, Id string, B string"), root, "10", "csv")
    publish_snapshot(spark.createDataFrame([("z", "007")], "A string, Id string"), root, "007", "csv")
    assert run_ids(spark, root) == ["007", "9", "10"]
    assert [r.asDict() for r in read_run(spark, root, fmt="csv").collect()] == [{"A": "b", "Id": "2", "B": "c", "run_id": "10"}]
    assert [r.Id for r in read_run(spark, root, "previous", "csv").collect()] == ["1"]
    assert [(r.Id, r.run_id) for r in read_run(spark, root, "007", "csv").collect()] == [("007", "007")]
    os.makedirs(f"{root}/run_id=11")                           # half written: no success marker
    assert run_ids(spark, root)[-1] == "10"
    for bad in ("", "a/b", "../x", "a b"):
        with pytest.raises(ValueError):
            publish_snapshot(spark.range(1), root, bad)


def test_registration_drops_stale_views_and_raises_other_errors(spark, tmp_dir):
    spark.range(3).createOrReplaceTempView("stale_view")
    register_views(spark, {"stale_view": lambda: read_run(spark, f"{tmp_dir}/none")}, required=False)
    assert not spark.catalog.tableExists("stale_view")
    with pytest.raises(AnalysisException):
        register_views(spark, {"broken": lambda: spark.range(1).select("no_such_column")}, required=False)


def test_catalog_names_objects_by_the_first_folder(spark, tmp_dir):
    for obj, header in (("account", "Id,A"), ("contact", "Id,B,C")):
        for year in ("2024", "2025"):
            os.makedirs(f"{tmp_dir}/raw/{obj}/year={year}")
            with open(f"{tmp_dir}/raw/{obj}/year={year}/x.csv", "w") as f:
                f.write(header + "\n1,2,3\n")
    open(f"{tmp_dir}/raw/account/year=2024/a_empty.csv", "w").close()
    got = sorted(tuple(r) for r in header_catalog(spark, f"{tmp_dir}/raw").collect())
    assert got == [("account", 1, "Id"), ("account", 2, "A"), ("contact", 1, "Id"), ("contact", 2, "B"), ("contact", 3, "C")]


def test_read_files_binary(spark, tmp_dir):
    d = f"{tmp_dir}/att"
    os.makedirs(d)
    with open(f"{d}/K1_a.pdf", "wb") as f:
        f.write(b"%PDF")
    got = read_files(spark, d).collect()
    assert [(r.file_name, r.length, bytes(r.content)) for r in got] == [("K1_a.pdf", 4, b"%PDF")]


def test_listing_of_a_folder_is_that_of_spark_and_stays_off_the_driver(spark, tmp_dir):
    d = f"{tmp_dir}/a b%20é"
    os.makedirs(f"{d}/plain/below")
    os.makedirs(f"{d}/.hidden/k=1")
    for i in range(200):
        open(f"{d}/K{i}_f {i % 3}.{'pdf' if i % 2 else 'tx=t'}", "wb").write(b"x" * (i % 5))
    for name in ("_hidden", "_k=1", ".dot", "x._COPYING_", "_metadata", "%41_é:1.pdf", "plain/in.pdf", "plain/below/in.pdf", ".hidden/k=1/in.pdf"):
        open(f"{d}/{name}", "wb").write(b"abc")
    os.symlink(f"{d}/_k=1", f"{d}/link.pdf")
    os.symlink(f"{d}/none", f"{d}/broken.pdf")
    for glob in (None, "*.pdf", "K1?_*"):
        reader = spark.read.format("binaryFile")
        found = (reader.option("pathGlobFilter", glob) if glob else reader).load(d).select("path", "length", "modificationTime")
        got = read_files(spark, d, glob=glob, with_content=False)
        assert sorted(got.select("path", "length", "modification_time").collect()) == sorted(found.collect())
        assert all(r.file_name == r.path[r.path.rindex("/") + 1:] for r in got.collect())
        # Files in the scan are statuses on the driver.
        assert len(got.inputFiles()) < found.count()
    looked_up = read_files(spark, d, with_content=False).withColumn("status", F.lit("ready"))
    assert {r.path: len(r.content) for r in attach_bodies(looked_up).collect()} == {r.path: r.length for r in looked_up.collect()}


def test_listing_leaves_partitions_patterns_and_files_to_spark(spark, tmp_dir):
    for place in ("p/sub/year=1", "q"):
        os.makedirs(f"{tmp_dir}/{place}")
        open(f"{tmp_dir}/{place}/x.pdf", "wb").write(b"abc")
    for path in ("p", "q", "q*", "q/x.pdf", "q/"):
        got = read_files(spark, f"{tmp_dir}/{path}", with_content=False)
        assert sorted(r.path for r in got.collect()) == sorted(r.path for r in spark.read.format("binaryFile").load(f"{tmp_dir}/{path}").collect())
    assert read_files(spark, f"{tmp_dir}/p", with_content=False).count() == 1
    with pytest.raises(AnalysisException):
        read_files(spark, f"{tmp_dir}/none", with_content=False)


def test_metadata_selection(spark):
    meta = spark.createDataFrame([
        (0, "Id", "id", None), (1, "BillingAddress", "address", None), (2, "BillingCity", "string", "BillingAddress"),
        (3, "Any__c", "anyType", None), (4, "Body", "base64", None), (5, "Addr__c", "Address", None),
        (6, "Name", "string", ""), (7, "Geo__c", "location", None)],
        "position int, name string, type string, compoundFieldName string")
    assert field_names(exportable_fields(meta)) == ["Id", "Name"]


def test_align_and_filtered_extract(spark):
    df = spark.createDataFrame([("1", None, "x"), ("2", "r", "y")], "id string, Role string, other string")
    out = filtered_extract(df, ["Id", "role", "Legacy__c"], "role IS NULL")
    assert out.columns == ["Id", "role", "Legacy__c"]
    assert [tuple(r) for r in out.collect()] == [("1", None, "")]
    assert filtered_extract(df, ["Id"], "  ").count() == 2
    assert align_to_fields(df, ["other"]).columns == ["other"]


def test_metadata_from_schema(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    m = metadata_from_schema(spark, df, compound={"y": "Addr"}, types={"x": "id"})
    assert [tuple(r) for r in m.collect()] == [(0, "x", "id", None), (1, "y", "string", "Addr")]


def test_object_steps_and_sources(spark, tmp_dir):
    from ferry.plans.jobs import crosswalk_sources, object_steps, steps_for, success_sources
    steps = {r.object_name: r for r in object_steps(spark).collect()}
    assert len(steps) == 38
    assert sum(r.registered for r in steps.values()) == 36
    assert sum(r.orphan_checked for r in steps.values()) == 36
    assert sum(r.stamped for r in steps.values()) == 37
    assert steps_for("Account") == {"registered": True, "orphan_checked": True, "stamped": True}
    assert steps_for("zuora__product__c")["orphan_checked"] is False
    write_csv(spark.createDataFrame([("1", "1", "A")], "Id string, Migration_Id__c string, sf__Id string"),
              f"{tmp_dir}/prod/account/run1")
    report = register_views(spark, crosswalk_sources(spark, f"{tmp_dir}/prod", objects=["account", "lead"],
                                                     fmt="csv"), required=False)
    assert {r.name: r.status for r in report.collect()} == {"master_account": "registered", "master_lead": "missing"}
    assert spark.table("master_account").count() == 1
    out = spark.createDataFrame([("account", "success", "1"), ("account", "error", "2"), ("lead", "success", "3")],
                                "object string, outcome string, source_id string")
    write_outcomes(out, f"{tmp_dir}/outcomes", "r1")
    report = register_views(spark, success_sources(spark, f"{tmp_dir}/outcomes"), required=False)
    assert [r.source_id for r in spark.table("success_account").collect()] == ["1"]
    assert {r.name: r.status for r in report.collect()}["success_contact"] == "missing"


@pytest.mark.parametrize("keep", [True, False])
def test_publish_evaluates_once_and_commits_by_marker(spark, tmp_dir, keep):
    def traced(batches):
        open(f"{tmp_dir}/{uuid.uuid4().hex}.evaluated", "w").close()
        for batch in batches:
            yield batch if keep else batch.slice(0, 0)

    df = spark.range(0, 50, 1, 1).mapInArrow(traced, "id long")
    assert publish_counted(df, f"{tmp_dir}/out", "r1", "csv") == (50 if keep else 0)
    assert len([f for f in os.listdir(tmp_dir) if f.endswith(".evaluated")]) == 1
    assert run_ids(spark, f"{tmp_dir}/out") == (["r1"] if keep else [])
    assert os.path.exists(f"{tmp_dir}/out/run_id=r1") == keep


def test_a_failed_write_leaves_the_run_before_it(spark, tmp_dir):
    publish_counted(spark.range(3), f"{tmp_dir}/out", "r1")
    with pytest.raises(Exception, match="broken"):
        publish_counted(spark.range(5).select(F.when(F.col("id") > 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id")),
                        f"{tmp_dir}/out", "r2")
    assert run_ids(spark, f"{tmp_dir}/out") == ["r1"] and read_run(spark, f"{tmp_dir}/out").count() == 3


def test_publish_skip_if_empty(spark, tmp_dir):
    empty = spark.createDataFrame([], "x int")
    assert publish_snapshot(empty, f"{tmp_dir}/e", "r1", skip_if_empty=True) is None
    assert not os.path.exists(f"{tmp_dir}/e")


def test_read_csv_single_line_files_split(spark, tmp_dir):
    df = spark.range(20000).selectExpr("cast(id as string) as Id", "repeat('x', 50) as v")
    write_csv(df.coalesce(1), f"{tmp_dir}/big")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        multi = read_csv(spark, f"{tmp_dir}/big")
        single = read_csv(spark, f"{tmp_dir}/big", multiline=False)
        assert multi.rdd.getNumPartitions() == 1 < single.rdd.getNumPartitions()
        assert multi.count() == single.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
