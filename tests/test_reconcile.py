import pytest

from ferry.operators import (
    accumulate_crosswalk,
    assign_batches,
    duplicate_ids,
    id_crosswalk,
    loaded_delta,
    orphan_records,
    outcome_by_job,
    outcome_rows,
    run_reconciliation,
)


def _key(row):
    return tuple((v is not None, v if v is not None else "") for v in row)


def _rows(df, *cols):
    rows = df.select(*cols).collect() if cols else df.collect()
    return sorted((tuple(r) for r in rows), key=_key)


def test_orphans_null_duplicate_present(spark):
    src = spark.createDataFrame([(None, "n"), ("1", "a"), ("1", "b"), ("2", "c")], "Id string, v string")
    res = spark.createDataFrame([("2",), (None,)], "Migration_Id__c string")
    got = sorted(orphan_records(src, res).collect(), key=lambda r: (r.Id is not None, r.Id or "", r.v))
    assert [tuple(r) for r in got] == [(None, "n"), ("1", "a"), ("1", "b")]
    # invariant: orphans + matched source rows = source rows
    matched = src.join(res, src.Id == res.Migration_Id__c, "left_semi").count()
    assert len(got) + matched == src.count()


def test_duplicate_ids_null_is_a_group(spark):
    df = spark.createDataFrame([("1",), ("1",), (None,), (None,), ("2",)], "Id string")
    assert _rows(duplicate_ids(df)) == [(None, 2), ("1", 2)]


def test_loaded_delta_overwrites_existing_migration_column(spark):
    raw = spark.createDataFrame([("1", "old"), ("1", "old"), ("2", "old"), (None, "x")],
                                "Id string, Migration_Id__c string")
    ok = spark.createDataFrame([("1",), ("1",), ("3",)], "Migration_Id__c string")
    out = loaded_delta(raw, ok)
    assert out.columns == ["Id", "Migration_Id__c"]
    assert _rows(out) == [("1", "1"), ("1", "1")]


def test_id_crosswalk_fan_out(spark):
    raw = spark.createDataFrame([("1",), ("1",), ("2",), ("3",)], "Id string")
    ok = spark.createDataFrame([("1", "A"), ("1", "B"), ("2", "C"), ("2", "C")], "Migration_Id__c string, sf__Id string")
    got = _rows(id_crosswalk(raw, ok))
    assert got == [("1", "1", "A"), ("1", "1", "A"), ("1", "1", "B"), ("1", "1", "B"), ("2", "2", "C")]


def test_id_crosswalk_requires_target_column(spark):
    raw = spark.createDataFrame([("1",)], "Id string")
    ok = spark.createDataFrame([("1",)], "Migration_Id__c string")
    with pytest.raises(ValueError):
        id_crosswalk(raw, ok)


def test_accumulate_crosswalk_dedupes_runs(spark):
    a = spark.createDataFrame([("1", "1", "A"), ("2", "2", "B")], "source_id string, migration_id string, target_id string")
    b = spark.createDataFrame([("2", "2", "B"), ("3", "3", "C")], "source_id string, migration_id string, target_id string")
    assert _rows(accumulate_crosswalk(a, b)) == [("1", "1", "A"), ("2", "2", "B"), ("3", "3", "C")]
    assert _rows(accumulate_crosswalk(None, b)) == [("2", "2", "B"), ("3", "3", "C")]


def _outcomes(spark, s, e, u):
    mk = lambda n, job: spark.createDataFrame([(str(i), job) for i in range(n)], "Id string, job_id int")
    return outcome_rows(mk(s, 1), mk(e, 1), mk(u, 2))


def test_reconciliation_gap_and_edges(spark):
    inp = spark.createDataFrame([(str(i),) for i in range(10)], "Id string")
    r = run_reconciliation(inp, _outcomes(spark, 5, 3, 1)).first().asDict()
    assert r == {"input": 10, "success": 5, "errors": 3, "unprocessed": 1, "gap": 1}
    empty = spark.createDataFrame([], "Id string")
    r0 = run_reconciliation(empty, _outcomes(spark, 0, 0, 0)).first().asDict()
    assert r0 == {"input": 0, "success": 0, "errors": 0, "unprocessed": 0, "gap": 0}
    failed = run_reconciliation(inp, _outcomes(spark, 0, 10, 0)).first().asDict()
    assert failed["errors"] == 10 and failed["gap"] == 0


def test_outcome_by_job(spark):
    got = _rows(outcome_by_job(_outcomes(spark, 2, 1, 3)))
    assert got == [(1, "error", 1), (1, "success", 2), (2, "unprocessed", 3)]


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_batches_exact_with_hot_key(spark, ranges):
    # a third of the rows share one key: the tie-break spreads them over several ranges
    rows = [(i if i % 3 else 7, f"v{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "k long, v string")
    out = assign_batches(df, ["k"], batch_size=40, num_ranges=ranges, position_col="pos").collect()
    assert len(out) == 300
    pos = sorted(r.pos for r in out)
    assert pos == list(range(1, 301))
    by_pos = sorted(out, key=lambda r: r.pos)
    assert [r.k for r in by_pos] == sorted(r[0] for r in rows)
    assert all(r.batch_id == (r.pos - 1) // 40 for r in out)


def test_batches_empty(spark):
    df = spark.createDataFrame([], "k long")
    assert assign_batches(df, ["k"], batch_size=10).count() == 0


def test_outcome_by_batch_counts_missing(spark):
    from ferry.operators import outcome_by_batch
    batched = spark.createDataFrame([("1", 0), ("2", 0), ("3", 1)], "Id string, batch_id long")
    outs = spark.createDataFrame([("1", "success"), ("3", "error")], "source_id string, outcome string")
    got = _rows(outcome_by_batch(batched, outs))
    assert got == [(0, "missing", 1), (0, "success", 1), (1, "error", 1)]
