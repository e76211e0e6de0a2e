
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ferry.operators import (
    assign_batches,
    id_crosswalk,
    loaded_delta,
    orphan_records,
    outcome_rows,
    owner_matched,
    owner_remap,
    owner_unmatched_summary,
    run_reconciliation,
)

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
ids = st.one_of(st.none(), st.sampled_from(["1", "2", "3", " 4", "4 ", "", "\t5"]))


@SETTINGS
@given(src=st.lists(ids, max_size=25), res=st.lists(ids, max_size=25))
def test_orphans_plus_loaded_is_source(spark, src, res):
    s = spark.createDataFrame([(v, i) for i, v in enumerate(src)], "Id string, n int")
    r = spark.createDataFrame([(v,) for v in res], "Migration_Id__c string")
    orphans = orphan_records(s, r).count()
    delta = loaded_delta(s, r).count()
    assert orphans + delta == len(src)
    expected_orphans = sum(1 for v in src if v is None or v not in set(res))
    assert orphans == expected_orphans


@SETTINGS
@given(src=st.lists(ids, max_size=20),
       pairs=st.lists(st.tuples(ids, st.sampled_from(["A", "B", "C"])), max_size=20))
def test_crosswalk_is_raw_times_distinct_pairs(spark, src, pairs):
    s = spark.createDataFrame([(v,) for v in src], "Id string")
    p = spark.createDataFrame(pairs, "Migration_Id__c string, sf__Id string")
    distinct = set(pairs)
    expected = sum(1 for v in src for (m, _t) in distinct if v is not None and v == m)
    assert id_crosswalk(s, p).count() == expected


@SETTINGS
@given(owners=st.lists(ids, max_size=25),
       users=st.lists(st.tuples(ids, st.one_of(st.none(), st.sampled_from(["", " ", "T1", "T2"]))), max_size=8))
def test_matched_plus_unmatched_is_remapped(spark, owners, users):
    src = spark.createDataFrame([(str(i), o) for i, o in enumerate(owners)], "Id string, OwnerId string")
    xw = spark.createDataFrame(
        [(u, t, "e", "n", "true", "true", "te", "tn") for u, t in users],
        "legacy_user_id string, tfm_user_id string, legacy_email string, legacy_username string, "
        "legacy_isactive string, tfm_isactive string, tfm_email string, tfm_username string")
    rem = owner_remap(src, xw)
    n = rem.count()
    assert n >= len(owners)      # left join keeps every source row (and fans out)
    unmatched = sum(r["count"] for r in owner_unmatched_summary(rem).collect())
    assert owner_matched(rem).count() + unmatched == n


@SETTINGS
@given(n_in=st.integers(0, 30), s=st.integers(0, 10), e=st.integers(0, 10), u=st.integers(0, 10))
def test_reconciliation_gap(spark, n_in, s, e, u):
    inp = spark.createDataFrame([(str(i),) for i in range(n_in)], "Id string")
    mk = lambda k: spark.createDataFrame([(str(i),) for i in range(k)], "Id string")
    r = run_reconciliation(inp, outcome_rows(mk(s), mk(e), mk(u))).first()
    assert (r.input, r.success, r.errors, r.unprocessed, r.gap) == (n_in, s, e, u, n_in - s - e - u)


@SETTINGS
@given(keys=st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=60),
       size=st.integers(1, 9), ranges=st.integers(1, 6))
def test_batches_are_a_numbering_in_key_order(spark, keys, size, ranges):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")
    out = assign_batches(df, ["k"], batch_size=size, num_ranges=ranges, position_col="pos").collect()
    assert sorted(r.pos for r in out) == list(range(1, len(keys) + 1))
    by_pos = [r.k for r in sorted(out, key=lambda r: r.pos)]
    assert by_pos == sorted(keys, key=lambda k: (k is not None, k if k is not None else 0))
    assert all(r.batch_id == (r.pos - 1) // size for r in out)
