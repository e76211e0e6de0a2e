from ferry.operators import identity_match, identity_pairs, owner_matched, owner_remap, owner_unmatched_summary

USER = "Id string, Email string, Username string, IsActive string"


def test_identity_lowest_target_wins_and_null_ids_collapse(spark):
    legacy = spark.createDataFrame([
        ("L1", "a@x.com", "a@x.com", "true"),
        (None, "b@x.com", "b@x.com", "true"),
        (None, "c@x.com", "c@x.com", "false"),
        ("L3", None, "n@x.com", "true"),
    ], USER)
    target = spark.createDataFrame([
        ("T9", "A@x.org", "a@x.net", "true"),
        ("T2", "a@x.io", "a@x.com", "true"),
        ("T5", "b@x.com", "b@x.com", "true"),
    ], USER)
    out = {r.legacy_user_id: r for r in identity_match(legacy, target, with_candidates=True).collect()}
    assert set(out) == {"L1", None, "L3"}
    assert out["L1"].tfm_user_id == "T2" and out["L1"].candidates == 2 and out["L1"].rn == 1
    # two old rows with a null id collapse to one; the one without a target ranks first
    assert out[None].tfm_user_id is None and out[None].legacy_email == "c@x.com"
    # a null key never matches
    assert out["L3"].tfm_user_id is None
    pairs = [tuple(r) for r in identity_pairs(identity_match(legacy, target)).collect()]
    assert pairs == [("L1", "T2")]


def test_identity_columns(spark):
    legacy = spark.createDataFrame([("L1", "a@x.com", "a@x.com", "true")], USER)
    out = identity_match(legacy, legacy)
    assert out.columns == ["legacy_user_id", "legacy_isactive", "legacy_email", "legacy_username",
                           "tfm_user_id", "tfm_isactive", "tfm_email", "tfm_email_trimmed",
                           "tfm_username", "tfm_username_trimmed", "rn"]


def _crosswalk(spark, rows):
    return spark.createDataFrame(
        rows, "legacy_user_id string, tfm_user_id string, legacy_email string, legacy_username string, "
              "legacy_isactive string, tfm_isactive string, tfm_email string, tfm_username string")


def test_owner_remap_trim_tab_empty_null(spark):
    src = spark.createDataFrame([("r1", " 1 "), ("r2", "\t2"), ("r3", ""), ("r4", None), ("r5", "3"), ("r6", "4"),
                                 ("r7", "9")], "Id string, OwnerId string")
    users = _crosswalk(spark, [
        (" 1", "T1", "e1", "u1", " true ", "true", "t1", "tu1"),
        ("2", "T2", "e2", "u2", "true", "true", "t2", "tu2"),
        ("3", " ", "e3", "u3", "false", None, None, None),
        ("4", "", "e4", "u4", "false", None, None, None),
    ])
    rem = owner_remap(src, users)
    by_id = {r.id: r for r in rem.collect()}
    assert by_id["r1"].owner_id == "T1" and by_id["r1"].legacy_isactive == "true"
    assert by_id["r2"].owner_id is None           # a tab is not trimmed
    assert by_id["r5"].owner_id == " "            # a blank target counts as present
    matched = sorted(tuple(r) for r in owner_matched(rem).collect())
    assert matched == [("r1", "T1"), ("r5", " ")]
    summary = {(r.src_owner_id, r.legacy_email): r["count"] for r in owner_unmatched_summary(rem).collect()}
    assert summary == {("\t2", None): 1, ("", None): 1, (None, None): 1, ("4", "e4"): 1, ("9", None): 1}
    # invariant: matched + unmatched = remapped rows
    assert owner_matched(rem).count() + sum(summary.values()) == rem.count()


def test_owner_remap_fan_out_and_dedupe(spark):
    src = spark.createDataFrame([("r1", "1")], "Id string, OwnerId string")
    users = _crosswalk(spark, [("1", "T2", "e", "u", "t", "t", "t", "t"), (" 1 ", "T1", "e", "u", "t", "t", "t", "t")])
    assert owner_remap(src, users).count() == 2
    one = owner_remap(src, users, dedupe_crosswalk=True).collect()
    assert [r.owner_id for r in one] == ["T1"]


def test_salted_joins_give_the_same_rows(spark):
    from ferry.plans import fixtures as fx
    d = "/root/testdata/sf0.001"
    src, xw = fx.owned_order(spark, d), fx.user_crosswalk(spark, d)
    plain = sorted(map(tuple, owner_remap(src, xw).collect()), key=str)
    salted = sorted(map(tuple, owner_remap(src, xw, salt_buckets=8).collect()), key=str)
    assert plain == salted
    legacy, target = fx.legacy_user(spark, d), fx.target_user(spark, d)
    kw = dict(aliases=fx.FIXTURE_ALIASES, canonical=fx.FIXTURE_CANONICAL)
    a = sorted(map(tuple, identity_match(legacy, target, **kw).collect()), key=str)
    b = sorted(map(tuple, identity_match(legacy, target, salt_buckets=5, **kw).collect()), key=str)
    assert a == b


def test_identity_output_feeds_owner_remap(spark):
    from ferry.plans import fixtures as fx
    from pyspark.sql import functions as F
    d = "/root/testdata/sf0.001"
    users = identity_match(fx.legacy_user(spark, d), fx.target_user(spark, d),
                           aliases=fx.FIXTURE_ALIASES, canonical=fx.FIXTURE_CANONICAL)
    records = fx.table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("Id"),
        F.concat(F.lit("L"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("OwnerId"))
    rem = owner_remap(records, users)
    assert rem.count() == records.count()
    matched = owner_matched(rem).count()
    unmatched = sum(r["count"] for r in owner_unmatched_summary(rem).collect())
    assert matched > 0 and matched + unmatched == records.count()


def test_owner_remap_plain_equality(spark):
    # the template update job joined owners without trimming: ' 1' does not find '1'
    src = spark.createDataFrame([("r1", "1"), ("r2", " 1")], "Id string, OwnerId string")
    users = _crosswalk(spark, [("1", "T1", "e", "u", "t", "t", "t", "t")])
    got = {r.id: r.owner_id for r in owner_remap(src, users, trim_keys=False).collect()}
    assert got == {"r1": "T1", "r2": None}
    got = {r.id: r.owner_id for r in owner_remap(src, users).collect()}
    assert got == {"r1": "T1", "r2": "T1"}


def test_identity_unique_ids_shortcut_gives_the_same_rows(spark):
    from ferry.plans import fixtures as fx
    d = "/root/testdata/sf0.001"
    legacy, target = fx.legacy_user(spark, d), fx.target_user(spark, d)
    kw = dict(aliases=fx.FIXTURE_ALIASES, canonical=fx.FIXTURE_CANONICAL, with_candidates=True)
    a = identity_match(legacy, target, **kw)
    b = identity_match(legacy, target, unique_legacy_ids=True, **kw)
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
