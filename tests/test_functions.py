from datetime import datetime, timezone

from pyspark.sql import functions as F

from ferry.functions import (
    base64_unbroken,
    email_match_key,
    keyed_file_name,
    keyed_name_key,
    keyed_name_rest,
    path_safe,
    present,
    absent,
    scrub_line_breaks,
    strip_extension,
    utc_millis_stamp,
)


def _one(spark, values, expr, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col("v")).alias("o")).collect()]


def test_email_match_key_edges(spark):
    values = ["Joe@BigCo.com", "joe@bigco.co.uk", "nodomain", None, "", "a@b@c.com", "x@label", "x@.com",
              "a@feedonomics.com", "a@Feedonomics.com", "b@commerce.io"]
    got = _one(spark, values, email_match_key)
    assert got == ["joe@bigco", "joe@bigco", "nodomain@", None, "@", "a@b@c", "x@label", "x@",
                   "a@bigcommerce", "a@feedonomics", "b@bigcommerce"]


def test_email_match_key_case_insensitive_fold(spark):
    got = _one(spark, ["a@Feedonomics.com"], lambda c: email_match_key(c, case_insensitive=True))
    assert got == ["a@bigcommerce"]


def test_email_match_key_custom_aliases(spark):
    got = _one(spark, ["u1@AlphaCo.com", "u1@betaco.io", "u1@other.org"],
               lambda c: email_match_key(c, ("alphaco", "betaco"), "alphaco"))
    assert got == ["u1@alphaco", "u1@alphaco", "u1@other"]


def test_scrub_line_breaks_all_string_columns_only(spark):
    df = spark.createDataFrame([("a\r\nb", "a\nb", 1), ("a\rb", None, 2)], "x string, y string, n int")
    out = scrub_line_breaks(df).collect()
    assert [tuple(r) for r in out] == [("a  b", "a b", 1), ("a b", None, 2)]
    assert scrub_line_breaks(df).dtypes == df.dtypes


def test_scrub_line_breaks_single_projection(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    plan = scrub_line_breaks(df)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 1


def test_strip_extension_and_path_safe(spark):
    values = ["x.PDF", "Plan v1.2024", "a.tar.gz", "x.é12", "a/b\\c", None, "  Report.docx "]
    got = _one(spark, values, lambda c: path_safe(strip_extension(c)))
    assert got == ["x", "Plan v1", "a.tar.gz", "x", "a_b_c", None, "Report.docx"]


def test_keyed_file_name(spark):
    df = spark.createDataFrame([("P1", "doc", "pdf"), ("P1", "doc", ""), ("P1", "doc", None)],
                               "p string, n string, e string")
    got = [r[0] for r in df.select(keyed_file_name("p", "n", "e")).collect()]
    assert got == ["P1_doc.pdf", "P1_doc", "P1_doc"]


def test_keyed_name_parse(spark):
    values = ["003A_Some_File.pdf", "nounderscore", "_x"]
    assert _one(spark, values, keyed_name_key) == ["003A", "nounderscore", ""]
    assert _one(spark, values, keyed_name_rest) == ["Some_File.pdf", "", "x"]


def test_present_absent_are_complements(spark):
    values = [None, "", " ", "\t", "x"]
    assert _one(spark, values, present) == [False, False, True, True, True]
    assert _one(spark, values, absent) == [True, True, False, False, False]


def test_base64_unbroken(spark):
    df = spark.createDataFrame([(bytes(range(100)),)], "b binary")
    got = df.select(base64_unbroken("b")).first()[0]
    assert len(got) == 136 and "\n" not in got and "\r" not in got


def test_utc_millis_stamp():
    assert utc_millis_stamp(datetime(2025, 1, 2, 3, 4, 5, 678999, tzinfo=timezone.utc)) == "2025-01-02T03:04:05.678Z"
    assert utc_millis_stamp(datetime(2025, 1, 2, 3, 4, 5)) == "2025-01-02T03:04:05.000Z"
