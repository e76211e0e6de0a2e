"""Migration-shaped views over the shared test tables (TPC-H-like parquet files).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame derived by Spark from the tables,
so every query that uses it grows with the data. The same definitions are written as SQL for the
DuckDB oracle in ``ferry.plans.oracle``; keep the two in step.
"""

from __future__ import annotations

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.session import scratch_path

# --- fixed values: fixture e-mail domains --------------------------------------------------
# Domain by key % 4, and the alias labels of the fixture company.
FIXTURE_DOMAINS = ("AlphaCo.com", "betaco.io", "alphaco.net", "other.org")
FIXTURE_ALIASES = ("alphaco", "betaco")
FIXTURE_CANONICAL = "alphaco"

# Day cut-off and statuses used for contract eligibility over the test tables.
FIXTURE_STATUSES = ("BUILDING", "MACHINERY")
FIXTURE_CUTOFF = "1998-06-30"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def domain(k: Column) -> Column:
    m = F.pmod(k, F.lit(4))
    return (F.when(m == 0, F.lit(FIXTURE_DOMAINS[0])).when(m == 1, F.lit(FIXTURE_DOMAINS[1]))
            .when(m == 2, F.lit(FIXTURE_DOMAINS[2])).otherwise(F.lit(FIXTURE_DOMAINS[3])))


def padded_id(prefix: str, c: str) -> Column:
    return F.concat(F.lit(prefix), F.lpad(_s(c), 9, "0"))


# --- objects ---------------------------------------------------------------------------------

def raw_order(spark: SparkSession, d: str) -> DataFrame:
    """Orders as a raw object: string ``Id`` and ``OwnerId``."""
    return table(spark, d, "orders").select(
        _s("o_orderkey").alias("Id"), _s("o_custkey").alias("OwnerId"),
        "o_orderstatus", "o_totalprice", "o_orderpriority")


def loaded_line(spark: SparkSession, d: str) -> DataFrame:
    """Line items as the transformed/loaded side: ``Migration_Id__c`` is the order id."""
    return table(spark, d, "lineitem").select(
        _s("l_orderkey").alias("Migration_Id__c"), "l_linenumber", "l_suppkey")


def raw_line(spark: SparkSession, d: str) -> DataFrame:
    """Line items as a raw object whose id is ``orderkey-linenumber`` (natural duplicates)."""
    return table(spark, d, "lineitem").select(
        F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("Id"),
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


def line_as_raw(spark: SparkSession, d: str) -> DataFrame:
    """Line items as a raw object keyed by order id (several rows per key)."""
    return table(spark, d, "lineitem").select(
        _s("l_orderkey").alias("Id"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus")


def success_orders(spark: SparkSession, d: str) -> DataFrame:
    """Finished orders as success outcomes (``Migration_Id__c``, ``sf__Id``)."""
    o = table(spark, d, "orders").where(F.col("o_orderstatus") == "F")
    return o.select(_s("o_orderkey").alias("Migration_Id__c"),
                    F.concat(F.lit("N"), _s("o_orderkey")).alias("sf__Id"))


def success_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Success outcomes from line items: an order loaded once per supplier (retries with new ids)."""
    return table(spark, d, "lineitem").select(
        _s("l_orderkey").alias("Migration_Id__c"),
        F.concat(F.lit("S"), _s("l_suppkey")).alias("sf__Id"))


def outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Bulk outcomes per order: F success, O error, P (and anything else) unprocessed."""
    o = table(spark, d, "orders")
    st = F.col("o_orderstatus")
    outcome = (F.when(st == "F", F.lit("success")).when(st == "O", F.lit("error"))
               .otherwise(F.lit("unprocessed")))
    return o.select(
        F.lit("order").alias("object"), _s("o_orderkey").alias("source_id"),
        F.pmod(F.col("o_orderkey"), F.lit(7)).cast("long").alias("job_id"),
        outcome.alias("outcome"),
        F.when(st == "F", F.concat(F.lit("N"), _s("o_orderkey"))).alias("target_id"))


# --- users -----------------------------------------------------------------------------------

def legacy_user(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    k = F.col("c_custkey")
    local = F.pmod(k, F.lit(900)).cast("string")
    email = (F.when(F.pmod(k, F.lit(50)) == 0, F.lit(None).cast("string"))
             .when(F.pmod(k, F.lit(50)) == 1, F.lit("nodomain"))
             .otherwise(F.concat(F.lit("U"), local, F.lit("@"), domain(F.col("c_nationkey")))))
    return c.select(
        padded_id("L", "c_custkey").alias("Id"), email.alias("Email"),
        F.concat(F.lit("u"), local, F.lit("@"), domain(k)).alias("Username"),
        F.when(F.col("c_acctbal") >= 0, F.lit("true")).otherwise(F.lit("false")).alias("IsActive"))


def target_user(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").where(F.pmod(F.col("c_custkey"), F.lit(3)) != 0)
    k = F.col("c_custkey")
    n = F.col("c_nationkey")
    local = F.pmod(k, F.lit(900)).cast("string")
    shifted = F.when(F.pmod(n, F.lit(4)) == 1, n + 1).otherwise(n)
    return c.select(
        padded_id("T", "c_custkey").alias("Id"),
        F.concat(F.lit("u"), local, F.lit("@"), domain(shifted)).alias("Email"),
        F.concat(F.lit("u"), local, F.lit("@"), domain(k)).alias("Username"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("false")).otherwise(F.lit("true")).alias("IsActive"))


def user_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    """A user crosswalk as identity matching writes it: old ids with a blank in front; some
    users without a target (null, or ``''``)."""
    c = table(spark, d, "customer").where(F.pmod(F.col("c_custkey"), F.lit(7)) != 0)
    k = F.col("c_custkey")
    r = F.pmod(k, F.lit(10))
    has_target = ~r.isin(0, 1)
    return c.select(
        F.concat(F.lit(" "), _s(k)).alias("legacy_user_id"),
        F.when(r == 0, F.lit(None).cast("string")).when(r == 1, F.lit(""))
        .otherwise(F.concat(F.lit("T"), _s(k))).alias("tfm_user_id"),
        F.col("c_name").alias("legacy_email"),
        F.concat(F.lit("u"), _s(k)).alias("legacy_username"),
        F.when(F.col("c_acctbal") >= 0, F.lit(" true ")).otherwise(F.lit("false")).alias("legacy_isactive"),
        F.when(has_target, F.lit("true")).alias("tfm_isactive"),
        F.when(has_target, F.concat(F.lit("t"), _s(k), F.lit("@alphaco.net"))).alias("tfm_email"),
        F.when(has_target, F.concat(F.lit("t"), _s(k))).alias("tfm_username"))


def owned_order(spark: SparkSession, d: str) -> DataFrame:
    """Orders whose owner id is written with blanks around it."""
    return table(spark, d, "orders").select(
        _s("o_orderkey").alias("Id"),
        F.concat(F.lit(" "), _s("o_custkey"), F.lit(" ")).alias("OwnerId"))


# --- documents -------------------------------------------------------------------------------

def document_crlf(spark: SparkSession, d: str) -> DataFrame:
    """Documents; for even ids every line feed is written CRLF."""
    t = table(spark, d, "documents")
    crlf = F.when(F.pmod(F.col("doc_id"), F.lit(2)) == 0,
                  F.regexp_replace("text", "\n", "\r\n")).otherwise(F.col("text"))
    return t.select("doc_id", crlf.alias("text"), "lang", "source", "n_chars")


def contracts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        _s("o_orderkey").alias("Id"), _s("o_custkey").alias("AccountId"),
        F.col("o_orderdate").alias("CreatedDate"), "o_orderstatus")


def accounts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        _s("c_custkey").alias("Id"), F.col("c_mktsegment").alias("Status"))


def line_links(spark: SparkSession, d: str) -> DataFrame:
    """Line items as document links of orders."""
    return table(spark, d, "lineitem").select(
        _s("l_orderkey").alias("LinkedEntityId"),
        F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("ContentDocumentId"))


def document_links(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(
        F.concat(F.lit("C"), _s(F.pmod(F.col("doc_id"), F.lit(25)))).alias("LinkedEntityId"),
        _s("doc_id").alias("ContentDocumentId"))


def document_versions(spark: SparkSession, d: str) -> DataFrame:
    """Conversation turns as versions of the document with the conversation's id; the two last
    turns are both flagged latest; titles are page urls (conversations 25 apart share a page,
    so two documents of one parent can get the same file name), some null."""
    conv = table(spark, d, "conversations")
    last = conv.groupBy("conv_id").agg(F.max("turn").alias("last_turn"))
    pages = table(spark, d, "pages").select(F.col("page_id"), F.col("url"))
    page = F.pmod(conv["conv_id"], F.lit(25)) + F.floor(conv["conv_id"] / 50) * 25
    v = conv.join(last, "conv_id").join(pages, page == pages["page_id"], "left")
    t = F.col("turn")
    ext = (F.when(F.pmod(t, F.lit(3)) == 0, F.lit("pdf")).when(F.pmod(t, F.lit(3)) == 1, F.lit(""))
           .otherwise(F.lit(None).cast("string")))
    return v.select(
        F.concat(_s("conv_id"), F.lit("-"), F.lpad(_s(t), 3, "0")).alias("Id"),
        _s("conv_id").alias("ContentDocumentId"),
        F.when(F.pmod(t, F.lit(5)) == 4, F.lit(None).cast("string")).otherwise(F.col("url")).alias("Title"),
        ext.alias("FileExtension"),
        (t >= F.col("last_turn") - 1).alias("IsLatest"))


def contract_document_links(spark: SparkSession, d: str) -> DataFrame:
    """Line items as links from a contract (order) to the document with the part's number."""
    return table(spark, d, "lineitem").select(
        _s("l_orderkey").alias("LinkedEntityId"), _s("l_partkey").alias("ContentDocumentId"))


def contract_attachments(spark: SparkSession, d: str) -> DataFrame:
    """Pages as attachments of the contract (order) with the page's number."""
    return table(spark, d, "pages").select(
        F.concat(F.lit("A"), _s("page_id")).alias("Id"), _s("page_id").alias("ParentId"), F.col("url").alias("Name"))


def page_attachments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select(
        F.concat(F.lit("A"), _s("page_id")).alias("Id"),
        _s(F.pmod(F.col("page_id"), F.lit(20))).alias("ParentId"),
        F.col("url").alias("Name"))


def contract_parents(spark: SparkSession, d: str) -> DataFrame:
    """New-org contracts carrying old ids 0..16 as migration ids (several per id)."""
    return table(spark, d, "customer").select(
        F.concat(F.lit("P"), F.lpad(_s("c_custkey"), 6, "0")).alias("Id"),
        _s(F.pmod(F.col("c_custkey"), F.lit(17))).alias("Migration_Id__c"))


def document_names(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the name of their file, ``{old parent}_doc{id}.txt``."""
    name = F.concat(_s(F.pmod(F.col("doc_id"), F.lit(20))), F.lit("_doc"), _s("doc_id"), F.lit(".txt"))
    return table(spark, d, "documents").withColumn("file_name", name)


def dealt_by_name(df: DataFrame, name: str) -> list[DataFrame]:
    """The rows, in parts such that rows of one name are one task's.

    A scan may be few tasks: then all rows are dealt out by name, in as many tasks as set. A scan with some tasks for each
    core keeps its rows; only those that share a name move.
    """
    spark = df.sparkSession

    def moved(rows: DataFrame) -> DataFrame:
        return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), name)

    if df.rdd.getNumPartitions() < 4 * spark.sparkContext.defaultParallelism:
        return [moved(df)]
    path = scratch_path(spark, "shared-names")
    df.groupBy(F.col(name).alias("__ferry_name")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n").write.parquet(path)
    shared = spark.read.parquet(path)
    if shared.isEmpty():
        return [df]
    same = df[name].eqNullSafe(shared["__ferry_name"])
    return [df.join(shared, same, "left_anti"), moved(df.join(shared, same, "left_semi"))]


def document_files(spark: SparkSession, d: str, folder: str) -> str:
    """Documents as downloaded files ``{old parent}_doc{id}.txt`` below ``folder``, written by the
    executors; returns the folder."""
    def write(batches):
        store, root = fs.FileSystem.from_uri("/" + folder[5:].lstrip("/") if folder.startswith("file:") else folder)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for file_name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_output_stream(f"{root}/{file_name}", compression=None) as f:
                    f.write(text.encode())
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    # Writing files costs more than moving texts, moving texts takes as much disk again.
    for part in dealt_by_name(document_names(spark, d).select("file_name", F.coalesce("text", F.lit("")).alias("text")), "file_name"):
        part.mapInArrow(write, "n long").write.format("noop").mode("overwrite").save()
    return folder
