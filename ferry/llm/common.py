"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.session import scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only, so that every engine agrees."""
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())


def space_words(c: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts give an empty array."""
    trimmed = F.btrim(F.coalesce(c, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back.

    Later steps then read plain scans: nothing is computed twice, a lost executor costs no earlier
    step, and Spark can split a skewed key of a join right above them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    # The shuffle files of the finished job stay on the executors' disks until the driver's JVM
    # collects its garbage; in a sequence of such steps they would pile up.
    spark.sparkContext._jvm.System.gc()
    return spark.read.parquet(path)


def one_per_task(rows: DataFrame, key: str) -> DataFrame:
    """Deal the rows of a small written table out to a task each (adaptive execution would join
    such small partitions to one). For tables whose rows name files to work on."""
    return rows.repartitionByRange(max(1, rows.count()), key)


def broadcast_up_to(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast if a written table has at most ``rows`` rows; else leave the join to Spark."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
