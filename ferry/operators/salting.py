"""Deterministic salting for joins whose probing side may hold a hot key.

The large side gets a salt computed from the row itself (so a re-run task gives every row the
same salt); the small side is replicated once per salt value. Joining on (key, salt) then yields
exactly the rows of the plain join, while a key that holds a third of all rows is spread over
``buckets`` tasks. Use it when the small side is small enough to replicate ``buckets`` times;
otherwise leave hot keys to AQE's skew-join splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "__ferry_salt"


def salt_rows(df: DataFrame, buckets: int) -> DataFrame:
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.withColumn(SALT, F.pmod(row_hash, F.lit(buckets)).cast("int"))


def reduce_apart(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """``df.groupBy(*keys).agg(*aggs)``, dealt out in a way that a join on ``keys`` cannot reuse.

    Spark splits a hot key of a join only where both inputs are shuffled for that join. An aggregate
    on the join key leaves its own partitioning in place of the shuffle, so a key that holds a
    third of the other side would stay one task. Grouping by a hash next to the keys costs the
    (reduced) side one more shuffle and lets the big side be split.
    """
    spread = F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("__ferry_spread")
    return df.groupBy(spread, *[F.col(f"`{k}`") for k in keys]).agg(*aggs).drop("__ferry_spread")


def replicate_per_salt(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
