"""Re-point record owners from old-org user ids to new-org user ids through the user crosswalk.

``owner_remap`` keeps every source row (left outer join on trimmed ids; blanks only are trimmed,
a tab stays). A crosswalk holding an old id twice fans the source row out, as the original job
did; ``dedupe_crosswalk=True`` keeps the lowest target per old id instead.

Skew: one owner may own a third of all records. The source side is the probing side of the
join, AQE's skew handling splits that partition, and the crosswalk side holds one row per user
(AQE broadcasts it when its materialised size is under the adaptive broadcast threshold).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.functions.predicates import absent, present
from ferry.operators.salting import SALT, reduce_apart, replicate_per_salt, salt_rows

REMAP_COLUMNS = ("id", "migration_id", "src_owner_id", "owner_id", "legacy_email", "legacy_username",
                 "legacy_isactive", "tfm_isactive", "tfm_email", "tfm_username")


def owner_remap(source: DataFrame, crosswalk: DataFrame, id_col: str = "Id",
                owner_col: str = "OwnerId", trim_keys: bool = True,
                dedupe_crosswalk: bool = False, salt_buckets: int = 0) -> DataFrame:
    """``salt_buckets > 1`` spreads each owner's records over that many tasks and replicates the
    crosswalk as often (see ``ferry.operators.salting``); the result is the same."""
    src = source.select(F.col(id_col).alias("id"), F.col(owner_col).alias("src_owner_id"))
    users = crosswalk.select("legacy_user_id", "tfm_user_id", "legacy_email", "legacy_username",
                             "legacy_isactive", "tfm_isactive", "tfm_email", "tfm_username")
    key = (lambda c: F.trim(c)) if trim_keys else (lambda c: c)
    users = users.withColumn("__ferry_key", key(F.col("legacy_user_id"))).where(
        F.col("__ferry_key").isNotNull())
    if dedupe_crosswalk:
        lowest = F.min(F.struct(F.col("tfm_user_id").isNull().alias("no_id"), "tfm_user_id", "legacy_user_id",
                                "legacy_email", "legacy_username", "legacy_isactive", "tfm_isactive",
                                "tfm_email", "tfm_username")).alias("u")
        users = reduce_apart(users, ["__ferry_key"], lowest).select("__ferry_key", "u.*").drop("no_id")
    cond = key(src["src_owner_id"]) == users["__ferry_key"]
    if salt_buckets > 1:
        src = salt_rows(src, salt_buckets)
        users = replicate_per_salt(users, salt_buckets)
        cond = (key(src["src_owner_id"]) == users["__ferry_key"]) & (src[SALT] == users[SALT])
    joined = src.join(users, cond, "left")
    return joined.select(
        F.col("id"), F.col("id").alias("migration_id"), F.col("src_owner_id"),
        F.col("tfm_user_id").alias("owner_id"), F.col("legacy_email"), F.col("legacy_username"),
        F.trim(F.col("legacy_isactive")).alias("legacy_isactive"), F.col("tfm_isactive"),
        F.col("tfm_email"), F.col("tfm_username"))


def owner_matched(remapped: DataFrame) -> DataFrame:
    """Update rows ``(id, owner_id)`` for records whose owner has a target."""
    return remapped.where(present("owner_id")).select("id", "owner_id")


def owner_unmatched_summary(remapped: DataFrame) -> DataFrame:
    """Records without a target owner, counted by old owner and what is known about that user.

    A null ``legacy_email`` with a non-null owner separates "owner unknown to the crosswalk" from
    "owner known, but without a target".
    """
    return (remapped.where(absent("owner_id"))
            .groupBy("src_owner_id", "legacy_email", "legacy_username", "legacy_isactive")
            .agg(F.count(F.lit(1)).alias("count")))
