"""Match old-org users to new-org users on normalised e-mail and user-name keys.

Result (one row per distinct old user id; all old ids that are null collapse into one row):
``legacy_user_id, legacy_isactive, legacy_email, legacy_username, tfm_user_id, tfm_isactive,
tfm_email, tfm_email_trimmed, tfm_username, tfm_username_trimmed, rn`` where the chosen target is
the lowest target id (as text, a null id first) among the targets with equal keys, and ``rn`` is 1.

Plan, instead of "join every candidate, then rank in a window":

1. targets are reduced to the best one per key pair with a grouped ``min(struct)`` (a partial,
   map-side aggregate; a key pair shared by a third of all targets costs no more than any other),
2. old users are left-joined to that table (at most one partner per row, no candidate pairs);
   AQE turns this into a broadcast when the reduced table turns out small, and splits a hot key,
3. old users that share an id are reduced to one row with another grouped ``min(struct)``; the
   ordering inside the struct is the ranking of the original window (target id, nulls first).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.constants import DOMAIN_ALIASES, DOMAIN_CANONICAL
from ferry.functions.keys import email_match_key
from ferry.functions.predicates import present
from ferry.operators.salting import SALT, reduce_apart, replicate_per_salt, salt_rows

IDENTITY_COLUMNS = (
    "legacy_user_id", "legacy_isactive", "legacy_email", "legacy_username", "tfm_user_id",
    "tfm_isactive", "tfm_email", "tfm_email_trimmed", "tfm_username", "tfm_username_trimmed", "rn",
)


def _parsed(df: DataFrame, prefix: str, id_col: str, active_col: str, email_col: str,
            username_col: str, aliases, canonical, case_insensitive) -> DataFrame:
    return df.select(
        F.col(id_col).alias(f"{prefix}_user_id"),
        F.col(active_col).alias(f"{prefix}_isactive"),
        F.col(email_col).alias(f"{prefix}_email"),
        F.col(username_col).alias(f"{prefix}_username"),
        email_match_key(email_col, aliases, canonical, case_insensitive).alias(f"{prefix}_email_trimmed"),
        email_match_key(username_col, aliases, canonical, case_insensitive).alias(f"{prefix}_username_trimmed"),
    )


def identity_match(legacy: DataFrame, target: DataFrame, id_col: str = "Id",
                   active_col: str = "IsActive", email_col: str = "Email",
                   username_col: str = "Username", aliases: Sequence[str] = DOMAIN_ALIASES,
                   canonical: str = DOMAIN_CANONICAL, case_insensitive: bool = False,
                   with_candidates: bool = False, salt_buckets: int = 0,
                   unique_legacy_ids: bool = False) -> DataFrame:
    """Best target per old user. ``with_candidates`` adds how many targets shared the keys.

    ``salt_buckets > 1`` spreads old users sharing one key pair (e.g. thousands with an empty
    e-mail) over that many tasks and replicates the reduced target table as often.
    ``unique_legacy_ids=True`` (the caller guarantees that every old id is non-null and appears
    once, as record ids of a system of record do) skips the last per-id reduction and its
    shuffle: after the join every old row already has at most one target.
    """
    old = _parsed(legacy, "legacy", id_col, active_col, email_col, username_col,
                  aliases, canonical, case_insensitive)
    new = _parsed(target, "tfm", id_col, active_col, email_col, username_col,
                  aliases, canonical, case_insensitive)

    keys = ["tfm_email_trimmed", "tfm_username_trimmed"]
    best = reduce_apart(
        new.where(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull()), keys,
        F.min(F.struct(F.col("tfm_user_id").isNotNull().alias("has_id"), "tfm_user_id",
                       "tfm_isactive", "tfm_email", "tfm_username")).alias("t"),
        F.count(F.lit(1)).alias("candidates"))
    cond = (old["legacy_email_trimmed"] == best[keys[0]]) & (old["legacy_username_trimmed"] == best[keys[1]])
    if salt_buckets > 1:
        old = salt_rows(old, salt_buckets)
        best = replicate_per_salt(best, salt_buckets)
        cond = ((old["legacy_email_trimmed"] == best[keys[0]]) & (old["legacy_username_trimmed"] == best[keys[1]])
                & (old[SALT] == best[SALT]))
    joined = old.join(best, cond, "left")

    if unique_legacy_ids:
        cols = [F.col("legacy_user_id"), F.col("legacy_isactive"), F.col("legacy_email"),
                F.col("legacy_username"), F.col("t.tfm_user_id").alias("tfm_user_id"),
                F.col("t.tfm_isactive").alias("tfm_isactive"), F.col("t.tfm_email").alias("tfm_email"),
                F.col(keys[0]).alias("tfm_email_trimmed"), F.col("t.tfm_username").alias("tfm_username"),
                F.col(keys[1]).alias("tfm_username_trimmed"), F.lit(1).alias("rn")]
        if with_candidates:
            cols.append(F.coalesce(F.col("candidates"), F.lit(0)).alias("candidates"))
        return joined.select(*cols)

    # Rank: target id ascending with null first; remaining fields only make ties deterministic.
    ranked = F.struct(
        F.col("t.tfm_user_id").isNotNull().alias("has_id"),
        F.col("t.tfm_user_id").alias("tfm_user_id"),
        F.col("legacy_isactive"), F.col("legacy_email"), F.col("legacy_username"),
        F.col("t.tfm_isactive").alias("tfm_isactive"), F.col("t.tfm_email").alias("tfm_email"),
        F.col(keys[0]).alias("tfm_email_trimmed"), F.col("t.tfm_username").alias("tfm_username"),
        F.col(keys[1]).alias("tfm_username_trimmed"),
        F.coalesce(F.col("candidates"), F.lit(0)).alias("candidates"))
    one = joined.groupBy("legacy_user_id").agg(F.min(ranked).alias("w"))
    cols = [F.col("legacy_user_id")] + [
        F.col(f"w.{c}").alias(c) for c in IDENTITY_COLUMNS[1:-1]] + [F.lit(1).alias("rn")]
    if with_candidates:
        cols.append(F.col("w.candidates").alias("candidates"))
    return one.select(*cols)


def identity_pairs(matched: DataFrame) -> DataFrame:
    """``(legacy_user_id, tfm_user_id)`` for users that found a target (null and '' are absent)."""
    return matched.where(present("tfm_user_id")).select("legacy_user_id", "tfm_user_id")
