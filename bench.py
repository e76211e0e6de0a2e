"""Time the registered queries at one scale factor and print ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run once to warm up, then ``BENCH_REPEAT`` times; the median wall time is reported.
A run = build the DataFrame (queries that publish write their files here) + execute it fully
into Spark's ``noop`` sink (no collect to the driver). ``skewed_joins`` times the joins with a third
of the rows on one key against evenly spread keys, with broadcasts off.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from ferry.operators.identity import identity_match  # noqa: E402
from ferry.operators.reconcile import id_crosswalk, loaded_delta, orphan_records  # noqa: E402
from ferry.plans import fixtures as fx  # noqa: E402
from ferry.plans.queries import QUERIES  # noqa: E402
from ferry.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))
ONLY = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _time(fn, repeat: int = REPEAT) -> float:
    fn()
    times = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return round(statistics.median(times), 3)


def _blank_third(users):
    hot = F.pmod(F.xxhash64("Id"), F.lit(3)) == 0
    return users.select("Id", "IsActive", *[F.when(hot, F.lit("")).otherwise(F.col(c)).alias(c)
                                            for c in ("Email", "Username")])


def skewed(spark) -> dict:
    """Joins with a third of the rows on one key, with broadcasts off, next to the same without it."""
    out = {}
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    lines = fx.line_as_raw(spark, SF_DIR).select("Id", "l_linenumber", "l_partkey")
    hot = lines.withColumn("Id", F.when(F.pmod(F.xxhash64("*"), F.lit(3)) == 0, F.lit("1")).otherwise(F.col("Id")))
    success = fx.success_orders(spark, SF_DIR)
    for label, raw in (("even", lines), ("hot_key", hot)):
        out[f"orphans_{label}"] = _time(lambda: _run(orphan_records(raw, success)), 1)
        out[f"delta_{label}"] = _time(lambda: _run(loaded_delta(raw, success)), 1)
        out[f"crosswalk_{label}"] = _time(lambda: _run(id_crosswalk(raw, success)), 1)
    legacy, target = fx.legacy_user(spark, SF_DIR), fx.target_user(spark, SF_DIR)
    kw = dict(aliases=fx.FIXTURE_ALIASES, canonical=fx.FIXTURE_CANONICAL)
    out["identity_even"] = _time(lambda: _run(identity_match(legacy, target, **kw)), 1)
    out["identity_hot_key"] = _time(lambda: _run(identity_match(_blank_third(legacy), _blank_third(target), **kw)), 1)
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return out


def main() -> None:
    spark = build_session(f"local[{CPUS}]", max(CPUS, 8), app_name="ferry-bench",
                          extra={"spark.driver.memory": "16g"})
    per_query = {}
    for name, fn in QUERIES.items():
        if ONLY and name not in ONLY:
            continue
        per_query[name] = _time(lambda fn=fn: _run(fn(spark, SF_DIR)))
    comp = {} if ONLY else skewed(spark)
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(per_query.values()), 3),
        "unit": "sec",
        "queries": per_query,
        "skewed_joins": comp,
        "sf": float(m.group(1)) if m else SF_DIR,
        "cpus": CPUS,
        "repeat": REPEAT,
    }))


if __name__ == "__main__":
    main()
