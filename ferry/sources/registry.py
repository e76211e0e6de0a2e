"""Register named sources as temp views, with an availability report for optional ones.

Optional sources (e.g. earlier crosswalks) may be missing on a first run; instead of printing
and carrying on silently, the report lists what was registered and what was not, and why. Only
"not there" counts as missing (no such path, an empty folder, no published run); any other failure
is raised. A missing source's view of an earlier registration is dropped, so SQL cannot read it.
Required sources raise. ``run_registered`` opens only the optional sources that a statement names.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.sources.sqltext import check_view_name, run_sql, statement_text

Loader = Callable[[], DataFrame]

#: Error conditions that mean that a source is not there.
NOT_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")

REPORT = "name string, status string, n_columns int, detail string"


def register_views(spark: SparkSession, sources: Mapping[str, Loader], required: bool = True,
                   with_counts: bool = False, threads: int = 8) -> DataFrame:
    """Run each loader, register the result under its name, and report
    ``(name, status, n_columns, detail)`` (plus ``n_rows`` when ``with_counts``).

    Loader failures that mean "not there" (missing path, empty folder) are reported as
    ``missing`` for optional sources; any failure of a required source is raised. Loaders (schema
    reads) run from a few driver threads at once: they are independent small jobs. All views are
    counted in one job.
    """
    for name in sources:
        check_view_name(name)

    loaded = _load_all(list(sources.items()), required, threads)
    found = {name: df for name, df, _ in loaded if df is not None}
    counts = _row_counts(found) if with_counts else {}
    rows = [_register(spark, name, df, detail) for name, df, detail in loaded]
    report = spark.createDataFrame(rows, REPORT)
    if not with_counts:
        return report
    counted = [(*row, counts.get(row[0])) for row in rows]
    return spark.createDataFrame(counted, f"{REPORT}, n_rows bigint")


def run_registered(spark: SparkSession, statement: str, sources: Mapping[str, Loader],
                   own: str | None = None, threads: int = 8) -> tuple[DataFrame, DataFrame]:
    """The result of a SQL statement, and the report of ``sources`` (all of them optional).

    Only the sources that the statement's parsed plan names are opened, whether in a join, a common table
    expression or a subquery; a common table expression's own name may open a source of that name too.
    The others are reported as ``not named`` and have no view. A named source that is not there fails
    the statement. A source whose name a catalog table also has stands before that table. ``own`` is a
    view that is registered already and stands before a source of its name.
    """
    names = {check_view_name(name).lower(): name for name in sources if not own or name.lower() != own.lower()}
    for name in names.values():
        spark.catalog.dropTempView(name)
    named = [names[key] for key in sorted(names.keys() & _relations(spark, statement))]
    rows = [_register(spark, *loaded) for loaded in _load_all([(n, sources[n]) for n in named], False, threads)]
    rows += [(name, "not named", None, None) for name in sources if name not in named]
    return run_sql(spark, statement), spark.createDataFrame(rows, REPORT)


def _relations(spark: SparkSession, statement: str) -> set[str]:
    """The one-part names of the relations that the parsed, unresolved plan of a statement reads."""
    shown = run_sql(spark, f"EXPLAIN EXTENDED {statement_text(statement)}").first()[0]
    parsed = shown.split("== Analyzed Logical Plan ==")[0]
    return {name.strip().lower() for name in re.findall(r"UnresolvedRelation \[([^\]]*)\]", parsed)}


def _load_all(items: list[tuple[str, Loader]], required: bool, threads: int) -> list[tuple]:
    if len(items) < 2:
        return [_load(*item, required) for item in items]
    with ThreadPoolExecutor(max_workers=min(threads, len(items))) as pool:
        return list(pool.map(lambda item: _load(*item, required), items))


def _load(name: str, loader: Loader, required: bool) -> tuple[str, DataFrame | None, str | None]:
    try:
        return name, loader(), None
    except FileNotFoundError as exc:
        if required:
            raise
        return name, None, str(exc)
    except AnalysisException as exc:
        if required or exc.getCondition() not in NOT_THERE:
            raise
        return name, None, exc.getCondition()


def _register(spark: SparkSession, name: str, df: DataFrame | None, detail: str | None) -> tuple:
    if df is None:
        spark.catalog.dropTempView(name)
        return name, "missing", None, detail
    df.createOrReplaceTempView(name)
    return name, "registered", len(df.columns), None


def _row_counts(views: Mapping[str, DataFrame]) -> dict[str, int]:
    """Rows per view: one job over a tagged union that reads no column."""
    tagged = None
    for name, df in views.items():
        rows = df.select(F.lit(name).alias("name"))
        tagged = rows if tagged is None else tagged.union(rows)
    if tagged is None:
        return {}
    # One row per view.
    found = {r["name"]: r["n"] for r in tagged.groupBy("name").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {name: found.get(name, 0) for name in views}
