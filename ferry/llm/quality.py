"""Quality rules: robust multivariate outliers by minimum covariance determinant (MCD).

``text_stats`` counts the base statistics of every whole text. ``mcd_verdict`` transforms them into
four features, estimates a robust centre and scatter per (lang, source), and rejects rows whose
squared Mahalanobis distance passes a chi-square quantile. Everything is SQL functions.

Method. Features are fixed-point integers (1/1000), so sums over any number of rows are exact and a
run repeats bit for bit however the rows are spread. The start is the coordinate-wise median and
the mean squared deviation of the central rows; each concentration step then keeps the ``support``
share of rows nearest to the centre and re-estimates mean and covariance from them, which lowers
the covariance determinant; a last step re-estimates from all rows within the 97.5 % quantile.
Quantiles come from exact percentiles over binned values, whose aggregation state is bounded by
the number of bins. A ridge (``floors``) keeps the scatter of constant features invertible.

Every step also estimates each language as a whole and all rows together; a (lang, source) with
fewer than ``min_rows`` rows uses its language, and a small language uses all rows. Below
``min_rows`` rows in total nothing is an outlier. Groups are aggregated with map-side combining, so
a source with a third of all rows is no hot task.

Edge cases. A null text has no words and fails the base rule. Null lang or source are groups of
their own. Repeated rows count and are judged each by itself. Extra columns pass through, save those
named as a result; ``quality_filter`` keeps all columns. An empty table gives an empty result. Two different 8-word windows of one text count as equal only if their
64-bit hashes collide.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import SPACES, space_words, written

SYMBOLS = "#*$%&|<>"
WINDOW = 8
FEATURES = ("f1", "f2", "f3", "f4")
SCALE = 1000


def _chi4_cdf(x: float) -> float:
    return 1 - math.exp(-x / 2) * (1 + x / 2)


def _chi6_cdf(x: float) -> float:
    return 1 - math.exp(-x / 2) * (1 + x / 2 + x * x / 8)


def chi4_quantile(p: float) -> float:
    """Quantile of the chi-square distribution with four degrees of freedom, by bisection."""
    low, high = 0.0, 200.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi4_cdf(mid) < p else (low, mid)
    return (low + high) / 2


@dataclass(frozen=True)
class McdParams:
    support: float = 0.75          # share of rows that a concentration step keeps
    steps: int = 3                 # concentration steps
    reject: float = 0.999          # chi-square quantile beyond which a row is rejected
    reweight: float = 0.975        # quantile of the last re-estimation
    min_rows: int = 100            # fewer rows in a group: the coarser level is used
    floors: tuple[float, ...] = (0.05, 0.05, 0.10, 0.10)   # least standard deviation by feature


#: Names of the results and of columns on the way; input columns of these names are left out.
RESULTS = {"n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "d2", "kept",
           "__t", "__w", "__h", "__s", "__p", "__l", "__lang", "__source", "__e", "__e0", "__e1", "__e2",
           *(f"q_{x}" for x in FEATURES), *(f"y_{x}" for x in FEATURES), *(f"m_{x}" for x in FEATURES),
           *(f"l_{a}_{b}" for a in FEATURES for b in FEATURES)}


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, plus n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    rest = [c for c in docs.columns if c != text and c.lower() not in RESULTS]
    t = F.coalesce(F.col(text), F.lit(""))
    # Lambdas that look at other elements need their arrays as columns of an earlier projection;
    # each of these columns is used more than once later, so the optimizer keeps them apart.
    words = docs.select(*rest, t.alias("__t"), space_words(F.col(text)).alias("__w"))
    hashed = words.select(
        *rest, "__t", F.size("__w").cast("long").alias("n_words"),
        F.when(F.size("__w") >= WINDOW, F.transform(
            F.sequence(F.lit(1), F.greatest(F.size("__w") - (WINDOW - 1), F.lit(1))),
            lambda i: F.xxhash64(F.slice("__w", i, WINDOW)))).otherwise(F.array().cast("array<bigint>")).alias("__h"))
    # Most texts repeat no window; only those that do pay for the sort.
    repeated = F.size(F.array_distinct("__h")) < F.size("__h")
    sorted_windows = hashed.select(
        *rest, "__t", "n_words",
        F.when(repeated, F.sort_array(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
               ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("__s"))

    def twice(s: Column, k: Column) -> Column:
        return F.coalesce(s["h"] == F.get("__s", k - 1)["h"], F.lit(False)) | \
            F.coalesce(s["h"] == F.get("__s", k + 1)["h"], F.lit(False))

    starts = sorted_windows.select(
        *rest, "__t", "n_words",
        F.sort_array(F.transform(F.filter("__s", twice), lambda s: s["i"])).alias("__p"))
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    with_lines = starts.select(*rest, "__t", "n_words", "__p", lines.alias("__l"))
    # A repeated window covers the words up to the next repeated window's start, 8 at most.
    covered = F.aggregate(
        F.transform("__p", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("__p", k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return with_lines.select(
        *rest, "n_words",
        F.length(F.translate("__t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("__t") - F.length(F.translate("__t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


# The transformed statistics. Pseudo-counts pull short texts, whose rates are noisy, to the middle.
FEATURE_SQL = {
    "f1": "ln((word_chars + 250) / (n_words + 50))",
    "f2": "sqrt(n_symbols / (word_chars + 1))",
    "f3": "n_dup_lines / (n_lines + 5)",
    "f4": "n_repeat_words / (n_words + 20)",
}


def feature_sql(name: str) -> str:
    return f"CAST(floor({FEATURE_SQL[name]} * {SCALE} + 0.5) AS BIGINT)"


PAIRS = tuple((a, b) for i, a in enumerate(FEATURES) for b in FEATURES[:i + 1])


def scatter_sql(floors: tuple[float, ...], factor: float) -> list[tuple[str, str]]:
    """Ordered (column, SQL) steps from sums (n, s_x, s_x_y) to means and the Cholesky factor.

    The covariance gets the consistency ``factor`` and the squared floors on its diagonal.
    """
    steps = [(f"m_{x}", f"CAST(s_{x} AS DOUBLE) / n / {SCALE}e0") for x in FEATURES]
    for a, b in PAIRS:
        ridge = f" + {floors[FEATURES.index(a)] ** 2!r}e0" if a == b else ""
        steps.append((f"c_{a}_{b}", f"(CAST(s_{a}_{b} AS DOUBLE) / n / {SCALE * SCALE}e0 - m_{a} * m_{b}) * {factor!r}e0{ridge}"))
    for i, a in enumerate(FEATURES):
        for j, b in enumerate(FEATURES[:i + 1]):
            inner = "".join(f" - l_{a}_{k} * l_{b}_{k}" for k in FEATURES[:j])
            steps.append((f"l_{a}_{b}", f"sqrt(c_{a}_{a}{inner})" if a == b else f"(c_{a}_{b}{inner}) / l_{b}_{b}"))
    return steps


def distance_sql() -> list[tuple[str, str]]:
    """Ordered (column, SQL) steps of the squared distance d2 = |L^-1 (x - m)|^2."""
    steps = []
    for i, a in enumerate(FEATURES):
        inner = "".join(f" - l_{a}_{k} * y_{k}" for k in FEATURES[:i])
        steps.append((f"y_{a}", f"(q_{a} / {SCALE}e0 - m_{a}{inner}) / l_{a}_{a}"))
    steps.append(("d2", " + ".join(f"y_{a} * y_{a}" for a in FEATURES)))
    return steps


#: Squared distances in 64 bins per power of two: the percentile's state is a bounded table.
BIN_SQL = "CAST(floor(64 * log2(d2 + 0.0001)) AS BIGINT)"


def _with(df: DataFrame, steps: list[tuple[str, str]]) -> DataFrame:
    """Add the steps in order; a step may use the columns of steps before it."""
    return df.selectExpr("*", *[f"{sql} AS {name}" for name, sql in steps])


def _sums(df: DataFrame) -> DataFrame:
    wide = "decimal(38,0)"
    return df.groupBy("level", "g_lang", "g_source").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(f"q_{x}").cast(wide)).alias(f"s_{x}") for x in FEATURES],
        *[F.sum((F.col(f"q_{a}") * F.col(f"q_{b}")).cast(wide)).alias(f"s_{a}_{b}") for a, b in PAIRS])


GROUP = ["level", "g_lang", "g_source"]


def _by_group(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on the group columns, nulls being equal; the group columns of ``left`` stay."""
    on = F.lit(True)
    for k in GROUP:
        on = on & F.col(k).eqNullSafe(F.col(f"r_{k}"))
    return left.join(right.withColumnsRenamed({k: f"r_{k}" for k in GROUP}), on).drop(*[f"r_{k}" for k in GROUP])


def _distances(rows: DataFrame, params: DataFrame) -> DataFrame:
    return _with(_by_group(rows, params), distance_sql()).select(*GROUP, *[f"q_{x}" for x in FEATURES], "d2")


def mcd_params(stats: DataFrame, params: McdParams = McdParams()) -> DataFrame:
    """One row per group and level: n_group, means m_*, Cholesky factor l_*.

    ``stats`` holds lang, source and the base statistics. It is read once per step, so pass a
    written table. The parameter tables are checkpointed: their lineage stays short, and a lost
    executor costs no earlier step.
    """
    rows = stats.where(~base_failed()).select(
        F.explode(F.array(
            F.struct(F.lit(0).alias("level"), F.col("lang").alias("g_lang"), F.col("source").alias("g_source")),
            F.struct(F.lit(1).alias("level"), F.col("lang").alias("g_lang"), F.lit(None).cast("string").alias("g_source")),
            F.struct(F.lit(2).alias("level"), F.lit(None).cast("string").alias("g_lang"),
                     F.lit(None).cast("string").alias("g_source")))).alias("g"),
        *[F.expr(feature_sql(x)).alias(f"q_{x}") for x in FEATURES]).select("g.*", *[f"q_{x}" for x in FEATURES])

    spread = params.support
    factor = spread / _chi6_cdf(chi4_quantile(spread))
    # Start: medians, and for each feature the spread of the rows around them, no correlation.
    median = rows.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n_group"),
        *[F.expr(f"percentile(q_{x}, 0.5) / {SCALE}e0").alias(f"m_{x}") for x in FEATURES],
        *[F.expr(f"greatest((percentile(q_{x}, 0.75) - percentile(q_{x}, 0.25)) / {SCALE}e0 / 1.349, {floor!r}e0)"
                 ).alias(f"l_{x}_{x}") for x, floor in zip(FEATURES, params.floors)])
    est = _with(median, [(f"l_{a}_{b}", "CAST(0 AS DOUBLE)") for a, b in PAIRS if a != b]).checkpoint()
    sizes = est.select(*GROUP, "n_group")
    for step in range(params.steps + 1):
        d = _distances(rows, est).withColumn("bin", F.expr(BIN_SQL))
        if step < params.steps:
            cut = d.groupBy(*GROUP).agg(F.expr(f"percentile(bin, {spread!r})").alias("cut"))
            near = _by_group(d, cut).where(F.col("bin") <= F.col("cut"))
            used = factor
        else:
            near = d.where(F.col("d2") <= chi4_quantile(params.reweight))
            used = params.reweight / _chi6_cdf(chi4_quantile(params.reweight))
        est = _with(_by_group(sizes, _sums(near)), scatter_sql(params.floors, used)) \
            .select(*GROUP, "n_group", *[f"m_{x}" for x in FEATURES], *[f"l_{a}_{b}" for a, b in PAIRS]).checkpoint()
    return est


#: A parameter row is 14 doubles and two short strings; so many rows stay below about 20 MB.
BROADCAST_GROUPS = 100_000


def mcd_verdict(stats: DataFrame, params: McdParams = McdParams()) -> DataFrame:
    """``stats`` plus base_failed, d2 (squared robust distance, null without an estimate) and kept.

    ``stats`` is read several times: pass a written table (``quality_stats``).
    """
    est = mcd_params(stats, params).where(F.col("n_group") >= params.min_rows)
    cols = [f"m_{x}" for x in FEATURES] + [f"l_{a}_{b}" for a, b in PAIRS]
    # Beyond the checked size the parameters are joined by a shuffle, whose skew Spark splits.
    hint = F.broadcast if est.count() <= BROADCAST_GROUPS else (lambda df: df)
    rows = stats.withColumns({f"q_{x}": F.expr(feature_sql(x)) for x in FEATURES})
    for level, keys in enumerate((("lang", "source"), ("lang",))):
        side = est.where(F.col("level") == level).select(
            F.col("g_lang").alias("__lang"), F.col("g_source").alias("__source"), F.struct(*cols).alias(f"__e{level}"))
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
        rows = rows.join(hint(side), on, "left").drop("__lang", "__source")
    # The coarsest level has one row at most, whatever the input.
    rows = rows.withColumn("__e2", est.where(F.col("level") == 2).agg(F.first(F.struct(*cols))).scalar())
    rows = rows.withColumn("__e", F.coalesce("__e0", "__e1", "__e2"))
    judged = _with(rows.withColumns({c: F.col(f"__e.{c}") for c in cols}), distance_sql())
    near = F.coalesce(F.col("d2") <= chi4_quantile(params.reject), F.lit(True))
    return judged.withColumn("base_failed", base_failed()) \
        .withColumn("kept", ~F.col("base_failed") & near).select(*stats.columns, "base_failed", "d2", "kept")


def quality_stats(docs: DataFrame) -> DataFrame:
    """The base statistics of every row, written to the shared scratch folder once.

    Each concentration step reads a few columns of that table again.
    """
    return written(text_stats(docs), "quality-stats")


def quality_filter(docs: DataFrame, params: McdParams = McdParams()) -> DataFrame:
    """The rows of ``docs`` (text, lang, source, ...) that the quality rules keep, columns unchanged.

    The rows are written along with their statistics, so the filter needs no join to get them back and
    reads finished columns (a filter pushed below the statistics would compute them many times).
    """
    rows = docs.select("text", "lang", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    return mcd_verdict(quality_stats(rows), params).where("kept").select("__row.*")
