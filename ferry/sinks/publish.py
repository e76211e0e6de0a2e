"""Writers: CSV dialects, run-versioned snapshots, routed outcomes, and an accumulating crosswalk.

Publishing never deletes or overwrites the folder it may be reading: each run writes its own
``run_id=<id>`` folder. Only runs with a success marker count; "current" is the last of them in
natural order of their ids (``r9`` before ``r10``) and "previous" the one before it. A run is written as a
draft, without the marker; its rows are counted during the write, and it is committed by the marker or,
if it is to be skipped when empty, discarded: the DataFrame is evaluated once. A failed write
therefore leaves the previous current in place, and re-running a run id (a retried job) replaces
only that run's own folder, so a retry is idempotent. A run is read from its own folder, so runs
with different columns do not mix. Files are not forced into one: a single output file
(``single_file=True``) costs one task for the final stage; it uses a shuffle (``repartition(1)``)
so that the upstream work keeps its parallelism, unlike ``coalesce(1)``.

CSV is an export format here: it drops outer white space and turns ``''`` into null, so no job
computes on a CSV it has just written.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ferry.operators.reconcile import accumulate_crosswalk
from ferry.session import scratch_path
from ferry.sources.csv import QUOTED_DIALECT
from ferry.sources.listing import child_folders, create_empty, exists, remove_folder

_RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", quote_all: bool = False,
              single_file: bool = False, **options) -> None:
    """CSV in the quoted dialect. ``quote_all`` quotes every value (null and ``''`` both become
    ``""``)."""
    opts = {k: v for k, v in QUOTED_DIALECT.items() if k != "multiLine"}
    if quote_all:
        opts.update({"quoteAll": "true", "encoding": "UTF-8", "lineSep": "\n"})
    opts.update({k: str(v) for k, v in options.items()})
    out = df.repartition(1) if single_file else df
    out.write.mode(mode).options(**opts).csv(path)


def check_run_id(run_id: str) -> str:
    if not _RUN_ID.fullmatch(run_id):
        raise ValueError(f"not a valid run id: {run_id!r}")
    return run_id


def run_order(run_id: str) -> list:
    """Sort key: runs of digits compare as numbers, then the id itself (``7`` before ``007``)."""
    return [[(p.isdigit(), int(p) if p.isdigit() else 0, p) for p in re.split(r"(\d+)", run_id) if p], run_id]


def publish_snapshot(df: DataFrame, root: str, run_id: str, fmt: str = "parquet",
                     single_file: bool = False, skip_if_empty: bool = False,
                     partition_by: tuple[str, ...] = ()) -> str | None:
    """Write ``df`` as run ``run_id`` below ``root`` (replacing only that run's folder if a
    retried job wrote it before). With ``skip_if_empty`` a run without rows is discarded and
    ``None`` returned."""
    rows = publish_counted(df, root, run_id, fmt, single_file, skip_if_empty, partition_by)
    return run_path(root, run_id) if rows or not skip_if_empty else None


def publish_counted(df: DataFrame, root: str, run_id: str, fmt: str = "parquet", single_file: bool = False,
                    skip_if_empty: bool = True, partition_by: tuple[str, ...] = ()) -> int:
    """Publish a run and return its row count, taken during the write; one evaluation of ``df``."""
    spark, path = df.sparkSession, run_path(root, check_run_id(run_id))
    draft = Observation(f"published-{uuid.uuid4().hex}")
    out = (df.repartition(1) if single_file else df).observe(draft, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode("overwrite").format(fmt).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.options(**{k: v for k, v in QUOTED_DIALECT.items() if k != "multiLine"})
    writer.save(path)
    rows = draft.get["rows"]
    if rows or not skip_if_empty:
        create_empty(spark, f"{path}/_SUCCESS")
    else:
        remove_folder(spark, path)
    return rows


def run_path(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/run_id={run_id}"


def run_ids(spark: SparkSession, root: str) -> list[str]:
    """Published run ids, oldest first: folders with a success marker. One folder listing, no job."""
    found = [n[len("run_id="):] for n in child_folders(spark, root) if n.startswith("run_id=")]
    done = [r for r in found if exists(spark, f"{run_path(root, r)}/_SUCCESS")]
    return sorted(done, key=run_order)


def pick_run(spark: SparkSession, root: str, which: str = "current") -> str:
    """The run id that ``current``, ``previous`` or an id stands for."""
    ids = run_ids(spark, root)
    if not ids:
        raise FileNotFoundError(f"no published run below {root}")
    if which == "current":
        return ids[-1]
    if which == "previous":
        if len(ids) < 2:
            raise FileNotFoundError(f"no previous run below {root}")
        return ids[-2]
    if which not in ids:
        raise FileNotFoundError(f"no run {which} below {root}")
    return which


def read_run(spark: SparkSession, root: str, which: str = "current", fmt: str = "parquet") -> DataFrame:
    """The ``current`` (latest) or ``previous`` run, or a run id, with its own columns and ``run_id``.

    Only that run's folder is listed and read.
    """
    chosen = pick_run(spark, root, which)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**QUOTED_DIALECT)
    return reader.load(run_path(root, chosen)).withColumn("run_id", F.lit(chosen))


def write_outcomes(outcomes: DataFrame, root: str, run_id: str, object_col: str = "object",
                   outcome_col: str = "outcome", fmt: str = "parquet") -> str:
    """Route outcome rows to ``{root}/run_id=../object=../outcome=../`` in one job (all three
    outcomes, unprocessed included). Earlier runs stay as history."""
    return publish_snapshot(outcomes, root, run_id, fmt, partition_by=(object_col, outcome_col))


def read_outcomes(spark: SparkSession, root: str, objects: list[str] | None = None,
                  object_col: str = "object", fmt: str = "parquet") -> DataFrame:
    """Each object's outcomes of its last run (all its outcomes replace those of the run before).

    Which run an object was last part of is told by folder names; only those folders are read.
    """
    last: dict[str, str] = {}
    for run in run_ids(spark, root):
        for name in child_folders(spark, run_path(root, run)):
            if name.startswith(f"{object_col}="):
                last[name] = run
    if objects is not None:
        wanted = {f"{object_col}={o}" for o in objects}
        last = {name: run for name, run in last.items() if name in wanted}
    if not last:
        raise FileNotFoundError(f"no published outcomes below {root}")
    out: DataFrame | None = None
    for name, run in sorted(last.items()):
        # The object is taken from the folder name as it is: an object "007" stays text.
        part = spark.read.format(fmt).load(f"{run_path(root, run)}/{name}").withColumns({
            object_col: F.lit(unquote(name[len(object_col) + 1:])), "run_id": F.lit(run)})
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


#: Buckets of a new crosswalk, and how many versions a bucket collects before it is written as one again.
CROSSWALK_BUCKETS, BUCKET_VERSIONS = 64, 16


def _bucket_paths(root: str, entries: Iterable[Row]) -> list[str]:
    return [f"{root.rstrip('/')}/data/{e['version']}/bucket={e['bucket']}" for e in entries]


def _read_buckets(spark: SparkSession, root: str, entries: Sequence[Row]) -> DataFrame | None:
    return spark.read.option("mergeSchema", "true").parquet(*_bucket_paths(root, entries)) if entries else None


def _manifest(spark: SparkSession, root: str, run_id: str) -> list[Row] | None:
    """``buckets, bucket, version`` of a run, at most ``BUCKET_VERSIONS`` a bucket; None for a run folder of plain rows."""
    df = spark.read.parquet(run_path(root, run_id))
    return df.collect() if df.columns == ["buckets", "bucket", "version"] else None


def append_crosswalk(crosswalk: DataFrame, root: str, run_id: str, buckets: int = CROSSWALK_BUCKETS) -> str:
    """Grow a published crosswalk by the rows of one run that it does not hold yet, each distinct row once.

    The crosswalk is kept in hash buckets of the source id; a run's folder holds a manifest of the bucket
    versions that make up the crosswalk. A run reads the buckets its rows fall into and writes their new rows as
    one version more, so what it writes grows with the run, not with all history; a bucket with many
    versions is written as one. Data comes before the manifest, under a name of its own: a failed run leaves the
    crosswalk as it was.
    """
    spark = crosswalk.sparkSession
    earlier = [r for r in run_ids(spark, root) if run_order(r) < run_order(check_run_id(run_id))]
    manifest = _manifest(spark, root, earlier[-1]) if earlier else []
    if manifest is None:                                       # written before there were buckets
        crosswalk = accumulate_crosswalk(spark.read.parquet(run_path(root, earlier[-1])), crosswalk)
        manifest = []
    buckets = manifest[0]["buckets"] if manifest else buckets
    scratch = scratch_path(spark, "crosswalk-run")
    crosswalk.withColumn("__ferry_bucket", F.pmod(F.xxhash64("source_id"), F.lit(buckets)).cast("int")).write.parquet(scratch)
    new = spark.read.parquet(scratch).distinct()
    touched = {r[0] for r in new.select("__ferry_bucket").distinct().collect()}
    versions = Counter(e["bucket"] for e in manifest)
    full = {b for b in touched if versions[b] >= BUCKET_VERSIONS}
    old = _read_buckets(spark, root, [e for e in manifest if e["bucket"] in touched - full])
    if old is not None:
        known = old.select(*[F.col(f"`{c}`").alias(f"__old_{c}") for c in old.columns])
        same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`__old_{c}`")) if c in old.columns else F.col(f"`{c}`").isNull()
                for c in crosswalk.columns] + [F.col(f"`__old_{c}`").isNull() for c in old.columns if c not in crosswalk.columns]
        new = new.join(known, reduce(lambda a, b: a & b, same), "left_anti")
    merged = _read_buckets(spark, root, [e for e in manifest if e["bucket"] in full])
    if merged is not None:
        merged = merged.withColumn("__ferry_bucket", F.pmod(F.xxhash64("source_id"), F.lit(buckets)).cast("int"))
        new = new.unionByName(merged, allowMissingColumns=True).distinct()
    version = f"{run_id}-{uuid.uuid4().hex[:8]}"
    folder = f"{root.rstrip('/')}/data/{version}"
    new.withColumnRenamed("__ferry_bucket", "bucket").hint("rebalance", "bucket").write.partitionBy("bucket").parquet(folder)
    grown = [int(name[len("bucket="):]) for name in child_folders(spark, folder)]
    entries = [(buckets, e["bucket"], e["version"]) for e in manifest if e["bucket"] not in full] + [(buckets, b, version) for b in grown]
    listed = spark.createDataFrame(entries, "buckets int, bucket int, version string").coalesce(1)
    return publish_snapshot(listed, root, run_id)


def read_crosswalk(spark: SparkSession, root: str) -> DataFrame:
    """The current crosswalk, one row per distinct ``(source_id, migration_id, target_id)``: its manifest's buckets."""
    run = pick_run(spark, root)
    manifest = _manifest(spark, root, run)
    if manifest is None:
        return spark.read.parquet(run_path(root, run))
    rows = _read_buckets(spark, root, manifest)
    return rows if rows is not None else spark.createDataFrame([], "source_id string, migration_id string, target_id string")


def read_crosswalk_runs(spark: SparkSession, root: str) -> DataFrame:
    """The distinct rows of all runs, for run folders that hold increments (the stream's)."""
    paths = [run_path(root, r) for r in run_ids(spark, root)]
    if not paths:
        raise FileNotFoundError(f"no published run below {root}")
    return spark.read.parquet(*paths).distinct()
