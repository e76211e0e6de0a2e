"""Command-line entry for the migration jobs: ``python -m ferry.cli <job> ...``.

Inputs are CSV folders in the quoted dialect (read recursively, columns matched by header, all text)
unless a path ends in ``.parquet``; a root of run folders stands for its current run. Outputs are
published as run folders (``run_id=...``) below ``--out``, so a re-run never deletes the previous
result, and a run without rows publishes nothing. Every job prints one JSON line of row counts taken
during the writes.

Jobs: ``transform``, ``after-load``, ``match-users``, ``remap-owners``, ``headers``,
``manifest``, ``attachments``, ``batches``, ``reconcile``.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from ferry.functions.text import run_id as make_run_id
from ferry.operators.batches import assign_batches
from ferry.operators.reconcile import outcome_by_job, run_reconciliation
from ferry.operators.stamp import stamp_load_time
from ferry.plans.jobs import (
    publish_after_load,
    publish_attachment_uploads,
    publish_counted,
    crosswalk_sources,
    document_manifest,
    match_users,
    publish_owner_remap,
    publish_transform,
    publish_user_match,
    remap_owners,
    staged,
    transform_object,
)
from ferry.session import build_session, scale_conf
from ferry.sinks.publish import pick_run, read_outcomes, run_ids, run_path
from ferry.sources.binary import read_files
from ferry.sources.csv import union_by_header
from ferry.sources.headers import header_catalog
from ferry.sources.listing import first_file_below
from ferry.sources.sqltext import read_sql_text, sql_path


def _read(spark: SparkSession, path: str, year: str | None = None) -> DataFrame:
    """A Parquet table, the current run of a published root, or CSV files matched by header."""
    if year:
        path = f"{path.rstrip('/')}/year={year}"
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if run_ids(spark, path):
        path = run_path(path, pick_run(spark, path))
        if first_file_below(spark, path, "*.parquet"):
            return spark.read.parquet(path)
    return union_by_header(spark, path)


def _outcomes(spark: SparkSession, path: str) -> DataFrame:
    """The last run of every object, or a plain Parquet table."""
    return read_outcomes(spark, path) if run_ids(spark, path) else spark.read.parquet(path)


def _pairs(values: list[str] | None) -> dict[str, str]:
    out = {}
    for v in values or []:
        name, _, path = v.partition("=")
        if not path:
            raise SystemExit(f"expected name=path, got {v!r}")
        out[name] = path
    return out


def run(args: argparse.Namespace, spark: SparkSession) -> dict:
    rid = args.run_id or make_run_id(datetime.now(timezone.utc))
    out = args.out.rstrip("/")
    counts: dict = {"job": args.job, "run_id": rid}
    if getattr(args, "object", None):
        args.object = args.object.lower()
    fmt = args.format
    if args.job == "transform":
        text = read_sql_text(spark, args.sql if args.sql.endswith(".sql") else sql_path(args.sql, args.object))
        lookups = {n: (lambda p=p: _read(spark, p)) for n, p in _pairs(args.lookup).items()}
        optional = (crosswalk_sources(spark, args.crosswalk_root, args.year, fmt=args.crosswalk_format)
                    if args.crosswalk_root else {})
        tr = transform_object(spark, args.object, text, _read(spark, args.raw, args.year),
                              lookups=lookups, optional=optional, only_named=args.only_named,
                              orphan_check={"auto": None, "yes": True, "no": False}[args.orphan_check])
        counts.update(publish_transform(tr, out, args.object, rid, fmt, partition_year=args.year))
        counts["sources"] = {r.name: r.status for r in tr.sources.collect()}
    elif args.job == "after-load":
        counts.update(publish_after_load(_read(spark, args.raw), _read(spark, args.success), out, args.object, rid, fmt))
    elif args.job == "match-users":
        parts = match_users(_read(spark, args.legacy), _read(spark, args.target))
        counts.update(publish_user_match(parts["matched"], out, rid, fmt))
    elif args.job == "remap-owners":
        parts = remap_owners(_read(spark, args.source), _read(spark, args.users), salt_buckets=args.salt)
        counts.update(publish_owner_remap(parts["remapped"], out, args.object, rid, fmt))
    elif args.job == "headers":
        counts["columns"] = publish_counted(header_catalog(spark, args.root), f"{out}/headers", rid, fmt)
    elif args.job == "manifest":
        m = document_manifest(_read(spark, args.contracts), _read(spark, args.accounts),
                              _read(spark, args.links), _read(spark, args.versions))
        counts["documents"] = publish_counted(staged(m, "manifest"), f"{out}/manifest", rid, fmt)
    elif args.job == "attachments":
        files = read_files(spark, args.files, with_content=False).select("path", "length", "file_name")
        counts.update(publish_attachment_uploads(files, _read(spark, args.parents), out, rid))
    elif args.job == "batches":
        rows = _read(spark, args.input)
        if args.object:
            run_ts = datetime.fromisoformat(args.run_ts) if args.run_ts else datetime.now(timezone.utc)
            rows = stamp_load_time(rows, args.object, run_ts)
        counts["rows"] = publish_counted(assign_batches(rows, args.order_by, args.size), f"{out}/batches", rid, fmt)
    elif args.job == "reconcile":
        outcomes = _outcomes(spark, args.outcomes)
        counts["totals"] = run_reconciliation(_read(spark, args.input), outcomes).first().asDict()
        counts["job_outcome_rows"] = publish_counted(outcome_by_job(outcomes), f"{out}/outcome_by_job", rid, fmt)
    return counts


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ferry")
    sub = p.add_subparsers(dest="job", required=True)

    def job(name: str, *required: str) -> argparse.ArgumentParser:
        j = sub.add_parser(name)
        j.add_argument("--out", required=True)
        j.add_argument("--run-id")
        j.add_argument("--format", default="csv", choices=["csv", "parquet"])
        j.add_argument("--input-bytes", type=int, help="size of the input; with --cores, sizes partitions")
        j.add_argument("--cores", type=int, help="executor cores of the cluster")
        for r in required:
            j.add_argument(f"--{r}", required=True)
        return j

    t = job("transform", "object", "sql", "raw")
    t.add_argument("--lookup", action="append", help="view=path, repeatable")
    t.add_argument("--crosswalk-root", help="folder of earlier crosswalks, one sub-folder per object")
    t.add_argument("--only-named", action="store_true", help="open only those earlier crosswalks that the SQL names")
    t.add_argument("--crosswalk-format", default="parquet", choices=["parquet", "csv"])
    t.add_argument("--year")
    t.add_argument("--orphan-check", default="auto", choices=["auto", "yes", "no"],
                   help="auto: as the object's step config says")
    job("after-load", "object", "raw", "success")
    job("match-users", "legacy", "target")
    r = job("remap-owners", "object", "source", "users")
    r.add_argument("--salt", type=int, default=0)
    job("headers", "root")
    job("manifest", "contracts", "accounts", "links", "versions")
    job("attachments", "files", "parents")
    b = job("batches", "input")
    b.add_argument("--order-by", nargs="+", required=True)
    b.add_argument("--size", type=int, default=20000)
    b.add_argument("--object", help="stamp the load time when the object takes a stamp")
    b.add_argument("--run-ts", help="ISO instant of the load (default: now, UTC)")
    job("reconcile", "input", "outcomes")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    sized = scale_conf(args.input_bytes, args.cores) if args.input_bytes and args.cores else None
    spark = spark or build_session(app_name=f"ferry-{args.job}", extra=sized)
    counts = run(args, spark)
    print(json.dumps(counts, default=str))
    return counts


if __name__ == "__main__":
    main(sys.argv[1:])
