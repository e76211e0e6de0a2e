"""Document manifests: which contracts qualify, which files belong to them, what to name them,
which new parent each file goes to, and the payload rows for the upload.

The original jobs issued one remote query per document or file (N+1 lookups). Here every lookup
is one join; "first record" picks are grouped ``min`` aggregates (deterministic, map-side
combined) instead of windows, so a parent with a third of all documents does not become one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date, datetime, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DateType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from ferry.constants import (
    ATTACHMENT_CONTENT_TYPE,
    ELIGIBLE_ACCOUNT_STATUSES,
    ELIGIBLE_CREATED_ON_OR_BEFORE,
)
from ferry.operators.salting import reduce_apart
from ferry.session import scratch_path
from ferry.sources.binary import open_file
from ferry.functions.text import (
    base64_unbroken,
    keyed_file_name,
    keyed_name_key,
    keyed_name_rest,
    path_safe,
    strip_extension,
)


def on_or_before_day(df: DataFrame, col_name: str, day: str | date) -> Column:
    """``day_of(col) <= day`` written as a range on the raw column, so parquet can push it down."""
    d = date.fromisoformat(day) if isinstance(day, str) else day
    dtype = df.schema[col_name].dataType
    if isinstance(dtype, DateType):
        return F.col(col_name) <= F.lit(d)
    nxt = datetime.combine(d + timedelta(days=1), datetime.min.time())
    if isinstance(dtype, (TimestampNTZType, TimestampType)):
        bound = F.lit(nxt.isoformat(sep=" ")).cast(dtype.simpleString())
        return F.col(col_name) < bound
    # Text: a value that is no date matches nothing; ``unreadable_dates`` lists such rows.
    return F.expr(f"try_to_timestamp(`{col_name}`)").cast("date") <= F.lit(d)


def unreadable_dates(df: DataFrame, col_name: str) -> DataFrame:
    """Rows whose text date is present but cannot be read (they never pass a day cut-off)."""
    c = F.col(col_name)
    return df.where(c.isNotNull() & (F.trim(c) != "") & F.expr(f"try_to_timestamp(`{col_name}`)").isNull())


def _flag(df: DataFrame, col_name: str) -> Column:
    """A boolean column as a predicate; text flags (as read from CSV) are true when they read
    ``true`` in any case, with blanks around them ignored."""
    if isinstance(df.schema[col_name].dataType, BooleanType):
        return F.col(col_name)
    return F.lower(F.trim(F.col(col_name).cast("string"))) == F.lit("true")


def eligible_contracts(contracts: DataFrame, accounts: DataFrame, account_link_col: str,
                       account_id_col: str, account_status_col: str, created_col: str,
                       statuses: Sequence[str] = ELIGIBLE_ACCOUNT_STATUSES,
                       created_on_or_before: str | date = ELIGIBLE_CREATED_ON_OR_BEFORE) -> DataFrame:
    """Contracts whose parent account has one of ``statuses`` and that were created on or before
    the given day. The account filter runs before the join; the day filter reaches the scan."""
    ok_accounts = (accounts.where(F.col(account_status_col).isin(list(statuses)))
                   .select(F.col(account_id_col).alias("__ferry_account")))
    dated = contracts.where(on_or_before_day(contracts, created_col, created_on_or_before))
    return dated.join(ok_accounts, dated[account_link_col] == ok_accounts["__ferry_account"], "left_semi")


def linked_to(children: DataFrame, parents: DataFrame, child_link_col: str,
              parent_id_col: str) -> DataFrame:
    """Children whose link points at one of ``parents`` (an IN-subquery as a semi-join)."""
    ids = parents.select(F.col(parent_id_col).alias("__ferry_parent")).where(
        F.col("__ferry_parent").isNotNull())
    return children.join(ids, children[child_link_col] == ids["__ferry_parent"], "left_semi")


def latest_version_manifest(links: DataFrame, versions: DataFrame, link_entity_col: str = "LinkedEntityId",
                            link_document_col: str = "ContentDocumentId", version_id_col: str = "Id",
                            version_document_col: str = "ContentDocumentId", title_col: str = "Title",
                            extension_col: str = "FileExtension", latest_col: str | None = "IsLatest") -> DataFrame:
    """One row per link that has a current version:
    ``linked_entity_id, content_document_id, version_id, title, file_extension, file_name, status``.

    The current version of a document is the lowest version id among those flagged latest (the
    original took the first record of an unordered answer). Links without one are left out.
    ``status`` is ``failed`` when the title is null (the original failed on such a title) and
    ``ready`` otherwise.
    """
    v = versions if latest_col is None else versions.where(_flag(versions, latest_col))
    named = v.select(F.col(version_document_col).alias("content_document_id"), F.col(version_id_col).alias("version_id"),
                     F.col(title_col).alias("title"), F.col(extension_col).alias("file_extension"))
    current = reduce_apart(named, ["content_document_id"],
                           F.min(F.struct("version_id", "title", "file_extension")).alias("v"))
    ln = links.select(F.col(link_entity_col).alias("linked_entity_id"),
                      F.col(link_document_col).alias("__ferry_doc"))
    m = ln.join(current, ln["__ferry_doc"] == current["content_document_id"], "inner")
    safe_title = path_safe(strip_extension(F.col("v.title")))
    return m.select(
        "linked_entity_id", "content_document_id",
        F.col("v.version_id").alias("version_id"), F.col("v.title").alias("title"),
        F.col("v.file_extension").alias("file_extension"),
        F.when(F.col("v.title").isNotNull(),
               keyed_file_name(F.col("linked_entity_id"), safe_title, F.col("v.file_extension")))
        .alias("file_name"),
        F.when(F.col("v.title").isNull(), F.lit("failed")).otherwise(F.lit("ready")).alias("status"))


def attachment_manifest(attachments: DataFrame, id_col: str = "Id", parent_col: str = "ParentId",
                        name_col: str = "Name") -> DataFrame:
    """``attachment_id, parent_id, name, file_name`` with ``file_name = parent_safe-name``."""
    return attachments.select(
        F.col(id_col).alias("attachment_id"), F.col(parent_col).alias("parent_id"),
        F.col(name_col).alias("name"),
        keyed_file_name(F.col(parent_col), path_safe(F.col(name_col))).alias("file_name"),
        F.when(F.col(name_col).isNull(), F.lit("failed")).otherwise(F.lit("ready")).alias("status"))


def name_collisions(manifest: DataFrame, name_col: str = "file_name") -> DataFrame:
    """File names that more than one row would write (the later download overwrites the earlier)."""
    return (manifest.where(F.col(name_col).isNotNull()).groupBy(name_col)
            .agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1))


def attachment_parent_lookup(files: DataFrame, parents: DataFrame, name_col: str = "file_name",
                             parent_key_col: str = "Migration_Id__c",
                             parent_id_col: str = "Id", keep_cols: Sequence[str] = ()) -> DataFrame:
    """Parse ``{key}_{name}`` file names and find the new parent whose migration id is the key.

    Output: ``file_name, migration_id, name, parent_id, status`` (+ ``keep_cols``); ``status`` is
    ``no_parent`` when no parent carries the key. Parents sharing a key resolve to the lowest id.
    """
    parsed = files.select(
        F.col(name_col).alias("file_name"),
        keyed_name_key(F.col(name_col)).alias("migration_id"),
        keyed_name_rest(F.col(name_col)).alias("name"),
        *[F.col(c) for c in keep_cols])
    keyed = parents.select(F.col(parent_key_col).alias("__ferry_key"), F.col(parent_id_col).alias("parent_id"))
    unique = reduce_apart(keyed.where(F.col("__ferry_key").isNotNull()), ["__ferry_key"],
                          F.min("parent_id").alias("parent_id"))
    out = parsed.join(unique, parsed["migration_id"] == unique["__ferry_key"], "left").drop("__ferry_key")
    return out.withColumn(
        "status", F.when(F.col("parent_id").isNull(), F.lit("no_parent")).otherwise(F.lit("ready")))


def attachment_payload(looked_up: DataFrame, content_col: str = "content",
                       content_type: str = ATTACHMENT_CONTENT_TYPE) -> DataFrame:
    """Upload rows ``Name, ParentId, Body, ContentType`` for files with a parent; the body is
    unbroken base64 of the file bytes (a string column is encoded as UTF-8 first)."""
    ready = looked_up.where(F.col("status") == "ready")
    content = F.col(content_col)
    if dict(ready.dtypes)[content_col] == "string":
        content = F.encode(content, "UTF-8")
    return ready.select(F.col("name").alias("Name"), F.col("parent_id").alias("ParentId"),
                        base64_unbroken(content).alias("Body"),
                        F.lit(content_type).alias("ContentType"))


#: Bytes of bodies that a task reads, and what opening a file counts besides its length.
TASK_BYTES, OPEN_BYTES = 64 << 20, 64 << 10
#: Bytes of small bodies that leave a task together.
BATCH_BYTES = 4 << 20


def dealt_by_bytes(rows: DataFrame, length_col: str = "length", task_bytes: int = TASK_BYTES) -> DataFrame:
    """The rows in bundles, an array per column: each stands for files of about ``task_bytes``, and each is a
    task's own.

    Rows that name files weigh a hundred bytes, whatever the files weigh: dealt out by their own size,
    millions of bodies would be one task's. Tasks pack their rows into bundles as they stream by; the bundles
    are written (a retry reads the same ones) and dealt out one by one.
    """
    schema = StructType([StructField(f.name, ArrayType(f.dataType)) for f in rows.schema.fields])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bundle(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            columns = [pa.concat_arrays([b.column(i) for b in held]) for i in range(held[0].num_columns)]
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns], schema.names)

        held, size = [], 0
        for batch in batches:
            begin = 0
            for k, length in enumerate(batch.column(length_col).to_pylist()):
                size += OPEN_BYTES + (length or 0)
                if size >= task_bytes:
                    yield bundle([*held, batch.slice(begin, k + 1 - begin)])
                    held, size, begin = [], 0, k + 1
            if begin < len(batch):
                held.append(batch.slice(begin))
        if held:
            yield bundle(held)

    path = scratch_path(rows.sparkSession, "bundles")
    rows.mapInArrow(pack, schema).write.parquet(path)
    bundles = rows.sparkSession.read.parquet(path)
    return bundles.repartition(max(1, bundles.count()))


def attach_bodies(looked_up: DataFrame, path_col: str = "path", length_col: str = "length",
                  task_bytes: int = TASK_BYTES) -> DataFrame:
    """``looked_up`` rows that are ready, with the bytes of their file as ``content``.

    The bodies are read where they are used, by path, after the parent join: no file body goes
    through a shuffle or a sort, and files without a parent are not read. Files are dealt out to tasks
    by their bytes.
    """
    ready = looked_up.where(F.col("status") == "ready")
    schema = StructType([*ready.schema.fields, StructField("content", BinaryType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                columns = [c.slice(k, 1).flatten() for c in batch.columns]
                bodies, size, begin = [], 0, 0
                for i, path in enumerate(columns[batch.schema.get_field_index(path_col)].to_pylist(), 1):
                    with open_file(path) as f:
                        bodies.append(f.read())
                    size += len(bodies[-1])
                    if size >= BATCH_BYTES or i == len(columns[0]):
                        yield pa.RecordBatch.from_arrays(
                            [*(c.slice(begin, len(bodies)) for c in columns), pa.array(bodies, pa.binary())], schema.names)
                        bodies, size, begin = [], 0, i

    return dealt_by_bytes(ready, length_col, task_bytes).mapInArrow(read, schema)


def transfer_summary(manifest: DataFrame, status_col: str = "status") -> DataFrame:
    """Row counts per status (``ready``/``failed``/``no_parent``)."""
    return manifest.groupBy(F.col(status_col).alias("status")).agg(F.count(F.lit(1)).alias("count"))
