"""Text scrubbing, file-name and stamp helpers. All are JVM built-ins (whole-stage codegen)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ferry.constants import LINE_BREAK_CHARS, LINE_BREAK_REPLACEMENT, RUN_ID_FORMAT


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scrub_line_breaks(df: DataFrame, chars: str = LINE_BREAK_CHARS,
                      replacement: str = LINE_BREAK_REPLACEMENT) -> DataFrame:
    """Replace every line-break character of every string column with ``replacement``.

    One projection for all columns: each of ``\\n`` and ``\\r`` becomes one blank, so CRLF gives
    two blanks. Non-string columns pass through unchanged.
    """
    if len(replacement) != 1:
        return df.select([
            F.regexp_replace(F.col(f"`{f.name}`"), "[" + chars + "]", replacement).alias(f.name)
            if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ])
    to = replacement * len(chars)
    return df.select([
        F.translate(F.col(f"`{f.name}`"), chars, to).alias(f.name)
        if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def strip_extension(title: str | Column) -> Column:
    """Drop a final ``.xyz`` / ``.wxyz`` (word characters, Unicode-aware; ``$`` also before a
    final line feed, and only a line feed), then outer white space."""
    no_ext = F.regexp_replace(_col(title), r"(?dU)\.\w{3,4}$", "")
    return F.regexp_replace(no_ext, r"(?U)^\s+|\s+$", "")


def path_safe(name: str | Column) -> Column:
    """``/`` and ``\\`` become ``_``."""
    return F.translate(_col(name), "/\\", "__")


def keyed_file_name(parent: str | Column, name: str | Column, ext: str | Column | None = None) -> Column:
    """``{parent}_{name}`` plus ``.{ext}`` when the extension is neither null nor empty."""
    base = F.concat(_col(parent).cast("string"), F.lit("_"), _col(name))
    if ext is None:
        return base
    e = _col(ext)
    return F.concat(base, F.when(e.isNotNull() & (e != ""), F.concat(F.lit("."), e)).otherwise(F.lit("")))


def keyed_name_key(file_name: str | Column) -> Column:
    """Text before the first ``_`` (the whole name when there is none)."""
    return F.substring_index(_col(file_name), "_", 1)


def keyed_name_rest(file_name: str | Column) -> Column:
    """Text after the first ``_``; ``''`` when there is none."""
    n = _col(file_name)
    pos = F.instr(n, "_")
    return F.when(pos > 0, n.substr(pos + 1, F.length(n))).otherwise(F.lit(""))


def base64_unbroken(content: str | Column) -> Column:
    """Base64 text without line breaks, whatever ``spark.sql.chunkBase64String.enabled`` says."""
    return F.translate(F.base64(_col(content)), "\r\n", "")


def utc_millis_stamp(run_ts: datetime) -> str:
    """``YYYY-MM-DDTHH:MM:SS.mmmZ`` of an instant; naive datetimes are taken as UTC."""
    ts = run_ts if run_ts.tzinfo else run_ts.replace(tzinfo=timezone.utc)
    ts = ts.astimezone(timezone.utc)
    return ts.strftime("%Y-%m-%dT%H:%M:%S.") + f"{ts.microsecond // 1000:03d}Z"


def run_id(run_ts: datetime) -> str:
    """Folder-safe run identifier ``YYYYMMDD_HHMMSS``."""
    return run_ts.strftime(RUN_ID_FORMAT)


def iso_millis(ts: str | Column) -> Column:
    """Format a timestamp column as ``yyyy-MM-dd'T'HH:mm:ss.SSS'Z'``.

    ``timestamp_ntz`` values are written as they are; ``timestamp`` values are written in the
    session time zone, which the session builder pins to UTC.
    """
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def file_name_of(path: str | Column) -> Column:
    """Last path element."""
    return F.regexp_extract(_col(path), r"([^/]*)$", 1)
