"""SQL transforms kept as text, one statement per object.

Spark's own parser skips ``--`` comments (including one at the end of a line) and leaves ``--``
inside string literals alone, so the text goes to ``spark.sql`` as written; deleting comment
lines by hand would also delete lines inside multi-line literals. Only trailing semicolons and
blank space at the ends are removed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_VIEW_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def statement_text(text: str) -> str:
    body = text.strip()
    while body.endswith(";"):
        body = body[:-1].rstrip()
    return body


def read_sql_text(spark: SparkSession, path: str) -> str:
    """Whole text of a SQL file, read through Spark so that any Hadoop file system works."""
    rows = spark.read.text(path, wholetext=True).collect()
    if len(rows) != 1:
        raise FileNotFoundError(f"expected one SQL file at {path}, found {len(rows)}")
    return rows[0][0]


def sql_path(root: str, object_name: str) -> str:
    """``{root}/{object}.sql`` with the object name lower-cased."""
    return f"{root.rstrip('/')}/{object_name.lower()}.sql"


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    return spark.sql(statement_text(text))


def check_view_name(name: str) -> str:
    """A view name must be a plain identifier (Spark refuses e.g. a hyphen)."""
    if not _VIEW_NAME.match(name):
        raise ValueError(f"not a valid view name: {name!r}")
    return name
