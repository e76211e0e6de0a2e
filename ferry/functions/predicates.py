"""Presence tests used to split matched from unmatched rows.

``present`` and ``absent`` are exact complements: a value is absent when it is null or the empty
string. A blank (``' '``) is present.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: str | Column) -> Column:
    v = _col(c)
    return v.isNotNull() & (v != F.lit(""))


def absent(c: str | Column) -> Column:
    v = _col(c)
    return v.isNull() | (v == F.lit(""))
