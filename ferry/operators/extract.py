"""Metadata-driven and fixed-list extracts, re-aimed from remote queries to DataFrame projections.

Field metadata is a small DataFrame ``(name, type, compoundFieldName)`` (one row per field of an
object). Only the field *names* reach the driver, to build the projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.constants import COMPOUND_FIELDS_TO_SKIP, UNSUPPORTED_FIELD_TYPES


def metadata_from_schema(spark: SparkSession, df: DataFrame, compound: dict[str, str] | None = None,
                         types: dict[str, str] | None = None) -> DataFrame:
    """Field metadata of a DataFrame's schema, ``(position, name, type, compoundFieldName)``.

    ``types`` overrides the reported type of a field; ``compound`` names the compound parent of a
    field. Driver-side: the schema is metadata, bounded by the number of columns.
    """
    compound = compound or {}
    types = types or {}
    rows = [(i, f.name, types.get(f.name, f.dataType.simpleString()), compound.get(f.name))
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(
        rows, "position int, name string, type string, compoundFieldName string")


def exportable_fields(metadata: DataFrame, name_col: str = "name", type_col: str = "type",
                      compound_col: str = "compoundFieldName",
                      skip_names: Sequence[str] = COMPOUND_FIELDS_TO_SKIP,
                      skip_types: Sequence[str] = UNSUPPORTED_FIELD_TYPES) -> DataFrame:
    """Fields a bulk extract can select: name not a skipped compound, no compound parent, and a
    type (compared lower-cased) that is not unsupported."""
    lowered = [t.lower() for t in skip_types]
    compound = F.col(compound_col)
    return metadata.where(
        ~F.col(name_col).isin(list(skip_names))
        & (compound.isNull() | (compound == ""))
        & ~F.lower(F.col(type_col)).isin(lowered))


def field_names(fields: DataFrame, name_col: str = "name", order_col: str | None = "position") -> list[str]:
    """Collect the field names (metadata only) in declaration order."""
    ordered = fields.orderBy(order_col) if order_col and order_col in fields.columns else fields
    return [r[0] for r in ordered.select(name_col).collect()]


def align_to_fields(df: DataFrame, fields: Sequence[str], fill: str | None = "") -> DataFrame:
    """Project ``df`` onto ``fields`` in that order; a field the data lacks is filled with ``fill``.

    Names resolve case-insensitively, as the session does.
    """
    by_lower = {c.lower(): c for c in df.columns}
    cols: list[Column] = []
    for f in fields:
        src = by_lower.get(f.lower())
        cols.append(F.col(f"`{src}`").alias(f) if src is not None
                    else F.lit(fill).cast("string").alias(f))
    return df.select(*cols)


def filtered_extract(df: DataFrame, fields: Sequence[str], condition: str | Column | None = None,
                     fill: str | None = "") -> DataFrame:
    """``SELECT fields FROM df [WHERE condition]``; a blank condition means no filter.

    The condition is Spark SQL: a remote ``x = null`` is written ``x IS NULL`` here.
    """
    if isinstance(condition, str):
        condition = condition.strip() or None
    filtered = df if condition is None else df.where(condition)
    return align_to_fields(filtered, fields, fill)
