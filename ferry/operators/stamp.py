"""Load-time stamp: one UTC instant per run, appended as a column to the objects that take it.

The original stamped text lines of the file, which broke records holding a line break; as a
column the stamp is record-based. The run time is a parameter (no clock inside the operator), so a
re-run of a task writes the same value.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.constants import STAMPED_OBJECTS
from ferry.functions.text import utc_millis_stamp


def stamp_load_time(df: DataFrame, object_name: str, run_ts: datetime,
                    column: str = "Migrated_Date__c",
                    objects: Iterable[str] | None = STAMPED_OBJECTS) -> DataFrame:
    """Append ``column`` = ``YYYY-MM-DDTHH:MM:SS.mmmZ`` of ``run_ts`` when the object takes a
    stamp (``objects=None``: every object); other objects pass through unchanged."""
    if objects is not None and object_name.lower() not in {o.lower() for o in objects}:
        return df
    return df.withColumn(column, F.lit(utc_millis_stamp(run_ts)))
