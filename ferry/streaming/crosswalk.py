"""Grow the id crosswalk as success-outcome files land, with Structured Streaming.

The original load job looped over result files one at a time and appended each file's crosswalk
rows next to the earlier ones. Here the landing folder is a file stream: Spark tracks which files
were consumed (in the checkpoint), every micro-batch joins its outcomes with the raw object and
writes its crosswalk rows as run folder ``run_id=batch_<n>``. A retried micro-batch overwrites
its own folder with the same rows, so the result is exactly-once. ``trigger(availableNow=True)``
processes what has landed and stops, which suits a scheduled job; a long-running stream is the
same code with a processing-time trigger.

The raw object is a static DataFrame; each micro-batch joins against it (a stream-static join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ferry.operators.reconcile import id_crosswalk
from ferry.sources.csv import QUOTED_DIALECT


def outcome_schema(columns=("Migration_Id__c", "sf__Id")) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def start_crosswalk_stream(spark: SparkSession, landing: str, raw: DataFrame, crosswalk_root: str,
                           checkpoint: str, schema: StructType | None = None,
                           max_files_per_trigger: int | None = None, source_key: str = "Id",
                           success_key: str = "Migration_Id__c", target_col: str = "sf__Id",
                           available_now: bool = True) -> StreamingQuery:
    reader = spark.readStream.schema(schema or outcome_schema((success_key, target_col))).options(**QUOTED_DIALECT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    outcomes = reader.csv(landing)
    root = crosswalk_root.rstrip("/")

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        rows = id_crosswalk(raw, batch, source_key, success_key, target_col)
        rows.write.mode("overwrite").parquet(f"{root}/run_id=batch_{epoch_id:09d}")

    writer = outcomes.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
