"""Running outcome totals per bulk job, kept up to date as outcome files land.

The original load loop added each result file's success, error and unprocessed counts to running
totals. Here the routed outcome table (``object=../outcome=../`` Parquet folders) is a file
stream; a stateful streaming aggregation keeps ``records`` per (object, job, outcome) in Spark's
state store (checkpointed in the shared folder, so it survives executor loss and restarts), and
every micro-batch publishes the current totals as a run folder of its own: a failed batch leaves the
totals before it in place, and a retried one replaces only its own folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ferry.sinks.publish import publish_snapshot


def start_outcome_totals_stream(spark: SparkSession, landing: str, schema: StructType, totals_path: str,
                                checkpoint: str, max_files_per_trigger: int | None = None,
                                available_now: bool = True) -> StreamingQuery:
    """``schema`` is the outcome row schema including the ``object`` and ``outcome`` partition
    columns (a file stream needs it up front); totals are published below ``totals_path``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = reader.parquet(landing)
    totals = rows.groupBy("object", "job_id", "outcome").agg(F.count(F.lit(1)).alias("records"))

    def publish(batch: DataFrame, epoch_id: int) -> None:
        publish_snapshot(batch, totals_path, f"batch_{epoch_id:09d}")

    writer = (totals.writeStream.outputMode("complete").foreachBatch(publish)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
