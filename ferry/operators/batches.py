"""Split rows into load batches of a fixed size, in key order, without a one-partition window.

A global ``row_number()`` moves every row into one task. Instead:

1. range-partition on the order keys plus a deterministic tie-break (a hot key value is split
   over several ranges, because the tie-break takes part in the range bounds) and sort inside
   each range. In the same task, each row gets its range index and its position inside the range
   (``monotonically_increasing_id`` counts rows within a task), and the rows are written as a
   Parquet table below the shared checkpoint folder. The written table fixes, for every later
   action and every retry, which row sits where; two independent evaluations of a range exchange
   could draw different bounds, so nothing downstream re-evaluates it.
2. count rows per range from that table (only the range column is read) and cumulate the counts:
   a table of at most ``num_ranges`` rows, whatever the input,
3. join that table on the range: global position = offset of the range + position inside the
   range; batch = position div batch_size.

The order is total (keys, then a hash of the whole row; equal rows are interchangeable), so a
retried task writes the same positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ferry.constants import BULK_BATCH_SIZE
from ferry.session import scratch_path

_LOW_BITS = (1 << 33) - 1


def assign_batches(df: DataFrame, order_cols: Sequence[str], batch_size: int = BULK_BATCH_SIZE,
                   num_ranges: int | None = None, batch_col: str = "batch_id",
                   position_col: str | None = None, work_path: str | None = None) -> DataFrame:
    """Add ``batch_col`` (0-based batch of ``batch_size`` rows in order of ``order_cols``) and
    optionally ``position_col`` (1-based position). ``work_path`` is where the ranged rows are
    written (default: a fresh folder below the session's checkpoint folder)."""
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    spark = df.sparkSession
    if num_ranges is None:
        num_ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = list(df.columns)
    quoted = [F.col(f"`{c}`") for c in cols]
    tie = F.xxhash64(*quoted).alias("__ferry_tie")
    order = [F.col(f"`{c}`") for c in order_cols] + [F.col("__ferry_tie")]
    mid = F.monotonically_increasing_id()
    ranged = (df.select("*", tie)
              .repartitionByRange(num_ranges, *order)
              .sortWithinPartitions(*order)
              .select(*quoted, F.spark_partition_id().alias("__ferry_range"),
                      mid.bitwiseAND(F.lit(_LOW_BITS)).alias("__ferry_local")))
    path = work_path or scratch_path(spark, "batches")
    ranged.write.mode("overwrite").parquet(path)
    written = spark.read.parquet(path)

    # One row per range: the window sees num_ranges rows, and the broadcast has that bound.
    before = Window.orderBy("__ferry_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (written.groupBy("__ferry_range").agg(F.count(F.lit(1)).alias("n"))
               .select("__ferry_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__ferry_offset")))
    pos = (F.col("__ferry_offset") + F.col("__ferry_local")).alias("__ferry_pos")
    numbered = written.join(F.broadcast(offsets), "__ferry_range").select(*quoted, pos)
    extra = [F.expr(f"__ferry_pos div {int(batch_size)}").cast("long").alias(batch_col)]
    if position_col:
        extra.append((F.col("__ferry_pos") + F.lit(1)).cast("long").alias(position_col))
    return numbered.select(*quoted, *extra)
