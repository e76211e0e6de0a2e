"""Sharding: a consistent-hash ring with virtual nodes and bounded loads, in SQL functions only.

Every shard owns ``vnodes`` positions of a ring of ``CELLS`` cells. A row hashes to a cell; its home
is the next virtual node clockwise. Shards have capacities that add up to the row count, at most
one apart. Rows that find their home shard full continue clockwise to the next virtual node
whose shard has room, first come, first served in ring order. So balance is exact, and a row leaves
its home only if that shard is full.

How it runs. Rows are counted per cell; the ring walk works on those counts alone, a table whose
size is fixed by the parameters (2^14 cells, shards x vnodes arcs), never by the input. It yields,
for every cell, how many of its rows stay, and, for the stream of overflowing rows in ring order,
the intervals that each shard takes. A row's shard and its gapless slot then follow from its rank in
its cell by arithmetic. The only shuffle of rows carries ids, hashes and sizes by cell, 2^14 small
groups; a group of equal texts spreads over the ring because the hash covers doc_id and text.

Edge cases. Null ids and texts hash like values of their own; equal rows are ranked in any order,
which cannot be told apart. An empty table gives an empty result. Fewer rows than shards leave
shards empty. Extra columns are ignored by ``shard_rows``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ferry.session import scratch_path

CELL_BITS = 14
CELLS = 1 << CELL_BITS


@dataclass(frozen=True)
class RingParams:
    shards: int = 40
    vnodes: int = 64

    def __post_init__(self) -> None:
        if self.shards < 1 or self.vnodes < 1 or self.shards * self.vnodes > CELLS // 4:
            raise ValueError(f"shards x vnodes must lie between 1 and {CELLS // 4}")


def _cell(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - CELL_BITS)


def ring(spark, params: RingParams) -> DataFrame:
    """The virtual nodes in ring order: node 0.., cell, shard."""
    pos = _cell(F.xxhash64(F.lit("vnode"), F.col("shard"), F.col("v")))
    nodes = spark.range(params.shards * params.vnodes).select(
        F.expr(f"CAST(id DIV {params.vnodes} AS INT)").alias("shard"),
        F.expr(f"CAST(id % {params.vnodes} AS INT)").alias("v")).withColumn("cell", pos)
    order = Window.orderBy("cell", "shard", "v")  # shards x vnodes rows, a fixed number
    return nodes.select((F.row_number().over(order) - 1).cast("int").alias("node"), "cell", "shard")


def _count_below(sorted_values: Column, x: Column, or_equal: bool = False) -> Column:
    """How many values of a sorted array lie below ``x``: binary search, arrays of up to 2^18."""
    def step(a: Column, _: Column) -> Column:
        mid = ((a["lo"] + a["hi"]) / 2).cast("int")
        value = F.get(sorted_values, mid)
        below = value <= x if or_equal else value < x
        return F.when(a["lo"] >= a["hi"], a).when(below, F.struct((mid + 1).alias("lo"), a["hi"].alias("hi"))) \
            .otherwise(F.struct(a["lo"].alias("lo"), mid.alias("hi")))

    start = F.struct(F.lit(0).alias("lo"), F.size(sorted_values).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(19)), start, step, lambda a: a["lo"])


def ring_walk(counts: DataFrame, params: RingParams) -> tuple[DataFrame, DataFrame]:
    """Plan the placement from rows per cell (``cell``, ``n``).

    Returns (cells, takes). cells: cell, shard, stay, slot, over: of a cell's rows by rank, the
    first ``stay`` go to ``shard`` from ``slot`` on, the others are the overflow from ordinal
    ``over`` on. takes: first, last, shard, slot: the overflow's ordinals first..last-1 go to
    ``shard`` from ``slot`` on.
    """
    spark = counts.sparkSession
    nodes = ring(spark, params)
    packed = nodes.agg(F.sort_array(F.collect_list(F.struct("node", "cell", "shard"))).alias("ring"))
    # A cell's home is the first node at or after it; behind the last node the ring begins anew.
    homes = counts.withColumn("cells", packed.select(F.transform("ring", lambda r: r["cell"])).scalar()) \
        .withColumn("owners", packed.select(F.transform("ring", lambda r: r["shard"])).scalar()) \
        .withColumn("below", _count_below(F.col("cells"), F.col("cell"))) \
        .withColumn("wrapped", F.col("below") == F.size("cells")) \
        .withColumn("node", F.when(F.col("wrapped"), 0).otherwise(F.col("below"))) \
        .select("cell", "n", "node", "wrapped", F.get("owners", F.col("node")).alias("shard"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    capacity = spark.range(params.shards).select(F.col("id").cast("int").alias("shard")) \
        .withColumn("total", total.scalar()).select(
            "shard", F.expr(f"total DIV {params.shards} + IF(shard < total % {params.shards}, 1, 0)").alias("cap"))

    # First lap: a shard takes the rows at home in its cells in ring order, up to its capacity.
    in_shard = Window.partitionBy("shard").orderBy("node", F.desc("wrapped"), "cell")
    before = F.coalesce(F.sum("n").over(in_shard.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    stays = homes.join(F.broadcast(capacity), "shard").withColumn("slot", before).select(
        "cell", "n", "node", "wrapped", "shard", "cap", "slot",
        F.greatest(F.lit(0), F.least(F.col("n"), F.col("cap") - F.col("slot"))).alias("stay"))
    ring_order = Window.orderBy("node", F.desc("wrapped"), "cell")  # 2^14 rows at most
    left = F.col("n") - F.col("stay")
    cells = stays.withColumn("over", F.coalesce(
        F.sum(left).over(ring_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    # Next laps: what is left walks on. The queue is first in, first out, so only its length counts.
    room = capacity.join(stays.groupBy("shard").agg(F.sum("stay").alias("used")), "shard", "left").select(
        "shard", (F.col("cap") - F.coalesce("used", F.lit(0))).alias("room"))
    rooms = room.agg(F.sort_array(F.collect_list(F.struct("shard", "room"))).alias("r")).select(
        F.transform("r", lambda x: x["room"]).alias("rooms"))
    surplus = nodes.join(cells.groupBy("node").agg(F.sum(left).alias("surplus")), "node", "left").agg(
        F.sort_array(F.collect_list(F.struct("node", "shard", F.coalesce("surplus", F.lit(0)).alias("surplus")))).alias("stops"))

    def stop(state: Column, at: Column) -> Column:
        queue = state["queue"] + at["surplus"]
        free = F.get(state["rooms"], at["shard"])
        take = F.least(queue, free)
        done = F.when(take > 0, F.concat(state["takes"], F.array(F.struct(at["shard"].alias("shard"), take.alias("n")))))
        rest = F.when(take > 0, F.transform(state["rooms"], lambda r, i: F.when(i == at["shard"], r - take).otherwise(r)))
        return F.struct((queue - take).alias("queue"), F.coalesce(rest, state["rooms"]).alias("rooms"),
                        F.coalesce(done, state["takes"]).alias("takes"))

    # Two laps: after one, whoever still waits has passed every shard once since the lap began.
    laps = F.concat("stops", F.transform("stops", lambda s: F.struct(
        s["node"].alias("node"), s["shard"].alias("shard"), F.lit(0).cast("long").alias("surplus"))))
    zero = F.struct(F.lit(0).cast("long").alias("queue"), F.col("rooms").alias("rooms"),
                    F.array().cast("array<struct<shard:int,n:bigint>>").alias("takes"))
    takes = surplus.withColumn("rooms", rooms.scalar()).select(F.posexplode(F.aggregate(laps, zero, stop, lambda s: s["takes"])))
    taken = takes.select("pos", "col.shard", "col.n")
    in_order = Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    of_shard = Window.partitionBy("shard").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    takes = taken.withColumn("first", F.coalesce(F.sum("n").over(in_order), F.lit(0))) \
        .withColumn("earlier", F.coalesce(F.sum("n").over(of_shard), F.lit(0))) \
        .join(room.join(F.broadcast(capacity), "shard"), "shard") \
        .select("first", (F.col("first") + F.col("n")).alias("last"), "shard",
                (F.col("cap") - F.col("room") + F.col("earlier")).alias("slot"))
    return cells.select("cell", "shard", "stay", "slot", "over"), takes


def shard_rows(docs: DataFrame, params: RingParams = RingParams()) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    thin = docs.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit("row"), "doc_id", "text").alias("h"))
    # Written once: the counts and the ranks must come from the same rows, also after a lost executor.
    path = scratch_path(spark, "shard-rows")
    thin.withColumn("cell", _cell(F.col("h"))).write.parquet(path)
    rows = spark.read.parquet(path)
    cells, takes = ring_walk(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")), params)
    # Fixed sizes: 2^14 cells at most, and at most two laps of shards x vnodes takes.
    plan_path, take_path = scratch_path(spark, "shard-cells"), scratch_path(spark, "shard-takes")
    cells.coalesce(1).write.parquet(plan_path)
    takes.coalesce(1).write.parquet(take_path)
    cells, takes = spark.read.parquet(plan_path), spark.read.parquet(take_path)
    sorted_takes = takes.agg(F.sort_array(F.collect_list(F.struct("first", "shard", "slot"))).alias("takes"))

    rank = F.row_number().over(Window.partitionBy("cell").orderBy("h", "doc_id", "text_crc32", "size")) - 1
    placed = rows.withColumn("r", rank).join(F.broadcast(cells), "cell") \
        .withColumn("ordinal", F.when(F.col("r") >= F.col("stay"), F.col("over") + F.col("r") - F.col("stay"))) \
        .withColumn("takes", sorted_takes.scalar())
    # An overflowing row meets its interval by binary search, without a range join.
    firsts = F.transform("takes", lambda t: t["first"])
    t = F.when(F.col("ordinal").isNotNull(), F.get("takes", _count_below(firsts, F.col("ordinal"), True) - 1))
    return placed.withColumn("t", t).select(
        "doc_id", "size", "text_crc32", F.coalesce("t.shard", "shard").alias("shard"),
        F.when(F.col("t").isNull(), F.col("slot") + F.col("r"))
        .otherwise(F.col("t.slot") + F.col("ordinal") - F.col("t.first")).alias("slot"))
