from collections import Counter

import pytest

from ferry.llm.sharding import CELL_BITS, RingParams, _cell, ring, shard_rows
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, odd_docs


def plain_walk(spark, df, params):
    """Place the rows one by one: first everyone at home by ring order, then the overflow clockwise."""
    nodes = [(r.cell, r.shard) for r in ring(spark, params).orderBy("node").collect()]
    rows = df.select("doc_id", F.xxhash64(F.lit("row"), "doc_id", "text").alias("h")).withColumn("cell", _cell(F.col("h"))).collect()

    def home(cell):
        return next((i for i, (c, _) in enumerate(nodes) if c >= cell), 0)

    def place(r):
        cell = r.cell if r.cell <= nodes[-1][0] else r.cell - (1 << CELL_BITS)
        return (home(r.cell), cell, r.h, r.doc_id)

    rows = sorted(rows, key=place)
    n = len(rows)
    room = [n // params.shards + (s < n % params.shards) for s in range(params.shards)]
    shard_of, queue = {}, {}
    for r in rows:
        node = home(r.cell)
        shard = nodes[node][1]
        if room[shard]:
            room[shard] -= 1
            shard_of[r.doc_id] = shard
        else:
            queue.setdefault(node, []).append(r.doc_id)
    waiting = []
    for lap in range(2):
        for node, (_, shard) in enumerate(nodes):
            if lap == 0:
                waiting += queue.get(node, [])
            while waiting and room[shard]:
                room[shard] -= 1
                shard_of[waiting.pop(0)] = shard
    assert not waiting
    return shard_of


@pytest.mark.parametrize("shards, vnodes, n", [(5, 3, 137), (7, 2, 20), (40, 64, 500), (3, 1, 2), (1, 1, 9)])
def test_against_a_walk_row_by_row(spark, shards, vnodes, n):
    params = RingParams(shards, vnodes)
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    got = shard_rows(df, params).collect()
    assert {r.doc_id: r.shard for r in got} == plain_walk(spark, df, params)
    by = Counter(r.shard for r in got)
    counts = [by.get(s, 0) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == n
    assert sorted((r.shard, r.slot) for r in got) == [(s, k) for s in range(shards) for k in range(counts[s])]


def test_one_more_shard_moves_few_rows(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    before, after = ({r.doc_id: r.shard for r in shard_rows(df, RingParams(k, 64)).collect()} for k in (20, 21))
    moved = sum(before[d] != after[d] for d in before)
    assert moved < 0.5 * len(before)            # dealing anew by a modulus would move 95 %


def test_odd_rows(spark):
    rows = odd_docs() + [(5, "tie", "en", "a", 0)] * 30
    df = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", shard int")
    got = shard_rows(df, RingParams(4, 8)).collect()
    assert len(got) == len(rows)
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert len({(r.shard, r.slot) for r in got}) == len(rows)
    sizes = sorted(r.size for r in got)
    assert sizes == sorted(16 + len((r[1] or "").encode()) for r in rows)


def test_empty_table(spark):
    assert shard_rows(spark.createDataFrame([], DOCS)).count() == 0


def test_parameters_are_bounded():
    with pytest.raises(ValueError):
        RingParams(0)
    with pytest.raises(ValueError):
        RingParams(1 << 12, 1 << 8)
