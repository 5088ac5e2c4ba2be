"""Sharding of very many groups, one of which holds a third of all bytes."""

from itertools import accumulate

import pytest
from llm.conftest import local
from pyspark.sql import functions as F

from quayside.llm import sharding


@pytest.mark.parametrize("share", [0, 3])
def test_sixty_thousand_groups(spark, share):
    n = 60_000
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.format_string("text of %d with some more", "id").alias("text")
    )
    if share:
        size = docs.agg(F.sum(F.length("text"))).first()[0] // (share - 1)
        big = spark.range(1).select(F.lit(-1).cast("long").alias("doc_id"), F.expr(f"repeat('x', {size})").alias("text"))
        docs = docs.unionByName(big)
    found = local(sharding.shard(docs))
    assert len(found) == n + bool(share)
    total, largest = sum(r["size"] for r in found), max(r["size"] for r in found)
    loads = [sum(r["size"] for r in found if r["shard"] == s) for s in range(16)]
    assert sorted({r["shard"] for r in found}) == list(range(16))
    assert not share or max(loads) == largest
    even = [load for load in loads if load != largest or not share]
    # On either side of a large group a whole number of shards shares what lies there.
    assert max(even) - min(even) < (0.1 * min(even) if share else 0.02 * total / 16)
    for s in range(16):
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(sum(r["shard"] == s for r in found)))


def test_the_capacity_is_the_smallest(spark):
    docs = spark.range(70_000).select((F.col("id") * F.lit(7919)).alias("key"), (F.col("id") % 50 + 1).alias("bytes"))
    keys = docs.select(F.xxhash64("key").alias("key"), "bytes")
    cuts = sharding.minimax_cuts(keys, 16, max_cells=256)
    rows = sorted((r["key"], r["bytes"]) for r in local(keys))
    edges = [0, *accumulate(size for _, size in rows)]
    starts = [0, *(next(i for i, (k, _) in enumerate(rows) if k >= cut) for cut in cuts), len(rows)]
    worst = max(edges[b] - edges[a] for a, b in zip(starts, starts[1:], strict=False))
    low = -(-edges[-1] // 16)
    assert worst == sharding.smallest_capacity(edges, 16, low, edges[-1])
