"""Split documents into shards of near-equal bytes that keep equal texts together.

Groups of equal texts, in the order of their text hash, are cut into contiguous runs so that
the largest run is as small as any such cut allows. The smallest feasible capacity is found by
binary search, each candidate checked greedily. Of the cuts that respect it near-equal ones are
taken: a group larger than its share gets a shard to itself and the rest is spread evenly over
the others, each shard ending as near to its share of what is left as it can. The check needs running sums, so it works on
cells: ranges of the hash with their bytes. 65,536 cells bound what the driver holds; only
cells in which a cut can fall are refined, by one more aggregate each time, until those hold a
single group each. The answer is then that of the groups themselves.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from functools import reduce
from heapq import nlargest
from itertools import accumulate, pairwise

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.tables import whole_text, written
from quayside.session import small_frame

MAX_CELLS = 65_536
KEY_BITS = 64


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row.

    A null text has 0 bytes, so size 1, and goes with the empty texts. Repeated rows stay
    separate rows with their own slots. With fewer groups than shards the last shards stay
    empty. An empty table gives an empty result. A null id is kept as null. Slots are numbered
    in blocks of about the square root of a shard's rows, spread by row, so that no window
    holds a shard, however often one text occurs.
    """
    text = whole_text(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
    ).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "shard-rows")
    groups = written(
        rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "shard-groups"
    )
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    number = sum((F.when(F.col("key") >= cut, 1).otherwise(0) for cut in minimax_cuts(groups, shards)), F.lit(0))
    blocks = max(1, math.isqrt(total // shards))
    placed = rows.withColumn("shard", number.cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("row"), F.lit(blocks))
    )
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "block")
        .agg(F.count("*").alias("n"))
        .select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    in_block = Window.partitionBy("shard", "block").orderBy("row")
    return (
        placed.withColumn("place", F.row_number().over(in_block) - 1)
        .join(offsets, ["shard", "block"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("offset") + F.col("place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def minimax_cuts(groups: DataFrame, shards: int, max_cells: int = MAX_CELLS) -> list[int]:
    """The keys at which shards after the first begin, for a frame of key and bytes.

    Fewer than shards - 1 keys mean that the last shards are empty.
    """
    facts = groups.agg(F.sum("bytes"), F.max("bytes")).first()
    if facts[0] is None:
        return []
    total, low = facts[0], max(facts[1], -(-facts[0] // shards))
    bits = max(1, int(math.log2(max_cells)))
    cells = _cells(groups, bits)
    while True:
        edges = [0, *accumulate(cell[2] for cell in cells)]
        high = smallest_capacity(edges, shards, low, total)
        open_cells = [
            i
            for i in _between(edges, shards, low, high)
            if cells[i][3] > 1 and cells[i][1] < KEY_BITS
        ]
        if not open_cells:
            return [cells[i][0] for i in even_cuts(edges, shards, high)]
        depth = max(cells[i][1] for i in open_cells) + 1
        while depth < KEY_BITS and sum(2 ** (depth + 1 - cells[i][1]) for i in open_cells) <= max_cells:
            depth += 1
        again = set(open_cells)
        finer = _cells(_within(groups, [cells[i] for i in open_cells]), depth)
        cells = sorted([cell for i, cell in enumerate(cells) if i not in again] + finer)


def _cells(groups: DataFrame, bits: int) -> list[tuple[int, int, int, int]]:
    """First key, bits, bytes and groups of each range of keys with equal leading bits."""
    shift = KEY_BITS - bits
    sums = groups.groupBy(F.shiftright("key", shift).alias("cell")).agg(F.sum("bytes"), F.count("*"))
    return sorted((cell << shift, bits, size, n) for cell, size, n in sums.collect())


def _within(groups: DataFrame, cells: list[tuple]) -> DataFrame:
    """The groups whose key lies in one of the cells, by one lookup for each depth there is.

    However many cells are open, the plan stays small: they are rows, no conditions. They are
    at most as many as the driver holds, so they go to all tasks.
    """
    open_at: dict[int, list[int]] = {}
    for first, bits, *_ in cells:
        open_at.setdefault(bits, []).append(first >> (KEY_BITS - bits))
    found = []
    for bits, numbers in sorted(open_at.items()):
        wanted = small_frame(groups.sparkSession, [(n,) for n in numbers], "cell long")
        numbered = groups.withColumn("cell", F.shiftright("key", KEY_BITS - bits))
        found.append(numbered.join(F.broadcast(wanted), "cell", "left_semi").drop("cell"))
    # Cells of different depths do not overlap, so no group comes twice.
    return reduce(DataFrame.unionByName, found)


def greedy_cuts(edges: list[int], shards: int, capacity: int) -> list[int] | None:
    """Filling each shard as far as it goes: where the next ones begin, or None if too many."""
    cuts, at, last = [], 0, len(edges) - 1
    for _ in range(shards):
        at = bisect_right(edges, edges[at] + capacity) - 1
        if at >= last:
            return cuts
        if cuts and at == cuts[-1] or at == 0:
            return None
        cuts.append(at)
    return None


def even_cuts(edges: list[int], shards: int, capacity: int) -> list[int]:
    """Where shards after the first begin, near-equal and within a capacity that suffices."""
    last = len(edges) - 1
    shards = min(shards, last)
    if shards <= 1:
        return []
    sizes = [b - a for a, b in pairwise(edges)]
    big = max(range(last), key=sizes.__getitem__)
    if sizes[big] * shards > edges[-1] - edges[0]:
        before, after = edges[: big + 1], edges[big + 1 :]
        # How many shards come before the large group; no side gets more than it has cells.
        splits = []
        for k in range(max(0, shards - last + big), min(shards - 1, big) + 1):
            sides = ((before, k), (after, shards - 1 - k))
            if max(_least(*side) for side in sides) <= capacity:
                splits.append((max(_level(*side) for side in sides), k))
        if splits:
            first = min(splits)[1]
            own = [big] if big else []
            beyond = [big + 1] if big + 1 < last else []
            return [
                *even_cuts(before, first, capacity),
                *own,
                *beyond,
                *(big + 1 + i for i in even_cuts(after, shards - 1 - first, capacity)),
            ]
    # From which cell on the rest fits into 1, 2, … shards.
    fits = [last]
    for _ in range(shards - 1):
        fits.append(bisect_left(edges, edges[fits[-1]] - capacity))
    cuts, at = [], 0
    for left in range(shards - 1, 0, -1):
        aim = edges[at] + (edges[-1] - edges[at]) / (left + 1)
        near = bisect_left(edges, aim)
        if near and aim - edges[near - 1] < edges[near] - aim:
            near -= 1
        farthest = min(bisect_right(edges, edges[at] + capacity) - 1, last - left)
        at = min(max(near, fits[left], at + 1), farthest)
        cuts.append(at)
    return cuts


def _level(edges: list[int], shards: int) -> float:
    """The share of each shard that holds no group larger than that."""
    total = edges[-1] - edges[0]
    for size in nlargest(shards, (b - a for a, b in pairwise(edges))):
        if size * shards <= total:
            break
        total, shards = total - size, shards - 1
    return total / shards if shards else 0


def _least(edges: list[int], shards: int) -> float:
    """The smallest capacity for so many shards; none suffices if there are cells but no shards."""
    if len(edges) < 2:
        return 0
    total = edges[-1] - edges[0]
    if not shards:
        return math.inf
    low = max(-(-total // shards), max(b - a for a, b in pairwise(edges)))
    return smallest_capacity(edges, shards, low, total)


def smallest_capacity(edges: list[int], shards: int, low: int, high: int) -> int:
    while low < high:
        middle = (low + high) // 2
        if greedy_cuts(edges, shards, middle) is None:
            low = middle + 1
        else:
            high = middle
    return low


def _between(edges: list[int], shards: int, low: int, high: int) -> list[int]:
    """Cells in which a cut can fall for some capacity from low to high."""
    found: set[int] = set()
    start = 0
    for k in range(1, shards):
        start = bisect_right(edges, edges[start] + low) - 1
        stop = min(bisect_right(edges, k * high), len(edges) - 1)
        found.update(range(start, stop))
    return sorted(found)
