"""Exact top-k by inner product: tiled matrix products and merging of short lists.

Vectors are packed into blocks, blocks are dealt to lanes, and each tile is one lane of
candidates against one lane of queries: a matrix product, of which a query keeps its k + 1
best. The lists of a query then merge sixteen at a time until one is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.tables import written

EXACT = 2**53  # whole numbers up to here are exact as doubles
MOST = 2**63 - 1  # scores beyond a long stop here
BLOCK_ROWS = 4096
LANE_ROWS = 16_384
QUERY_ROWS = 512  # queries in one product
FAN_IN = 16
PACKED = "block long, n int, width int, kind string, ids binary, gone binary, data binary"
LISTS = (
    "query_block long, place int, query_id long, own long, lane long, "
    "top array<struct<minus:bigint,gone:boolean,vec_id:bigint>>"
)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k best rows of `vectors` for each row of `queries`, itself one of them, left out.

    Returns query_id, rank from 1, vec_id and score, the inner product of floor(scale * x) as
    whole numbers. Ties go to the smaller id, null ids last. Vectors that are null, or hold
    null or non-finite components (also once scaled), take no part; an empty vector scores 0.
    Of two lengths the shorter counts as padded with zeros. Scores beyond a long stop at its
    ends. Equal rows are separate candidates, and separate queries with a list each; only the
    query's own row is left out. Fewer candidates give shorter lists, empty tables none.
    """
    shards = written(_packed(vectors, id_col, vector_col, scale), "shards")
    asked = written(_packed(queries, id_col, vector_col, scale), "query-blocks")
    rows = shards.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    query_rows = asked.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    lanes, query_lanes = -(-rows // LANE_ROWS) or 1, -(-query_rows // BLOCK_ROWS) or 1
    lane_of = lambda n: F.pmod(F.xxhash64("block"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = shards.withColumn("lane", lane_of(lanes)).withColumn("query_lane", every(query_lanes))
    right = asked.withColumn("query_lane", lane_of(query_lanes)).withColumn("lane", every(lanes))
    tile = ("lane", "query_lane")
    lists = left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInArrow(_tile(k + 1), LISTS)
    while lanes > 1:
        lanes = -(-lanes // FAN_IN)
        lists = (
            lists.withColumn("lane", F.floor(F.col("lane") / FAN_IN))
            .groupBy("query_block", "place", "query_id", "own", "lane")
            .agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k + 1).alias("top"))
        )
    itself = F.struct(
        (-F.col("own")).alias("minus"), F.lit(False).alias("gone"), F.col("query_id").alias("vec_id")
    ).cast("struct<minus:bigint,gone:boolean,vec_id:bigint>")
    place = F.array_position("top", itself).cast("int")
    others = F.when(
        place > 0, F.concat(F.slice("top", F.lit(1), place - 1), F.slice("top", place + 1, F.lit(k + 1)))
    ).otherwise(F.slice("top", 1, k))
    return lists.select("query_id", F.posexplode(others).alias("place", "entry")).select(
        "query_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("entry.vec_id").alias("vec_id"),
        (-F.col("entry.minus")).alias("score"),
    )


def _packed(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """Blocks of up to BLOCK_ROWS vectors as whole numbers of the narrowest sufficient kind."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                ids, gone, matrix = _whole_numbers(part.column(0), part.column(1), scale)
                if not len(ids):
                    continue
                largest = float(np.abs(matrix).max(initial=0))
                kind = next((t for t in ("int16", "int32") if largest <= np.iinfo(t).max), "float64")
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([block], pa.int64()),
                        "n": pa.array([len(ids)], pa.int32()),
                        "width": pa.array([matrix.shape[1]], pa.int32()),
                        "kind": [kind],
                        "ids": pa.array([ids.tobytes()], pa.binary()),
                        "gone": pa.array([gone.tobytes()], pa.binary()),
                        "data": pa.array([matrix.astype(kind).tobytes()], pa.binary()),
                    }
                )
                block += 1

    columns = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    return columns.mapInArrow(pack, PACKED)


def _whole_numbers(ids: pa.Array, vectors: pa.Array, scale: int):
    """Ids, which of them are null, and floor(scale * x) of the vectors that take part."""
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten()
    if vectors.null_count:
        lengths = np.where(vectors.is_null().to_numpy(False), 0, lengths)
    flat = values.to_numpy(False).astype(np.float64) if len(values) else np.zeros(0)
    with np.errstate(over="ignore", invalid="ignore"):
        flat = np.floor(flat * scale)
    bad = ~np.isfinite(flat) | values.is_null().to_numpy(False) if len(flat) else np.zeros(0, bool)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    use = ~vectors.is_null().to_numpy(False)
    use[owner[bad]] = False
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    matrix = np.zeros((len(lengths), int(lengths.max(initial=0))))
    matrix[owner, place] = np.where(bad, 0, flat)
    gone = ids.is_null().to_numpy(False)
    return ids.fill_null(0).to_numpy(False).astype(np.int64)[use], gone[use], matrix[use]


def _unpacked(row: dict):
    matrix = np.frombuffer(row["data"], row["kind"]).astype(np.float64).reshape(row["n"], row["width"])
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["gone"], bool), matrix


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as long; through Python's whole numbers where doubles may round."""
    width = min(queries.shape[1], rows.shape[1])
    queries, rows = queries[:, :width], rows[:, :width]
    if np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, width) < EXACT:
        return (queries @ rows.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    if not width:
        return np.zeros((len(queries), len(rows)), np.int64)
    exact = whole(queries).dot(whole(rows).T)
    return np.clip(exact, -MOST, MOST).astype(np.int64)


def _best(scores: np.ndarray, most: int) -> np.ndarray:
    """Columns of each row's highest scores, the first ones among ties."""
    if scores.shape[1] <= most:
        return np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
    edge = np.partition(scores, -most, axis=1)[:, -most, None]
    above, level = scores > edge, scores == edge
    missing = most - above.sum(axis=1, keepdims=True)
    chosen = above | (level & (np.cumsum(level, axis=1) <= missing))
    return np.nonzero(chosen)[1].reshape(len(scores), most)


def _tile(most: int):
    def search(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        shards = [_unpacked(row) for row in left.select(["n", "width", "kind", "ids", "gone", "data"]).to_pylist()]
        out = {name: [] for name in ("query_block", "place", "query_id", "own", "length", "minus", "gone", "vec_id")}
        for row in right.to_pylist() if shards else []:
            query_ids, _, matrix = _unpacked(row)
            for start in range(0, len(query_ids), QUERY_ROWS):
                queries = matrix[start : start + QUERY_ROWS]
                parts = []
                for ids, gone, rows in shards:
                    order = np.lexsort((ids, gone))
                    scores = _products(queries, rows[order])
                    columns = _best(scores, most)
                    parts.append((np.take_along_axis(scores, columns, 1), gone[order][columns], ids[order][columns]))
                score, gone, ids = (np.concatenate(x, axis=1) for x in zip(*parts, strict=True))
                order = np.lexsort((ids, gone, -score), axis=1)  # the last key leads
                score, gone, ids = (np.take_along_axis(x, order, 1) for x in (score, gone, ids))
                score, gone, ids = score[:, :most], gone[:, :most], ids[:, :most]
                own = [int(_products(q[None], q[None])[0, 0]) for q in queries]
                n = len(queries)
                out["query_block"].append(np.full(n, row["block"]))
                out["place"].append(np.arange(start, start + n))
                out["query_id"].append(query_ids[start : start + n])
                out["own"].append(np.array(own, np.int64))
                out["length"].append(np.full(n, score.shape[1]))
                out["minus"].append(-score.ravel())
                out["gone"].append(gone.ravel())
                out["vec_id"].append(ids.ravel())
        got = {name: np.concatenate(x) if x else np.zeros(0, np.int64) for name, x in out.items()}
        gone = got["gone"].astype(bool)
        entries = pa.StructArray.from_arrays(
            [pa.array(got["minus"], pa.int64()), pa.array(gone), pa.array(got["vec_id"], pa.int64(), mask=gone)],
            ["minus", "gone", "vec_id"],
        )
        offsets = np.concatenate([[0], np.cumsum(got["length"])]).astype(np.int32)
        return pa.table(
            {
                "query_block": pa.array(got["query_block"], pa.int64()),
                "place": pa.array(got["place"], pa.int32()),
                "query_id": pa.array(got["query_id"], pa.int64()),
                "own": pa.array(got["own"], pa.int64()),
                "lane": pa.array(np.full(len(got["own"]), key[0].as_py() or 0), pa.int64()),
                "top": pa.ListArray.from_arrays(pa.array(offsets), entries),
            }
        )

    return search
