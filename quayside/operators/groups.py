"""Groups of neighbouring rows within each key: every ten rows, or every run of ten.

A key may hold a third of all rows, so no window here runs over a whole key. Rows are first
cut into slices of the order column that hold about equally many rows whatever their key;
windows then run over one key within one slice.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: rows per group.
GROUP_SIZE = 10

# Values of the order column looked at per slice when the slices are laid out.
_PROBES_PER_SLICE = 100
# About the most rows of a slice, and the fewest that are worth one of their own.
SLICE_ROWS = 4_000_000
LEAST_SLICE_ROWS = 100_000


def number_rows(
    df: DataFrame, by: list[str], order: str, name: str = "row_no", slices: int | None = None
) -> DataFrame:
    """Number the rows of each key 1, 2, 3 … by `order`, a unique number, date or time.

    There are as many slices as the rows need (`slices_for`), unless `slices` says how many.
    A row's number is its place within its slice plus the rows of its key in earlier
    slices. Those earlier rows come in as one extra row per key and slice that sorts first
    and weighs as much as they do, so one running sum gives the number without a join.
    """
    sliced = _with_slice(df, order, slices)
    counts = sliced.groupBy(*by, "_slice").agg(F.count("*").alias("_n"))
    # At most one row per slice and key: this window stays small for any key.
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.select(
        *by,
        "_slice",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_weight"),
        F.lit(False).alias("_is_row"),
    )
    rows = sliced.withColumn("_weight", F.lit(1).cast("long")).withColumn("_is_row", F.lit(True))
    so_far = (
        Window.partitionBy(*by, "_slice")
        .orderBy("_is_row", order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn(name, F.sum("_weight").over(so_far))
        .where("_is_row")
        .select(*df.columns, name)
    )


def disjoint_groups(
    df: DataFrame, by: list[str], order: str, size: int = GROUP_SIZE, slices: int | None = None
) -> DataFrame:
    """Add `batch_id`: 0 for the first `size` rows of a key, 1 for the next, and so on."""
    numbered = number_rows(df, by, order, "_row_no", slices)
    return numbered.withColumn("batch_id", F.expr(f"(_row_no - 1) DIV {size}")).drop("_row_no")


def sliding_groups(
    df: DataFrame,
    by: list[str],
    order: str,
    size: int = GROUP_SIZE,
    slices: int | None = None,
    block_rows: int = 100_000,
) -> DataFrame:
    """Every run of `size` neighbouring rows of a key; a shorter key is one run by itself.

    Returns the key columns, `first_key` and `last_key` (order values), `n` and `members`
    (the order values of the run). Rows are dealt into blocks by their number, and the
    first rows of a block also go to the block before it, whose last runs reach into it.
    """
    if block_rows < size:
        raise ValueError("a block must hold at least one run")
    numbered = number_rows(df.select(*by, order), by, order, "_row_no", slices)
    own = F.expr(f"(_row_no - 1) DIV {block_rows}")
    reaches_back = (own > 0) & ((F.col("_row_no") - 1) % block_rows < size - 1)
    blocks = F.when(reaches_back, F.array(own, own - 1)).otherwise(F.array(own))
    dealt = numbered.withColumn("_own", own).withColumn("_block", F.explode(blocks))
    run = Window.partitionBy(*by, "_block").orderBy("_row_no").rowsBetween(0, size - 1)
    # The list is a column of its own, so a reader who drops it does not pay for it.
    runs = dealt.withColumns(
        {
            "last_key": F.last(order).over(run),
            "n": F.count(F.lit(1)).over(run).cast("int"),
            "members": F.collect_list(order).over(run),
        }
    )
    is_run = (F.col("n") == size) | (F.col("_row_no") == 1)
    return runs.where((F.col("_own") == F.col("_block")) & is_run).select(
        *by, F.col(order).alias("first_key"), "last_key", "n", "members"
    )


def slices_for(n_rows: int, tasks: int) -> int:
    """How many slices rows are cut into: none holds much more than SLICE_ROWS whatever the
    setting, and there is one for each task if that leaves LEAST_SLICE_ROWS to each."""
    return max(-(-n_rows // SLICE_ROWS), min(tasks, n_rows // LEAST_SLICE_ROWS), 1)


def _with_slice(df: DataFrame, order: str, slices: int | None) -> DataFrame:
    """Add `_slice`: a whole number that rises with `order`."""
    place = _as_number(F.col(order), df.schema[order].dataType)
    edges = _edges(df.select(place.alias("_place")), slices)
    placed = df.withColumn("_place", place)
    if len(edges) < 1:
        return placed.withColumn("_slice", F.lit(0)).drop("_place")
    slicer = Bucketizer(
        splits=[float("-inf"), *edges, float("inf")], inputCol="_place", outputCol="_slice"
    )
    return slicer.transform(placed).withColumn("_slice", F.col("_slice").cast("int")).drop("_place")


def _edges(places: DataFrame, slices: int | None) -> list[float]:
    """At most `slices - 1` values that part the rows about evenly.

    Only the edges are estimated, from a thin sample; every row still gets its slice.
    """
    n_rows = places.count()
    tasks = int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = slices or slices_for(n_rows, tasks)
    if slices < 2 or n_rows == 0:
        return []
    share = min(1.0, slices * _PROBES_PER_SLICE / n_rows)
    probes = places if share == 1.0 else places.sample(share, seed=42)
    wanted = [i / slices for i in range(1, slices)]
    return sorted(set(probes.approxQuantile("_place", wanted, 1 / (4 * slices))))


def _as_number(col: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return col.cast("timestamp").cast("double")
    if isinstance(data_type, T.NumericType):
        return col.cast("double")
    raise TypeError(f"cannot slice rows by a column of type {data_type.simpleString()}")
