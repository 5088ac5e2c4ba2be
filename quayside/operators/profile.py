"""Split ranges of a table and the search for a column to split and check on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.naming import named

# A run of values shares one set of bits, as many as a long has; a value is its place's bit there.
_BIT_SHIFT = 6
_BIT = "shiftleft(1L, CAST(value & 63 AS int))"

WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def split_bounds(df: DataFrame, split_by: str) -> tuple[int, int] | None:
    """Smallest and largest split value; none for a table without any."""
    low, high = df.agg(F.min(named(split_by)), F.max(named(split_by))).first()
    return None if low is None else (low, high)


def split_report(df: DataFrame, split_by: str, n_splits: int) -> DataFrame:
    """Rows per split of a whole-number column, for the splits that hold any.

    All splits are of one width, so a row's split is worked out from its value; no join of
    rows with ranges is needed. Rows without a split value are in no split.
    """
    low, high = split_bounds(df, split_by) or (0, 0)
    width = (high - low) // n_splits + 1
    split_id = F.expr(f"CAST((`{split_by}` - {low}L) DIV {width}L AS int)")
    return (
        df.where(named(split_by).isNotNull())
        .groupBy(split_id.alias("split_id"))
        .agg(F.count("*").alias("n_rows"))
        .select(
            "split_id",
            F.expr(f"{low}L + split_id * {width}L").alias("lower_bound"),
            F.expr(f"{low}L + (split_id + 1) * {width}L").alias("upper_bound"),
            "n_rows",
        )
    )


def whole_number_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, WHOLE_NUMBERS)]


def column_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, nulls, distinct values, minimum and maximum of each table's whole-number columns.

    All columns are stacked to (column, value) pairs and values are merged to sets of bits
    before the one shuffle, so neither a long column nor a hot value ends up in one task.
    Columns go by number until the end, which keeps the pairs small.
    """
    names, stacked = [], []
    for table, df in tables.items():
        columns = whole_number_columns(df)
        if columns:
            values = F.array(*(named(c).cast("long") for c in columns))
            pairs = df.select(F.posexplode(values).alias("_no", "value"))
            stacked.append(pairs.withColumn("_no", F.col("_no") + len(names)))
            names += [(table, c) for c in columns]
    name_of = F.array(
        *(F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("column_name")) for t, c in names)
    )
    return (
        reduce(DataFrame.unionByName, stacked)
        .groupBy("_no", F.shiftright("value", _BIT_SHIFT).alias("run"))
        .agg(
            F.count("*").alias("n"),
            F.count("value").alias("n_values"),
            F.bit_or(F.expr(_BIT)).alias("bits"),
            F.min("value").alias("lo"),
            F.max("value").alias("hi"),
        )
        .groupBy("_no")
        .agg(
            F.sum("n").alias("n_rows"),
            (F.sum("n") - F.sum("n_values")).alias("n_nulls"),
            F.coalesce(F.sum(F.bit_count("bits").cast("long")), F.lit(0)).alias("n_distinct"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
        )
        .withColumn("_name", F.get(name_of, "_no"))
        .select("_name.*", "n_rows", "n_nulls", "n_distinct", "lo", "hi")
    )


def is_key(profile: DataFrame) -> Column:
    """A key has a value in every row, each of them once."""
    return (F.col("n_rows") > 0) & (F.col("n_nulls") == 0) & (F.col("n_distinct") == F.col("n_rows"))


def find_key(df: DataFrame) -> tuple[str, int] | None:
    """The first whole-number column that is unique and never null, and its smallest value.

    One pass over minimum, maximum and nulls rules out columns: with fewer values in range
    than rows, some value repeats. The rest are checked for repeats together, in a second pass.
    """
    columns = whole_number_columns(df)
    if not columns:
        return None
    facts = df.agg(
        F.count("*").alias("n_rows"),
        *(
            F.struct(F.count(c), F.min(c), F.max(c)).alias(f"c{i}")
            for i, c in enumerate(map(named, columns))
        ),
    ).first()
    lows = {}
    for i, column in enumerate(columns):
        n_values, low, high = facts[f"c{i}"]
        if 0 < facts["n_rows"] == n_values <= high - low + 1:
            lows[column] = low
    n_distinct = distinct_values(df, list(lows)) if lows else {}
    return next(((c, low) for c, low in lows.items() if n_distinct[c] == facts["n_rows"]), None)


def distinct_values(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Exact number of distinct values of each whole-number column, nulls aside, in one pass.

    Values are stacked to (column, run of 64 values) with one bit for the value's place. Bits
    are merged before the one shuffle, so a hot value is one row a task and neighbouring values
    share one; a scattered column sends no more than its own values.
    """
    values = F.array(*(named(c).cast("long") for c in columns))
    stacked = df.select(F.posexplode(values).alias("no", "value")).where("value is not null")
    runs = stacked.groupBy("no", F.shiftright("value", _BIT_SHIFT).alias("run"))
    bits = runs.agg(F.bit_or(F.expr(_BIT)).alias("bits"))
    counted = bits.groupBy("no").agg(F.sum(F.bit_count("bits")).alias("n")).collect()
    return {**dict.fromkeys(columns, 0), **{columns[r["no"]]: r["n"] for r in counted}}
