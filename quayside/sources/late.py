"""Rows that arrive at or below a mark that an earlier import has reached already.

An import takes the rows past its last value, so a row that turns up later with a smaller check
value would never come. Here the values in the region that counts as imported are summed up per
range on both sides: rows, sum of the values' places in their range, and sum of squares of these
places. Ranges that agree are proved; only ranges that differ are read, and of them only values
the source has more often. Rows without a check value are compared by their contents.

Only one row per range comes to the driver, RANGES at most, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.naming import named
from quayside.functions.text import drop_delimiters
from quayside.operators.keyed import distinct_keys
from quayside.sources.incremental import past, upto

RANGES = 4096
SPANS = 32  # conditions handed to a scan; nearer spans are joined, which reads more but loses nothing
FOLD = 1_000_003  # a prime; places are folded by it before squaring, so sums stay small

Sums = Callable[[int, int], DataFrame]


@dataclass(frozen=True)
class Ranges:
    """Equal ranges of whole numbers, or as many buckets by hash where width is none."""

    low: int
    width: int | None


def whole_number(column: Column, data_type: T.DataType) -> Column | None:
    """The value as a whole number that keeps its order, where its type has one."""
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return column.cast("long")
    if isinstance(data_type, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(data_type, T.TimestampNTZType):
        return F.unix_micros(column.cast("timestamp"))
    return None


def _value(number: int, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.DateType):
        return F.date_from_unix_date(F.lit(number).cast("int"))
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_micros(F.lit(number)).cast(data_type)
    return F.lit(number).cast("long")


def range_sums(df: DataFrame, number: Column, ranges: Ranges) -> DataFrame:
    """range, n, places and squares of each range that holds a value."""
    if ranges.width is None:
        place, of = number, F.pmod(number, F.lit(RANGES))
    else:
        shifted = number - F.lit(ranges.low)
        of = F.call_function("div", shifted, F.lit(ranges.width).cast("long"))
        place = shifted - of * F.lit(ranges.width)
    folded = F.pmod(place, F.lit(FOLD))
    return (
        df.select(of.cast("long").alias("range"), place.cast("decimal(20,0)").alias("place"), folded.alias("folded"))
        .groupBy("range")
        .agg(
            F.count("*").alias("n"),
            F.sum("place").cast("decimal(30,0)").alias("places"),
            F.sum((F.col("folded") * F.col("folded")).cast("decimal(20,0)")).cast("decimal(30,0)").alias("squares"),
        )
    )


def differing(source: DataFrame, landed: DataFrame) -> list[int]:
    """Ranges whose sums differ and of which the source has rows."""
    theirs = landed.select("range", *(F.col(c).alias(f"_{c}") for c in ("n", "places", "squares")))
    same = reduce(
        lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("n", "places", "squares"))
    )
    found = source.join(theirs, "range", "left").where(~same).select("range").collect()
    return sorted(row["range"] for row in found)


def spans(numbers: list[int], most: int = SPANS) -> list[tuple[int, int]]:
    """Runs of neighbouring numbers, the closest of them joined until `most` are left."""
    out: list[tuple[int, int]] = []
    gaps = sorted((b - a for a, b in zip(numbers, numbers[1:], strict=False)), reverse=True)
    widest = gaps[most - 1] if len(gaps) >= most else 1
    for number in numbers:
        if out and number - out[-1][1] <= max(1, widest):
            out[-1] = (out[-1][0], number)
        else:
            out.append((number, number))
    return out


def late_rows(
    source: DataFrame,
    landed: DataFrame,
    check_col: str,
    floor: str | None,
    mark: str,
    sums: Sums | None = None,
    bounds: tuple[int, int] | None = None,
) -> DataFrame | None:
    """Rows of the source in (floor, mark] or without a check value that are not landed; none if proved.

    A value the source holds more often than the target brings all its rows where the target has
    none of it, else those whose contents, cleaned as landing cleans them, the target holds less
    often. So a repeated row comes as often as it is missing, a changed row of an unchanged
    number of rows does not come, and rows gone from the source stay. `sums` gives the source's
    range sums where something nearer to it can work them out (by first value and width), and
    `bounds` then its smallest and largest value.
    """
    check = named(check_col)
    kind = check_type(source, check_col)
    theirs = named(check_col.lower())
    inside = source.where(past(source, check_col, floor) & upto(source, check_col, mark))
    held = landed.where(past(landed, check_col.lower(), floor) & upto(landed, check_col.lower(), mark))
    number = whole_number(check, kind)
    low = top = None
    if number is not None:
        low, top = (bounds or (None, None)) if sums else inside.agg(F.min(number), F.max(number)).first()
    if number is not None and low is None:
        return _without_value(source, landed, check_col)
    if number is None or top - low >= 1 << 62:
        # No order to cut by: buckets of the value's hash, as the target would hold it.
        to = check_type(landed, check_col.lower())
        number, other = F.xxhash64(check.cast(to)), F.xxhash64(theirs)
        ranges = Ranges(0, None)
    else:
        other = whole_number(theirs, check_type(landed, check_col.lower()))
        ranges = Ranges(low, (top - low) // RANGES + 1)
    of_source = sums(ranges.low, ranges.width) if sums and ranges.width else range_sums(inside, number, ranges)
    # The target may hold values the source has lost; below the first one they are of no range.
    if ranges.width is not None:
        held = held.where(other >= F.lit(ranges.low))
    odd = differing(of_source, range_sums(held, other, ranges))
    found = []
    if odd:
        if ranges.width is None:
            here, there = (F.pmod(n, F.lit(RANGES)).isin(odd) for n in (number, other))
        else:
            edges = [
                (_value(ranges.low + a * ranges.width, kind), _value(ranges.low + (b + 1) * ranges.width - 1, kind))
                for a, b in spans(odd)
            ]
            here, there = (reduce(or_, (c.between(*edge) for edge in edges)) for c in (check, theirs))
        found.append(_missing(inside.where(here), held.where(there), check_col))
    lost = _without_value(source, landed, check_col)
    found += [lost] if lost is not None else []
    return reduce(DataFrame.unionByName, found) if found else None


def check_type(df: DataFrame, check_col: str) -> T.DataType:
    return df.select(named(check_col)).schema[0].dataType


def _missing(source: DataFrame, landed: DataFrame, check_col: str) -> DataFrame:
    """Rows of values that the source holds more often."""
    key = "_value"
    kind = check_type(landed, check_col.lower())
    rows = source.withColumn(key, named(check_col).cast(kind))
    held = landed.withColumn(key, named(check_col.lower()))
    counts = rows.groupBy(key).agg(F.count("*").alias("_n"))
    have = held.groupBy(key).agg(F.count("*").alias("_have"))
    more = counts.join(have, key, "left").where(F.col("_n") > F.coalesce("_have", F.lit(0)))
    new = distinct_keys(more.where(F.col("_have").isNull()), [key])
    some = distinct_keys(more.where(F.col("_have").isNotNull()), [key])
    whole = rows.join(new, key, "left_semi").drop(key)
    parts = _excess(
        rows.join(some, key, "left_semi").drop(key), held.join(some, key, "left_semi").drop(key)
    )
    return whole.unionByName(parts)


def _without_value(source: DataFrame, landed: DataFrame, check_col: str) -> DataFrame | None:
    """Rows without a check value that the target lacks; none if it has as many."""
    rows = source.where(named(check_col).isNull())
    held = landed.where(named(check_col.lower()).isNull())
    if rows.count() <= held.count():
        return None
    return _excess(rows, held)


def _excess(source: DataFrame, landed: DataFrame) -> DataFrame:
    """Rows of the source as often as it has them more often than the target, by contents.

    Contents are the columns of both, as landing cleans them and the target types them. Rows
    of equal contents are merged before the shuffle, however many they are.
    """
    kinds = {f.name.lower(): f.dataType for f in landed.schema}
    shared = [f for f in source.schema if f.name.lower() in kinds]
    ours = [_cell(named(f.name), f.dataType, kinds[f.name.lower()]) for f in shared]
    theirs = [_cell(named(f.name.lower()), kinds[f.name.lower()], kinds[f.name.lower()]) for f in shared]
    row = F.struct(*(named(c) for c in source.columns)).alias("_row")
    counted = (
        source.select(row, *_prints(ours)).groupBy("_a", "_b").agg(F.count("*").alias("_n"), F.first("_row").alias("_row"))
    )
    held = landed.select(*_prints(theirs)).groupBy("_a", "_b").agg(F.count("*").alias("_have"))
    left = F.col("_n") - F.coalesce("_have", F.lit(0))
    return (
        counted.join(held, ["_a", "_b"], "left")
        .where(left > 0)
        .select("_row", F.explode(F.sequence(F.lit(1).cast("long"), left)).alias("_time"))
        .select("_row.*")
    )


def _prints(cells: list[Column]) -> list[Column]:
    return [F.xxhash64(*cells).alias("_a"), F.xxhash64(F.lit(1), *cells, F.lit(2)).alias("_b")]


def _cell(column: Column, kind: T.DataType, to: T.DataType) -> Column:
    """A value as the target holds it, with nulls told apart from what hashes alike."""
    if isinstance(kind, T.StringType):
        column = drop_delimiters(column)
    elif isinstance(kind, (T.MapType, T.ArrayType, T.StructType)):
        return F.coalesce(F.to_json(F.struct(column.alias("v"))), F.lit(""))
    elif kind != to:
        column = column.cast(to)
    return F.struct(column.isNull().alias("null"), column.alias("value"))
