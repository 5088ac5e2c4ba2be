"""Rows of a table past a stored last value.

Last values are text, as a job spec stores them; they are cast to the check column's type
as literals, so the comparison reaches the Parquet or JDBC scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.naming import named


def past(df: DataFrame, check_col: str, last: str | None) -> Column:
    """True for rows past `last`; without a last value, for every row with a check value."""
    if not last:
        return named(check_col).isNotNull()
    return named(check_col) > _typed(df, check_col, last)


def upto(df: DataFrame, check_col: str, high: str) -> Column:
    """True for rows not past `high`."""
    return named(check_col) <= _typed(df, check_col, high)


def high_mark(df: DataFrame, check_col: str, last: str | None = None) -> str | None:
    """The largest check value past `last` as text, or none when there is nothing new."""
    newest = df.where(past(df, check_col, last)).agg(F.max(named(check_col)).cast("string"))
    return newest.first()[0]


def increment(df: DataFrame, check_col: str, last: str | None, high: str | None) -> DataFrame:
    """The rows in (last, high]. `high` is read before the rows, so rows that arrive in
    between wait for the next run. Rows without a check value, and rows that arrive later with a
    value that is not past `last`, are not among them: see `sources.late`."""
    if high is None:
        return df.where(F.lit(False))
    return df.where(past(df, check_col, last) & upto(df, check_col, high))


def _typed(df: DataFrame, check_col: str, value: str) -> Column:
    return F.lit(value).cast(df.select(named(check_col)).schema[0].dataType)
