"""Maintenance of tables that hold one row per key.

Frames in, frames out: nothing here writes. Keys follow SQL equality, so a null key matches
nothing. The side looked up is first cut down to its distinct keys or its latest rows, which
combines before the shuffle; a key that many rows share then costs one row per input split.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def search(df: DataFrame, **criteria: object) -> DataFrame:
    """Rows that equal every criterion given; criteria of None do not count."""
    tests = (F.col(name) == value for name, value in criteria.items() if value is not None)
    return df.where(reduce(and_, tests, F.lit(True)))


def lookup(df: DataFrame, **key: object) -> DataFrame:
    """The one row of a key, or no row."""
    return search(df, **key).limit(1)


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Each key once, combined before the shuffle.

    Spark splits the hot keys of a join only where both sides come straight from a shuffle
    made for it. Grouping by the key's hash as well leaves the keys partitioned by more than
    the join asks for, so a join too large to broadcast shuffles these few keys once more
    and can then split a hot key of the other side.
    """
    return df.select(*keys, F.xxhash64(*keys).alias("_hash")).distinct().select(*keys)


def with_found(df: DataFrame, keyed: DataFrame, keys: list[str]) -> DataFrame:
    """Every row of `df`, and in `found` whether `keyed` has its key."""
    marked = distinct_keys(keyed, keys).withColumn("found", F.lit(True))
    return df.join(marked, keys, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def with_row_id(df: DataFrame, keys: list[str], name: str = "id") -> DataFrame:
    """A 64-bit id made from the key, the same on every run."""
    return df.select(F.xxhash64(*keys).alias(name), "*")


def insert(df: DataFrame, rows: DataFrame) -> DataFrame:
    return df.unionByName(rows)


def missing_from(rows: DataFrame, df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose key is new to `df`.

    `df` is first filtered down to the keys in question, so a few rows against a large
    table cost one read of its keys and no shuffle of them.
    """
    known = df.select(*keys).join(distinct_keys(rows, keys), keys, "left_semi")
    return rows.join(distinct_keys(known, keys), keys, "left_anti")


def by_whole_key(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows whose key has no null in it, and the others."""
    whole = reduce(and_, (F.col(name).isNotNull() for name in keys))
    return df.where(whole), df.where(~whole)


def insert_if_absent(
    df: DataFrame, rows: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """`df` with the rows whose key is new; of rows that share one the first by `order` goes in.

    Without an order any one of them does. Null keys match nothing, not each other either, so
    every row with a null in its key goes in.
    """
    new = missing_from(rows, df, keys)
    whole, part = by_whole_key(new, keys)
    once = first_per_key(whole, keys, order) if order else whole.dropDuplicates(keys)
    return insert(insert(df, once), part)


def update(
    df: DataFrame, updates: DataFrame, keys: list[str], order: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """`df` with matched rows replaced, and the updates that matched nothing.

    `updates` holds the columns to replace. Of updates that share a key the last by `order`
    counts, without an order any one, so no row of `df` is ever doubled. Updates with a null in
    their key match nothing and come back, each of them.
    """
    updates, part = by_whole_key(updates, keys)
    updates = latest_per_key(updates, keys, order) if order else updates.dropDuplicates(keys)
    changed = [name for name in updates.columns if name not in keys]
    new = updates.select(*keys, F.struct(*changed).alias("_new"))
    joined = df.join(new, keys, "left")
    updated = joined.select(
        *(
            F.when(F.col("_new").isNotNull(), F.col(f"_new.{name}"))
            .otherwise(F.col(name))
            .alias(name)
            if name in changed
            else F.col(name)
            for name in df.columns
        )
    )
    return updated, insert(missing_from(updates, df, keys), part)


def delete(df: DataFrame, doomed: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows kept and the rows deleted. `keys` may be all or part of the table's key."""
    doomed = distinct_keys(doomed, keys)
    return df.join(doomed, keys, "left_anti"), df.join(doomed, keys, "left_semi")


def delete_cascade(
    parents: DataFrame, children: DataFrame, doomed: DataFrame, parent_key: str, child_key: str
) -> tuple[DataFrame, DataFrame]:
    """Parents and children left after the doomed parents go, their children with them."""
    doomed = doomed.select(parent_key)
    kept_children, _ = delete(children, doomed.withColumnRenamed(parent_key, child_key), [child_key])
    kept_parents, _ = delete(parents, doomed, [parent_key])
    return kept_parents, kept_children


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by `order`, which must tell all rows of a key apart; nulls come first."""
    return _one_per_key(df, keys, order, F.max_by)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by `order`, which must tell all rows of a key apart; nulls come last."""
    return _one_per_key(df, keys, order, F.min_by)


def replace(df: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """`df` with `rows`, one per key, put in place of what was there.

    The table is only filtered, never regrouped: when the incoming rows are few it is read
    once and not shuffled.
    """
    kept = df.join(distinct_keys(rows, keys), keys, "left_anti")
    return kept.unionByName(rows.select(*df.columns))


def upsert(df: DataFrame, rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """`df` with the last of `rows` for each key, by `order`, put in place of what was there."""
    return replace(df, latest_per_key(rows, keys, order), keys)


def changed_values(base: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys of both sides whose value differs: the keys, `base_value` and `new_value`."""
    old = base.select(*keys, F.col(value).alias("base_value"))
    joined = old.join(new.select(*keys, F.col(value).alias("new_value")), keys)
    differs = F.col("base_value").isNotNull() & ~F.col("base_value").eqNullSafe(F.col("new_value"))
    return joined.where(differs)


def with_children(parents: DataFrame, children: DataFrame, keys: list[str]) -> DataFrame:
    """Each child row with its parent's columns."""
    return parents.join(children, keys)


def stack_properties(
    df: DataFrame, keys: list[str], properties: dict[str, Column], prop_class: str | None = None
) -> DataFrame:
    """One row per key and property: `prop_name`, `prop_val` as text, maybe `prop_class`."""
    pairs = F.array(
        *(
            F.struct(F.lit(name).alias("prop_name"), value.cast("string").alias("prop_val"))
            for name, value in properties.items()
        )
    )
    stacked = df.select(*keys, F.explode(pairs).alias("_p")).select(
        *keys, "_p.prop_name", "_p.prop_val"
    )
    return stacked if prop_class is None else stacked.withColumn("prop_class", F.lit(prop_class))


def read_properties(
    df: DataFrame,
    keys: list[str],
    names: dict[str, str],
    prop_name: str = "prop_name",
    prop_val: str = "prop_val",
    order: list[str] | None = None,
    **criteria: object,
) -> DataFrame:
    """Property rows as one row per key, a column for each of `names` (property → column).

    With an order the last value of a repeated property counts. Criteria such as
    `prop_class` filter the rows first.
    """
    order_by = _order_value(order) if order else F.lit(0)
    wanted = search(df, **criteria)
    return wanted.groupBy(*keys).agg(
        *(
            F.max_by(prop_val, F.when(F.col(prop_name) == name, order_by)).alias(column)
            for name, column in names.items()
        )
    )


def _order_value(order: list[str], nulls_first: bool = True) -> Column:
    """One value to compare rows by; in structs a flag places the nulls."""
    if len(order) == 1:
        return F.col(order[0])
    flag = Column.isNotNull if nulls_first else Column.isNull
    return F.struct(*(x for i, name in enumerate(order) for x in (flag(F.col(name)).alias(f"f{i}"), F.col(name).alias(f"v{i}"))))


def _one_per_key(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    # One aggregate per column, not one over a struct: fixed-width columns then stay in
    # the hash aggregate. Rows are combined before the shuffle, so a hot key is no task's load.
    others = [name for name in df.columns if name not in keys]
    by = _order_value(order, pick is F.max_by)
    # A single order column that is null in all rows of a key picks none: any one row then
    # stands for the key, the same in every column.
    picked = (
        (lambda name: F.when(F.count(by) > 0, pick(name, by)).otherwise(F.first(name)))
        if len(order) == 1
        else (lambda name: pick(name, by))
    )
    return (
        df.groupBy(*keys)
        .agg(*(picked(name).alias(name) for name in others))
        .select(*df.columns)
    )
