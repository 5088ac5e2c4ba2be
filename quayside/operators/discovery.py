"""From a database's catalogue to job specs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import naming

# Fixed value: how a catalogue marks the column that numbers rows by itself.
AUTO_KEY_MARK = "%auto_increment%"


def discover_specs(
    tables: DataFrame,
    columns: DataFrame,
    db_type: str,
    server: str,
    database: str,
    mappers: str = naming.DEFAULT_MAPPERS,
) -> DataFrame:
    """`table_name` and `input` (a job spec) for each table of a database, by table name.

    `tables` holds table_schema and table_name; `columns` also column_name, extra, and in
    last_val the value just before a column's first, null where that is the usual 0. A
    table's self-numbering column becomes its split and check column; a table without one
    keeps both empty. Schema and table must both match: equal names elsewhere do not count.
    """
    keyed = columns.where(F.col("extra").like(AUTO_KEY_MARK))
    key = F.ifnull(F.col("c.column_name"), F.lit(""))
    return (
        tables.where(F.col("table_schema") == database)
        .alias("t")
        .join(
            keyed.alias("c"),
            (F.col("t.table_schema") == F.col("c.table_schema"))
            & (F.col("t.table_name") == F.col("c.table_name")),
            "left",
        )
        .select(
            "t.table_name",
            naming.build_spec(
                F.lit(db_type),
                F.lit(server),
                F.col("t.table_schema"),
                F.col("t.table_name"),
                key,
                F.lit(mappers),
                key,
                F.ifnull(F.col("c.last_val"), F.lit(naming.FIRST_LAST_VALUE)),
            ).alias("input"),
        )
        .distinct()
        .orderBy("table_name")
    )
