"""Land a batch, keep its target table in step, and load the one into the other."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.errors import LandingMissing, UnsupportedLayout
from quayside.functions.text import drop_all_delimiters
from quayside.operators.schema import (
    conform,
    diff_schemas,
    fits_as_is,
    merge_schemas,
    normalise,
    normalised_schema,
)
from quayside.session import delete_path, move_dir, path_exists, write_json_lines
from quayside.sources.datasets import open_landing

# Default roots and the file layout and codec of landed data.
LANDING_ROOT = "/data/lz"
TARGET_ROOT = "/data/scrubbed"
LAYOUT = "parquet"
CODEC = "snappy"

# Spark skips folders that start with an underscore when it reads a table's files.
_SCHEMA_LOG = "_schema"


@dataclass(frozen=True)
class Landed:
    """What one write put down: the rows, and the largest check value as text."""

    n_rows: int
    mark: str | None


def land(df: DataFrame, path: str, check_col: str | None = None) -> Landed:
    """Write a batch as Snappy Parquet, lower-case names and clean text.

    Rows are counted as they are written, in the write's own stage. Landing the same path
    again replaces it, so a run that failed can start over.
    """
    seen = Observation()
    mark = F.max(check_col.lower()) if check_col else F.lit(None)
    # Observed before cleaning, so the mark is a value the source knows.
    counted = normalise(df).observe(
        seen, F.count(F.lit(1)).alias("n_rows"), mark.cast("string").alias("mark")
    )
    batch = drop_all_delimiters(counted)
    batch.write.mode("overwrite").option("compression", CODEC).parquet(path)
    return Landed(seen.get["n_rows"], seen.get["mark"])


def table_path(root: str, database: str, table: str) -> str:
    return f"{root}/{database}/{table}"


def ensure_target(
    spark: SparkSession, database: str, table: str, root: str, schema: T.StructType
) -> str:
    """Create the external target table, or bring it in step with the batch's schema."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    name, path = f"`{database}`.`{table}`", table_path(root, database, table)
    wanted = normalised_schema(schema, table)
    if spark.catalog.tableExists(name):
        evolve_target(spark, name, path, wanted)
    else:
        # A table the catalogue lost keeps the fields its files were written with.
        known = _last_schema(spark, path)
        if known is not None:
            wanted = merge_schemas(wanted, known)
        if wanted != known:
            _log_schema(spark, path, wanted)
        _create(spark, name, path, wanted)
    return name


def evolve_target(spark: SparkSession, name: str, path: str, source: T.StructType) -> bool:
    """Merge the batch's schema into the table's; true when the table changed.

    New fields are added in place. A wider type cannot be set in place on a Parquet table,
    so the table is dropped and made again over the same files, which are not touched: a
    narrow file reads as the wide type. The merged schema is logged next to the files
    first, so a driver lost before the table is back loses nothing.
    """
    target = spark.table(name).schema
    actions = {action for *_, action in diff_schemas(source, target)}
    if not actions & {"added", "widened"}:
        return False
    merged = merge_schemas(source, target)
    _log_schema(spark, path, merged)
    if "widened" in actions:
        spark.sql(f"DROP TABLE {name}")
        _create(spark, name, path, merged)
    else:
        added = T.StructType([f for f in merged if f.name not in target.names])
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added.toDDL()})")
    return True


def load(
    spark: SparkSession,
    landing: str,
    target: str,
    path: str,
    run_id: str,
    layout: str = LAYOUT,
    schema: T.StructType | None = None,
) -> Landed:
    """Add a landed batch to its target table and count the rows on the way.

    No shuffle and no compaction. Each run has a folder of its own below the table's, so
    a run loaded again replaces its rows and doubles none, and a load that fails leaves the
    table as it was. A batch whose columns have the table's types is moved there, not written
    again, and counted from its files' footers; its landing is then gone.
    """
    if layout != LAYOUT:
        raise UnsupportedLayout(f"cannot load files of layout {layout}")
    batch = open_landing(spark, landing, schema)
    if batch is None:
        raise LandingMissing(f"no dataset found at {landing}")
    wanted, folder = spark.table(target).schema, f"{path}/run-{run_id}"
    fitted = conform(batch, wanted)
    if fits_as_is(batch.schema, wanted) and move_dir(spark, landing, folder):
        n_rows = spark.read.schema(batch.schema).parquet(folder).count()
    else:
        seen = Observation()
        counted = fitted.observe(seen, F.count(F.lit(1)).alias("n_rows"))
        counted.write.mode("overwrite").option("compression", CODEC).parquet(folder)
        n_rows = seen.get["n_rows"]
    spark.catalog.refreshTable(target)
    return Landed(n_rows, None)


def clean_up(spark: SparkSession, landing: str) -> None:
    """Delete a landing directory; call it after its load has succeeded."""
    delete_path(spark, landing)


def _create(spark: SparkSession, name: str, path: str, schema: T.StructType) -> None:
    # Runs have a folder each, so the table reads its folder with all that is below.
    spark.catalog.createTable(
        name,
        path=path,
        source=LAYOUT,
        schema=schema,
        description=schema[0].metadata.get("comment"),
        recursiveFileLookup="true",
    )


def _log_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    entry = {"at": datetime.now(timezone.utc).isoformat(), "schema": schema.json()}
    write_json_lines(spark, f"{path}/{_SCHEMA_LOG}", [entry])


def _last_schema(spark: SparkSession, path: str) -> T.StructType | None:
    if not path_exists(spark, f"{path}/{_SCHEMA_LOG}"):
        return None
    entries = spark.read.schema("at timestamp, schema string").json(f"{path}/{_SCHEMA_LOG}")
    latest = entries.agg(F.max_by("schema", "at")).first()[0]
    return T.StructType.fromJson(json.loads(latest))
