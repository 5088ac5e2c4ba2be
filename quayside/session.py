"""Session settings, the shared working folder and file housekeeping."""

from __future__ import annotations

import json
import tempfile
import time
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quayside.errors import QuaysideError

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the next step then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local session, where the driver is the one executor, may fall back to a
    temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise QuaysideError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="quayside-"))
    return context.getCheckpointDir().rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def small_frame(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A few driver values as a frame of known size, which joins can broadcast.

    Through Arrow the values become a local relation; a plain list would become an RDD of
    unknown size.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = {f.name: pa.array([row[i] for row in rows]) for i, f in enumerate(schema)}
    return spark.createDataFrame(pa.table(columns), schema)


def _filesystem(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    filesystem, jvm_path = _filesystem(spark, path)
    return filesystem.exists(jvm_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    filesystem, jvm_path = _filesystem(spark, path)
    if not filesystem.exists(jvm_path):
        return []
    return sorted(status.getPath().getName() for status in filesystem.listStatus(jvm_path))


def delete_path(spark: SparkSession, path: str) -> bool:
    filesystem, jvm_path = _filesystem(spark, path)
    return filesystem.delete(jvm_path, True)


def rename_path(spark: SparkSession, path: str, to: str) -> None:
    filesystem, source = _filesystem(spark, path)
    _, target = _filesystem(spark, to)
    if not filesystem.rename(source, target):
        raise QuaysideError(f"cannot rename {path} to {to}")


def move_dir(spark: SparkSession, path: str, to: str) -> bool:
    """Put a folder in another's place, which is replaced; false if that is on another file system."""
    filesystem, source = _filesystem(spark, path)
    other, target = _filesystem(spark, to)
    if not filesystem.getUri().equals(other.getUri()):
        return False
    filesystem.delete(target, True)
    filesystem.mkdirs(target.getParent())
    if not filesystem.rename(source, target):
        raise QuaysideError(f"cannot rename {path} to {to}")
    return True


def write_json_lines(spark: SparkSession, folder: str, records: list[dict]) -> None:
    """Add a small file of JSON lines to a folder.

    The driver writes it, so a note about a job never waits for executors that are busy
    with jobs. It is written under a name that readers skip and renamed once complete.
    """
    name = f"{time.time_ns()}-{uuid.uuid4().hex}.json"
    filesystem, hidden = _filesystem(spark, f"{folder}/_{name}")
    _, final = _filesystem(spark, f"{folder}/{name}")
    lines = "".join(json.dumps(record, default=str) + "\n" for record in records)
    stream = filesystem.create(hidden, False)
    try:
        stream.write(lines.encode())
    finally:
        stream.close()
    if not filesystem.rename(hidden, final):
        raise QuaysideError(f"cannot write {final}")
