"""Incremental import of files: a streaming checkpoint stands in for the last value.

Each call lands the files that appeared since the call before, then stops. A file is landed
once even when executors or the driver are lost in between, since the checkpoint and the
sink's file log commit together.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from quayside.functions.text import drop_all_delimiters
from quayside.operators.schema import normalise
from quayside.plans.load import CODEC


def land_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    landing: str,
    checkpoint: str,
    name_filter: str = "*.parquet",
    max_files: int = 1000,
    max_file_age: str = "36500d",
) -> None:
    """Land new Parquet files of `source`, at most `max_files` per batch.

    Files count as new whatever their time stamp, so copies that keep old times are landed. The
    checkpoint then remembers every file landed; where files older than some age cannot appear
    any more, a shorter `max_file_age` keeps that list small, but skips older files unseen.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name_filter)
    files = reader.options(maxFilesPerTrigger=max_files, maxFileAge=max_file_age).parquet(source)
    query = (
        drop_all_delimiters(normalise(files))
        .writeStream.format("parquet")
        .option("compression", CODEC)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(landing)
    )
    query.awaitTermination()
