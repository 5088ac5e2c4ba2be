"""Datasets at a path: landed Parquet, chosen formats, delimited text without a header."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.naming import named
from quayside.functions.text import join_escaped, split_escaped, text_to_null
from quayside.session import path_exists, small_frame

log = logging.getLogger(__name__)


def open_landing(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The Parquet dataset at a path, or none when nothing is there.

    A schema known already saves the look into the files' footers.
    """
    if not path_exists(spark, path):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def create_dataset(
    spark: SparkSession, path: str, schema: T.StructType, data_format: str = "parquet"
) -> DataFrame:
    """The dataset at a path; an empty one of that schema and format is made if missing."""
    if not path_exists(spark, path):
        small_frame(spark, [], schema).write.format(data_format).save(path)
    return spark.read.format(data_format).schema(schema).load(path)


# Quotes inside a field are doubled, and blanks around it belong to it.
CSV_OPTIONS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """A directory of CSV text without a header; the schema names the columns, empty text is null.

    Fields may hold line breaks. Each file is then read by one task; where no field does,
    `multi_line=False` lets large files be split. A missing directory is no error: it is
    logged, and gives no rows.
    """
    if not path_exists(spark, path):
        log.warning("No input directory found: %s", path)
        return small_frame(spark, [], schema)
    reader = spark.read.schema(schema).options(mode="FAILFAST", multiLine=multi_line, **CSV_OPTIONS)
    return reader.option("lineSep", "\n").csv(path)


def write_csv(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """CSV text that `read_csv` gives back exactly, but for empty text, which it reads as null."""
    df.write.options(maxRecordsPerFile=rows_per_file, lineSep="\n", **CSV_OPTIONS).csv(path)


def read_escaped(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Delimited text whose separators are escaped rather than quoted; empty text is null."""
    fields = spark.read.text(path).select(split_escaped(F.col("value")).alias("_f"))
    return fields.select(
        *(
            text_to_null(F.get("_f", F.lit(i))).cast(f.dataType).alias(f.name)
            for i, f in enumerate(schema)
        )
    )


def write_escaped(df: DataFrame, path: str) -> None:
    df.select(join_escaped(*(named(c) for c in df.columns)).alias("value")).write.text(path)
