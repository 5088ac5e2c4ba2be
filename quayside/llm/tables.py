"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import delete_path, new_dir

# Words are runs of anything but blanks, tabs and line ends.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
# Spark's default is 10,000 rows; an executor and its Python workers hold whole batches of texts.
BATCH_ROWS = "1000"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, label: str, texts: bool = False) -> DataFrame:
    """The same rows read back from a table in the shared folder.

    Later steps then start from files that outlive any executor, and every reader sees the
    same rows even where the frame's own order is open. Tables that hold whole `texts` are
    packed more tightly.
    """
    return Working().written(frame, label, texts)


class Working:
    """Tables of one job in the shared folder, which go as soon as no later step reads them."""

    def __init__(self):
        self._paths: dict[DataFrame, str] = {}

    def written(self, frame: DataFrame, label: str, texts: bool = False) -> DataFrame:
        """As `written` does, with a table that can be dropped."""
        path = new_dir(frame.sparkSession, label)
        writer = frame.write.option("compression", "zstd") if texts else frame.write
        writer.parquet(path)
        table = frame.sparkSession.read.schema(frame.schema).parquet(path)
        self._paths[table] = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Nothing that is still to run may read them, frames made from them included."""
        for table in tables:
            delete_path(table.sparkSession, self._paths.pop(table))

    def drop_others(self, *kept: DataFrame) -> None:
        self.drop(*(table for table in self._paths if table not in kept))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run within send BATCH_ROWS rows to Python at once, or as many as the session says if fewer."""
    before = spark.conf.get(ARROW_ROWS)
    if not 0 < int(before) < int(BATCH_ROWS):
        spark.conf.set(ARROW_ROWS, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def whole_text(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    return F.filter(F.split(text, GAP, -1), lambda word: word != "")


def word_count(text: Column) -> Column:
    """Number of words, from the pieces between gaps: only the outer two can be empty."""
    pieces = F.split(text, GAP, -1)
    empty = F.when(text == "", 1).otherwise(
        F.when(text.rlike(rf"^{GAP}"), 1).otherwise(0) + F.when(text.rlike(rf"{GAP}\z"), 1).otherwise(0)
    )
    return (F.size(pieces) - empty).cast("long")
