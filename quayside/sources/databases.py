"""Databases to import from: Parquet folders, Spark's catalogue, or anything behind JDBC."""

from __future__ import annotations

import logging
import math
from collections.abc import Collection
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from decimal import Decimal
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.errors import SplitNotPossible
from quayside.operators.discovery import AUTO_KEY_MARK
from quayside.operators.groups import GROUP_SIZE
from quayside.operators.profile import find_key
from quayside.session import child_names, small_frame
from quayside.sources.incremental import high_mark, increment
from quayside.sources.late import FOLD, check_type, late_rows
from quayside.sources.ranges import even_cuts, predicates

log = logging.getLogger(__name__)

TABLES_SCHEMA = "table_schema string, table_name string"
COLUMNS_SCHEMA = f"{TABLES_SCHEMA}, column_name string, extra string, last_val string"

# Rows a JDBC read keeps in memory at a time, unless the caller says otherwise.
FETCH_SIZE = "10000"
# About the most rows of one range query.
ROWS_PER_READ = 10_000_000


@dataclass
class LakeDatabase:
    """Tables that Spark reads as files. Subclasses say which there are and how to open one."""

    spark: SparkSession
    name: str

    def table_names(self) -> list[str]:
        raise NotImplementedError

    def table(self, table: str) -> DataFrame:
        raise NotImplementedError

    def schema(self, table: str) -> T.StructType:
        return self.table(table).schema

    def catalogue(self, known: Collection[str] = ()) -> tuple[DataFrame, DataFrame]:
        """Tables not known yet and their key columns. Files mark no key, so one is looked
        for in the rows; known tables are not read again. A table that cannot be read is
        warned of and left out, so that the next look finds it."""
        mark = AUTO_KEY_MARK.strip("%")
        wanted = [name for name in self.table_names() if name not in known]
        unread = []

        def key_of(name: str) -> tuple[str, int] | None:
            try:
                return find_key(self.table(name))
            except (PySparkException, Py4JJavaError):
                log.warning("Table %s of %s cannot be read", name, self.name, exc_info=True)
                unread.append(name)
                return None

        with ThreadPoolExecutor(GROUP_SIZE) as pool:
            by_name = dict(zip(wanted, pool.map(key_of, wanted), strict=True))
        names = [name for name in wanted if name not in unread]
        found = [by_name[name] for name in names]
        keys = [
            (self.name, name, key[0], mark, str(key[1] - 1))
            for name, key in zip(names, found, strict=True)
            if key is not None
        ]
        tables = [(self.name, name) for name in names]
        return (
            small_frame(self.spark, tables, TABLES_SCHEMA),
            small_frame(self.spark, keys, COLUMNS_SCHEMA),
        )

    def high_mark(self, table: str, check_col: str, last: str | None) -> str | None:
        return high_mark(self.table(table), check_col, last)

    def read(
        self,
        table: str,
        split_by: str | None = None,
        mappers: int = 1,
        check_col: str | None = None,
        last: str | None = None,
        high: str | None = None,
    ) -> DataFrame:
        """The whole table, or with a check column the rows in (last, high].

        Files split by themselves; split column and mappers matter to JDBC only.
        """
        df = self.table(table)
        return increment(df, check_col, last, high) if check_col else df


    def late_rows(
        self, table: str, check_col: str, landed: DataFrame, floor: str | None, mark: str
    ) -> DataFrame | None:
        """Rows in (floor, mark] or without a check value that are not landed; none if proved."""
        return late_rows(self.table(table), landed, check_col, floor, mark)


@dataclass
class ParquetDatabase(LakeDatabase):
    """A folder with one Parquet file or directory per table."""

    root: str
    suffix: str = ".parquet"

    def table_names(self) -> list[str]:
        names = child_names(self.spark, self.root)
        return [n.removesuffix(self.suffix) for n in names if n.endswith(self.suffix)]

    def table(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{table}{self.suffix}")


@dataclass
class CatalogDatabase(LakeDatabase):
    """The tables of a database in Spark's own catalogue."""

    def table_names(self) -> list[str]:
        tables = self.spark.catalog.listTables(self.name)
        return sorted(t.name for t in tables if not t.isTemporary)

    def table(self, table: str) -> DataFrame:
        return self.spark.table(f"`{self.name}`.`{table}`")


@dataclass
class JdbcDatabase:
    """A database behind a JDBC url. `options` holds driver, user, password, fetchsize …

    `rows_per_read` is about the most rows that one range query brings; none leaves the number
    of queries to the job's mappers.
    """

    spark: SparkSession
    url: str
    name: str
    options: dict[str, str] = field(default_factory=dict)
    rows_per_read: int | None = ROWS_PER_READ

    @classmethod
    def at(cls, spark: SparkSession, db_type: str, server: str, database: str, **options: str):
        """The database a job spec names."""
        return cls(spark, f"jdbc:{db_type}://{server}/{database}", database, options)

    def _reader(self):
        options = {"fetchsize": FETCH_SIZE, **self.options}
        if self._is_mysql():
            # Without a cursor its driver holds a whole result in memory.
            options = {"useCursorFetch": "true", **options}
        return self.spark.read.format("jdbc").option("url", self.url).options(**options)

    def _is_mysql(self) -> bool:
        return self.url.startswith("jdbc:mysql:")

    def _quoted(self, name: str) -> str:
        quote = "`" if self._is_mysql() else '"'
        return quote + name.replace(quote, quote * 2) + quote

    def table(self, table: str) -> DataFrame:
        return self._reader().option("dbtable", self._quoted(table)).load()

    def schema(self, table: str) -> T.StructType:
        """Column names and types; Spark asks for them without reading rows."""
        return self.table(table).schema

    def catalogue(self, known: Collection[str] = ()) -> tuple[DataFrame, DataFrame]:
        """All tables and columns from the information schema. The filter on the database is a
        column expression, which Spark quotes and pushes down."""
        here = F.col("table_schema") == self.name

        def view(name: str) -> DataFrame:
            df = self._reader().option("dbtable", f"information_schema.{name}").load()
            return df.toDF(*(c.lower() for c in df.columns)).where(here)

        tables = view("tables").select("table_schema", "table_name")
        columns = view("columns").select("table_schema", "table_name", "column_name", "extra")
        return tables, columns.withColumn("last_val", F.lit(None).cast("string"))

    def high_mark(self, table: str, check_col: str, last: str | None) -> str | None:
        """Worked out by the database: only the one value comes back."""
        bounds = self.bounds(table, check_col, check_col, last, None)
        return None if bounds is None else bounds[1]

    def bounds(
        self, table: str, column: str, check_col: str | None, last: str | None, high: str | None
    ) -> tuple[str, str] | None:
        """Smallest and largest value of a column as text, among the rows in (last, high]."""
        query = (
            f"SELECT MIN({self._quoted(column)}) AS lo, MAX({self._quoted(column)}) AS hi "
            f"FROM {self._quoted(table)}{self._where(table, check_col, last, high)}"
        )
        df = self._reader().option("query", query).load()
        low, top = df.select(*(F.col(c).cast("string") for c in df.columns)).first()
        return None if low is None else (low, top)

    def _where(
        self, table: str, check_col: str | None, last: str | None, high: str | None
    ) -> str:
        tests = self._conditions(table, check_col, last, high)
        return f" WHERE {' AND '.join(tests)}" if tests else ""

    def _conditions(
        self, table: str, check_col: str | None, last: str | None, high: str | None
    ) -> list[str]:
        """What rows in (last, high] meet."""
        if not check_col:
            return []
        data_type = check_type(self.table(table), check_col)
        column = self._quoted(check_col)
        tests = [f"{column} > {_sql_literal(last, data_type)}"] if last else []
        return tests + ([f"{column} <= {_sql_literal(high, data_type)}"] if high else [])

    def read(
        self,
        table: str,
        split_by: str | None = None,
        mappers: int = 1,
        check_col: str | None = None,
        last: str | None = None,
        high: str | None = None,
    ) -> DataFrame:
        """The whole table, or with a check column the rows in (last, high].

        With a split column the read runs as range queries side by side, `mappers` of them or
        more where a range would hold more than `rows_per_read` rows. Ranges of numbers hold
        about equally many rows, by counts that the database makes; dates and times are split
        into ranges of one width. Null split values go to the first range and values that turn
        up outside the bounds to the end ranges. Columns of other types raise SplitNotPossible.
        """
        whole = self.table(table)
        reader = self._reader()
        name, bounds = self._quoted(table), None
        if split_by and mappers > 1:
            kind = check_type(whole, split_by)
            if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
                raise SplitNotPossible(f"cannot split '{table}' by '{split_by}' of type {kind.simpleString()}")
            bounds = self.bounds(table, split_by, check_col, last, high)
        if bounds is None:
            df = whole
        elif isinstance(kind, T.NumericType):
            least, top = (math.floor(Decimal(bound)) for bound in bounds)
            where = self._conditions(table, check_col, last, high)
            cuts = even_cuts(
                partial(self._cell_counts, table, split_by, where, least), least, top, mappers, self.rows_per_read
            )
            df = reader.jdbc(self.url, name, predicates=predicates(self._quoted(split_by), cuts))
        else:
            df = reader.option("dbtable", name).options(
                partitionColumn=split_by,
                lowerBound=bounds[0],
                upperBound=bounds[1],
                numPartitions=str(mappers),
            ).load()
        return increment(df, check_col, last, high) if check_col else df

    def cell_query(
        self, table: str, column: str, where: list[str], low: int, width: int, stretches: list[tuple[int, int]] | None
    ) -> str:
        """Rows per cell of a grid that begins at `low`, within stretches of the column."""
        column = self._quoted(column)
        tests = [*where, f"{column} IS NOT NULL"]
        if stretches is not None:
            within = (f"{column} >= {a} AND {column} < {b}" for a, b in stretches)
            tests.append("(" + " OR ".join(within) + ")")
        # By the remainder, as quotients are rounded differently from database to database.
        start = f"FLOOR({column} - MOD({column} - {low}, {width}))"
        inner = f"SELECT {start} AS c FROM {self._quoted(table)} WHERE {' AND '.join(tests)}"
        return f"SELECT c, COUNT(*) AS n FROM ({inner}) AS cells GROUP BY c"

    def _cell_counts(
        self, table: str, column: str, where: list[str], low: int, width: int, stretches: list[tuple[int, int]] | None
    ) -> list[tuple[int, int]]:
        query = self.cell_query(table, column, where, low, width, stretches)
        df = self._reader().option("query", query).load()
        return [(int(start), int(n)) for start, n in df.collect()]

    def range_query(
        self, table: str, check_col: str, floor: str | None, mark: str, low: int, width: int
    ) -> str:
        """The sums that prove a region, worked out by the database: one row per range."""
        column = self._quoted(check_col)
        # By the remainder: a quotient that is not whole is rounded by some databases.
        place = f"MOD({column} - {low}, {width})"
        number = f"FLOOR(({column} - {low} - {place}) / {width})"
        folded = f"MOD({place}, {FOLD})"
        where = self._where(table, check_col, floor, mark)
        inner = f"SELECT {number} AS r, {place} AS p, {folded} AS f FROM {self._quoted(table)}{where}"
        return f"SELECT r, COUNT(*) AS n, SUM(p) AS s, SUM(f * f) AS q FROM ({inner}) AS ranges GROUP BY r"

    def late_rows(
        self, table: str, check_col: str, landed: DataFrame, floor: str | None, mark: str
    ) -> DataFrame | None:
        """Rows in (floor, mark] or without a check value that are not landed; none if proved.

        Whole numbers are compared by sums that the database makes, so only ranges that differ
        are read. For other types the check column itself is read.
        """
        source = self.table(table)
        if not isinstance(check_type(source, check_col), (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return late_rows(source, landed, check_col, floor, mark)
        found = self.bounds(table, check_col, check_col, floor, mark)
        bounds = None if found is None else (int(found[0]), int(found[1]))

        def sums(low: int, width: int) -> DataFrame:
            query = self.range_query(table, check_col, floor, mark, low, width)
            df = self._reader().option("query", query).load()
            names = ("range", "n", "places", "squares")
            kinds = ("long", "long", "decimal(30,0)", "decimal(30,0)")
            return df.select(
                *(F.col(c).cast(k).alias(n) for c, k, n in zip(df.columns, kinds, names, strict=True))
            )

        return late_rows(source, landed, check_col, floor, mark, sums, bounds)


def _sql_literal(value: str, data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return value
    return "'" + value.replace("'", "''") + "'"
