import re
from datetime import datetime
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from quayside.errors import SplitNotPossible
from quayside.sources import datasets
from quayside.sources.databases import CatalogDatabase, JdbcDatabase, ParquetDatabase
from quayside.sources.incremental import high_mark, increment


@pytest.mark.parametrize(
    "ddl, values, last, middle, high",
    [
        ("k bigint", [1, 5, 9, 12, None], "1", "9", "12"),
        ("k double", [1.5, 2.25, 1e300, None], "1.5", "2.25", "1.0E300"),
        ("k string", ["a", "b", "d", None], "a", "b", "d"),
        (
            "k timestamp_ntz",
            [datetime(2024, 1, 1), datetime(2024, 1, 2, 3, 4, 5, 678901), datetime(2025, 1, 1), None],
            "2024-01-01 00:00:00",
            "2024-01-02 03:04:05.678901",
            "2025-01-01 00:00:00",
        ),
    ],
)
def test_increments_follow_on_from_each_other(spark, ddl, values, last, middle, high):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    assert high_mark(df, "k", last) == high
    first, second = increment(df, "k", last, middle), increment(df, "k", middle, high)
    whole = increment(df, "k", last, high)
    assert rows(first.unionAll(second)) == rows(whole) == sorted((v,) for v in values[1:-1])


def test_no_last_value_takes_every_row_with_a_check_value(spark):
    df = spark.createDataFrame([(1,), (None,), (-3,)], "k int")
    assert rows(increment(df, "k", None, high_mark(df, "k"))) == [(-3,), (1,)]


def test_nothing_new(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    assert high_mark(df, "k", "1") is None
    assert increment(df, "k", "1", None).count() == 0


def test_both_bounds_reach_the_scan(spark, sf_dir):
    df = ParquetDatabase(spark, "sf", sf_dir).read("orders", check_col="o_orderkey", last="10", high="90")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderkey,10)" in plan and "LessThanOrEqual(o_orderkey,90)" in plan


def test_parquet_database(spark, sf_dir):
    database = ParquetDatabase(spark, "sf", sf_dir)
    assert "orders" in database.table_names()
    assert database.schema("region").names == ["r_regionkey", "r_name"]
    tables, columns = database.catalogue()
    keys = {r["table_name"]: (r["column_name"], r["last_val"]) for r in columns.collect()}
    assert tables.count() == 14
    assert keys["orders"] == ("o_orderkey", "-1")
    assert "lineitem" not in keys


def test_catalog_database(spark, database):
    spark.sql(f"CREATE DATABASE {database}")
    spark.range(3, 9).write.saveAsTable(f"{database}.a")
    spark.range(3).selectExpr("'x' AS s").write.saveAsTable(f"{database}.b")
    lake = CatalogDatabase(spark, database)
    assert lake.table_names() == ["a", "b"]
    assert rows(lake.catalogue()[1]) == [(database, "a", "id", "auto_increment", "2")]
    assert lake.high_mark("a", "id", "4") == "8"
    assert rows(lake.read("a", check_col="id", last="6", high="8")) == [(7,), (8,)]


def test_jdbc_database_of_a_spec(spark):
    database = JdbcDatabase.at(spark, "mysql", "host:3306", "shop", user="u")
    assert (database.url, database.name) == ("jdbc:mysql://host:3306/shop", "shop")
    assert database.options == {"user": "u"}


class FakeReader:
    """Stands in for spark.read of a JDBC database: notes the options, gives fixed frames."""

    def __init__(self, frames, calls):
        self.frames, self.calls, self.seen = frames, calls, {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **given):
        self.seen.update(given)
        return self

    def load(self):
        self.calls.append(self.seen)
        return self.frames[self.seen.get("dbtable", "bounds")]

    def jdbc(self, url, table, predicates):
        self.calls.append(self.seen | {"url": url, "dbtable": table, "predicates": predicates})
        return self.frames[table]


class FakeSpark:
    def __init__(self, frames):
        self.frames, self.calls = frames, []

    @property
    def read(self):
        return FakeReader(self.frames, self.calls)


def jdbc(spark, url="jdbc:mysql://host/db"):
    frames = {
        "`t`": spark.createDataFrame([(1, "a"), (5, "b"), (None, "c")], "id bigint, name string"),
        "bounds": spark.createDataFrame([(1, 5)], "lo bigint, hi bigint"),
        "information_schema.tables": spark.createDataFrame(
            [("db", "t"), ("other", "t")], "TABLE_SCHEMA string, TABLE_NAME string"
        ),
        "information_schema.columns": spark.createDataFrame(
            [("db", "t", "id", "auto_increment"), ("other", "t", "x", "auto_increment")],
            "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, EXTRA string",
        ),
    }
    fake = FakeSpark(frames)
    return JdbcDatabase(fake, url, "db", {"user": "u", "driver": "d"}), fake.calls


def test_jdbc_split_read_options(spark):
    database, calls = jdbc(spark)
    got = database.read("t", "id", 4, "id", "1", "5")
    assert rows(got) == [(5, "b")]
    bounds = next(c for c in calls if "query" in c)
    assert bounds["query"] == (
        "SELECT MIN(`id`) AS lo, MAX(`id`) AS hi FROM `t` WHERE `id` > 1 AND `id` <= 5"
    )
    read = calls[-1]
    assert (read["fetchsize"], read["useCursorFetch"]) == ("10000", "true")
    assert (read["dbtable"], read["user"], read["url"]) == ("`t`", "u", "jdbc:mysql://host/db")


def test_jdbc_times_are_split_by_width(spark):
    database, calls = jdbc(spark)
    frames = database.spark.frames
    frames["`t`"] = spark.sql("SELECT DATE '2024-01-01' AS d UNION ALL SELECT DATE '2024-03-01'")
    frames["bounds"] = spark.sql("SELECT DATE '2024-01-01' AS lo, DATE '2024-03-01' AS hi")
    assert database.read("t", "d", 4).count() == 2
    read = calls[-1]
    assert (read["partitionColumn"], read["lowerBound"], read["upperBound"], read["numPartitions"]) == (
        "d", "2024-01-01", "2024-03-01", "4",
    )


def test_text_is_no_split_column(spark):
    database, _ = jdbc(spark)
    with pytest.raises(SplitNotPossible, match="'name' of type string"):
        database.read("t", "name", 4)
    assert database.read("t", "name", 1).count() == 3


class QueryReader(FakeReader):
    """Answers queries and conditions by Spark's own SQL, over views."""

    def load(self):
        self.calls.append(self.seen)
        spark = self.frames
        return spark.sql(self.seen["query"]) if "query" in self.seen else spark.table(self.seen["dbtable"])

    def jdbc(self, url, table, predicates):
        self.calls.append(self.seen | {"predicates": predicates})
        parts = [self.frames.table(table).where(p).withColumn("part", F.lit(i)) for i, p in enumerate(predicates)]
        return reduce(DataFrame.unionByName, parts)


class QuerySpark(FakeSpark):
    @property
    def read(self):
        return QueryReader(self.frames, self.calls)


def uneven(spark, kind):
    """A third of the rows has one key, most others lie far above the rest; some have none."""
    keys = [7] * 300 + list(range(-50, 50)) + [10**12 + 3 * i for i in range(600)] + [None] * 9
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k bigint, i int")
    df.select(F.col("k").cast(kind), "i").createOrReplaceTempView("uneven")
    fake = QuerySpark(spark)
    return JdbcDatabase(fake, "jdbc:mysql://h/d", "d"), fake.calls, keys


@pytest.mark.parametrize("kind", ["bigint", "decimal(20,2)", "double"])
def test_uneven_keys_make_even_reads(spark, kind):
    database, calls, keys = uneven(spark, kind)
    got = database.read("uneven", "k", 10)
    assert sorted(r["i"] for r in got.select("i").collect()) == list(range(len(keys)))  # each row once
    sizes = sorted(r["count"] for r in got.groupBy("part").count().collect())
    assert sizes[-1] < 300 + 2 * 100 + 9 and sizes[-2] <= 200 and len(sizes) >= 8
    # Counts of cells come back, never rows.
    assert all("COUNT(*)" in c["query"] or "MIN(" in c["query"] for c in calls if "query" in c)


def test_ranges_as_text(spark):
    database, calls, _ = uneven(spark, "bigint")
    database.read("uneven", "k", 4)
    predicates = calls[-1]["predicates"]
    cuts = [int(x) for p in predicates for x in re.findall(r">= (-?\d+)", p)]
    assert predicates[0] == f"`k` < {cuts[0]} OR `k` IS NULL" and predicates[-1] == f"`k` >= {cuts[-1]}"
    assert predicates[1:-1] == [f"`k` >= {a} AND `k` < {b}" for a, b in zip(cuts, cuts[1:])]


def test_more_reads_for_more_rows(spark):
    database, calls, _ = uneven(spark, "bigint")
    database.rows_per_read = 20
    got = database.read("uneven", "k", 2)
    sizes = sorted(r["count"] for r in got.groupBy("part").count().collect())
    assert len(calls[-1]["predicates"]) >= 1000 // 40 and sizes[-2] <= 40


def test_split_reads_keep_to_the_increment(spark):
    database, calls, keys = uneven(spark, "bigint")
    got = database.read("uneven", "k", 6, "k", "7", str(10**12 + 30))
    assert sorted(r["k"] for r in got.collect()) == sorted(k for k in keys if k is not None and 7 < k <= 10**12 + 30)
    assert all("`k` > 7 AND `k` <= 1000000000030" in c["query"] for c in calls if "query" in c)


def test_jdbc_whole_table_in_one_read(spark):
    database, calls = jdbc(spark)
    assert database.read("t").count() == 3
    assert "partitionColumn" not in calls[-1]
    assert database.schema("t").names == ["id", "name"]


def test_jdbc_high_mark_comes_from_the_database(spark):
    database, calls = jdbc(spark)
    assert database.high_mark("t", "id", None) == "5"
    assert calls[-1]["query"] == "SELECT MIN(`id`) AS lo, MAX(`id`) AS hi FROM `t`"


def test_jdbc_text_marks_are_quoted(spark):
    database, calls = jdbc(spark)
    database.high_mark("t", "name", "o'x")
    assert calls[-1]["query"].endswith("WHERE `name` > 'o''x'")


def test_jdbc_catalogue_keeps_to_its_database(spark):
    database, _ = jdbc(spark)
    tables, columns = database.catalogue()
    assert rows(tables) == [("db", "t")]
    assert rows(columns) == [("db", "t", "id", "auto_increment", None)]


def test_missing_landing_is_none(spark, tmp_path):
    assert datasets.open_landing(spark, str(tmp_path / "none")) is None


@pytest.mark.parametrize("data_format", ["parquet", "orc", "json"])
def test_dataset_is_created_once_then_opened(spark, tmp_path, data_format):
    schema, path = T.StructType.fromDDL("a int, b string"), str(tmp_path / "d")
    assert datasets.create_dataset(spark, path, schema, data_format).count() == 0
    spark.createDataFrame([(1, "x")], schema).write.format(data_format).mode("append").save(path)
    assert rows(datasets.create_dataset(spark, path, schema, data_format)) == [(1, "x")]


def test_csv_without_header(spark, tmp_path):
    df = spark.createDataFrame([(1, 'q"u,o', None), (2, "", 0.1)], "a int, s string, x double")
    datasets.write_csv(df, str(tmp_path / "csv"))
    back = datasets.read_csv(spark, str(tmp_path / "csv"), df.schema)
    assert rows(back) == [(1, 'q"u,o', None), (2, None, 0.1)]


def test_missing_csv_directory_only_warns(spark, tmp_path, caplog):
    schema = T.StructType.fromDDL("a int")
    assert datasets.read_csv(spark, str(tmp_path / "none"), schema).count() == 0
    assert "No input directory found" in caplog.text


def test_csv_keeps_line_breaks_and_blanks(spark, tmp_path):
    from quayside.sources import datasets

    frame = spark.createDataFrame([(1, 'a\n5,b"x"'), (2, "  pad\\ "), (3, None), (4, "\r\n")], "id int, t string")
    datasets.write_csv(frame, str(tmp_path / "csv"))
    back = datasets.read_csv(spark, str(tmp_path / "csv"), frame.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, frame.collect()))
