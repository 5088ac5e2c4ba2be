"""Rows that come below a mark: found by ranges that differ, and nothing else read or taken."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quayside.sources import late


def frame(spark, values, schema="k long, t string"):
    return spark.createDataFrame(values, schema)


def found(source, landed, check="k", floor=None, mark="100"):
    out = late.late_rows(source, landed, check, floor, mark)
    return None if out is None else rows(out)


def test_equal_sides_are_proved(spark):
    df = frame(spark, [(i, f"t{i}") for i in range(101)])
    assert found(df, df) is None


def test_rows_below_the_mark(spark):
    have = [(i, "old") for i in range(100, 200)]
    new = [(i, "new") for i in range(50, 60)]
    assert found(frame(spark, have + new + [(300, "past")]), frame(spark, have), mark="199") == sorted(new)
    assert found(frame(spark, have + new), frame(spark, have), floor="54", mark="199") == sorted(new[5:])


def test_nothing_landed_and_nothing_there(spark):
    some, none = frame(spark, [(1, "a"), (None, "b")]), frame(spark, [])
    assert found(some, none) == [(1, "a"), (None, "b")]
    assert found(none, some) is None
    assert found(none, none) is None


def test_rows_gone_from_the_source_stay(spark):
    assert found(frame(spark, [(5, "a")]), frame(spark, [(1, "x"), (5, "a"), (7, "y")])) is None


def test_a_value_given_up_for_another_is_seen(spark):
    # Same number of rows and same sum, so only the squares tell.
    source, landed = frame(spark, [(1, "a"), (8, "b"), (9, "c"), (2, "d")]), frame(spark, [(1, "a"), (8, "b"), (7, "e"), (4, "f")])
    late.RANGES, before = 1, late.RANGES
    try:
        assert found(source, landed) == [(2, "d"), (9, "c")]
    finally:
        late.RANGES = before


def test_repeats_come_as_often_as_they_are_missing(spark):
    source = frame(spark, [(1, "a")] * 3 + [(1, "b"), (1, "c"), (2, "x")])
    landed = frame(spark, [(1, "a"), (1, "b"), (2, "x")])
    assert found(source, landed) == [(1, "a"), (1, "a"), (1, "c")]


def test_changed_rows_do_not_come(spark):
    assert found(frame(spark, [(1, "new"), (2, "b")]), frame(spark, [(1, "old"), (2, "b")])) is None


def test_rows_without_a_value(spark):
    source = frame(spark, [(None, "a\n"), (None, "a"), (None, None), (None, "b"), (1, "c")])
    landed = frame(spark, [(None, "a"), (None, None), (1, "c")])
    assert [r[1].strip() for r in found(source, landed)] == ["a", "b"]
    assert found(landed, landed) is None


def test_cleaned_text_wider_types_and_new_columns(spark):
    source = spark.createDataFrame([(1, "a\nb", 7), (1, "c", 8)], "K int, T string, extra int")
    landed = frame(spark, [(1, "ab")])
    assert found(source, landed, "K") == [(1, "c", 8)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "string", "decimal(10,2)", "double"])
def test_other_types(spark, kind):
    start = datetime(2020, 1, 1)
    data = [(str(start + timedelta(days=i)) if "." not in kind and kind not in ("double", "decimal(10,2)") else str(i + 100), i) for i in range(40)]
    df = spark.createDataFrame(data, "v string, n int").select(F.col("v").cast(kind).alias("v"), "n")
    mark = df.agg(F.max("v").cast("string")).first()[0]
    assert late.late_rows(df, df, "v", None, mark) is None
    out = late.late_rows(df, df.where("n % 10 <> 3"), "v", None, mark)
    assert [r["n"] for r in out.orderBy("n").collect()] == [3, 13, 23, 33]


def test_nested_columns_and_odd_names(spark):
    df = spark.range(20).select(
        F.col("id").alias("a.b"), F.array("id").alias("l"), F.create_map(F.lit("k"), "id").alias("m`n"),
        F.struct("id").alias("s"),
    )
    df = df.unionByName(df.where("`a.b` = 3"))
    out = late.late_rows(df, df.where("`a.b` <> 7").dropDuplicates(["a.b"]), "a.b", None, "19")
    assert sorted(r["a.b"] for r in out.collect()) == [3, 7]


def test_wide_values(spark):
    values = [(-(2**63), "a"), (2**63 - 1, "b"), (0, "c")]
    assert found(frame(spark, values), frame(spark, values[:2]), mark=str(2**63 - 1)) == [(0, "c")]


def test_spans_cover_all_numbers_within_their_count():
    rnd = random.Random(3)
    for _ in range(200):
        numbers = sorted(rnd.sample(range(500), rnd.randint(1, 300)))
        out = late.spans(numbers)
        assert len(out) <= late.SPANS
        assert all(any(a <= n <= b for a, b in out) for n in numbers)
        assert out == sorted(out)
    assert late.spans([1, 2, 3, 9]) == [(1, 3), (9, 9)]
    assert late.spans([]) == []


def test_only_differing_ranges_are_read(spark):
    source = spark.range(1_000_000).select(F.col("id").alias("k"))
    out = late.late_rows(source, source.where("k not between 400 and 410"), "k", None, "999999")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "k#" in plan and "<= " in plan
    assert out.count() == 11


def test_a_hot_value_is_no_tasks_load(spark):
    source = spark.range(200_000).select(F.when(F.col("id") < 120_000, 5).otherwise(F.col("id")).alias("k"), (F.col("id") % 7).alias("t"))
    landed = source.where("k <> 5 or t <> 3")
    out = late.late_rows(source, landed, "k", None, "200000")
    assert out.count() == source.where("k = 5 and t = 3").count()


def test_the_database_makes_the_same_sums(spark, monkeypatch):
    import duckdb

    from quayside.sources.databases import JdbcDatabase

    values = [(i * i % 977 - 200,) for i in range(700)] + [(None,), (5,), (5,)]
    df = spark.createDataFrame(values, "`a k` long")
    monkeypatch.setattr(JdbcDatabase, "table", lambda self, name: df)
    connection = duckdb.connect()
    connection.execute('CREATE TABLE "t" ("a k" BIGINT)')
    connection.executemany('INSERT INTO "t" VALUES (?)', values)
    query = JdbcDatabase(spark, "jdbc:other://h/d", "d").range_query("t", "a k", "-150", "600", -149, 37)
    theirs = sorted(tuple(int(x) for x in row) for row in connection.execute(query).fetchall())
    inside = df.where("`a k` > -150 and `a k` <= 600")
    ours = late.range_sums(inside, F.col("`a k`"), late.Ranges(-149, 37))
    assert theirs == sorted(tuple(int(x) for x in row) for row in ours.collect())
