import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quayside.operators import groups, profile


def test_split_counts_add_up_to_the_table(spark):
    df = spark.createDataFrame([(i * i - 50,) for i in range(97)] + [(None,)], "k bigint")
    report = profile.split_report(df, "k", 4).collect()
    assert sum(r["n_rows"] for r in report) == 97
    for r in report:
        inside = df.where((F.col("k") >= r["lower_bound"]) & (F.col("k") < r["upper_bound"]))
        assert inside.count() == r["n_rows"]


def test_split_report_of_huge_keys_is_exact(spark):
    top = 2**62
    df = spark.createDataFrame([(0,), (top - 1,), (top,)], "k bigint")
    report = {r["split_id"]: r["n_rows"] for r in profile.split_report(df, "k", 2).collect()}
    assert report == {0: 1, 1: 2}


def test_split_report_of_nothing(spark):
    assert rows(profile.split_report(spark.createDataFrame([], "k int"), "k", 4)) == []


def test_column_profile(spark):
    df = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (3, None, "c")], "id int, n bigint, s string")
    text = spark.createDataFrame([("a",)], "s string")
    found = profile.column_profile({"t": df, "u": df.limit(0), "text": text})
    assert rows(found) == [("t", "id", 3, 0, 3, 1, 3), ("t", "n", 3, 1, 1, 5, 5)]
    assert [r["column_name"] for r in found.where(profile.is_key(found)).collect()] == ["id"]


@pytest.mark.parametrize(
    "data, found",
    [
        ([(1, 10), (1, 20), (2, 30)], ("b", 10)),  # a repeats
        ([(5, 1), (7, 2), (9, 1)], ("a", 5)),  # first of the unique ones
        ([(1, 7), (9, 7), (None, 7)], None),  # a null, and a constant
        ([(1, 1), (1, 9), (9, 1), (8, 9)], None),  # range is wide, values repeat
        ([], None),
    ],
)
def test_find_key(spark, data, found):
    assert profile.find_key(spark.createDataFrame(data, "a int, b bigint")) == found


def test_distinct_values_are_exact(spark):
    rng = random.Random(5)
    ends = [-(2**63), 2**63 - 1, -1, 0, 63, 64, -64, -65]
    data = [(rng.choice(ends), rng.randrange(-200, 200), None if i % 3 else i) for i in range(900)]
    df = spark.createDataFrame(data, "`a.b` bigint, b int, c bigint").repartition(5)
    found = profile.distinct_values(df, ["a.b", "b", "c"])
    assert found == {"a.b": 8, "b": len({b for _, b, _ in data}), "c": 300}
    assert profile.distinct_values(df.limit(0), ["b"]) == {"b": 0}


def test_keys_of_odd_names(spark):
    df = spark.createDataFrame([(1, 4), (1, 5)], "`a.b` int, `c`` d` bigint")
    assert profile.find_key(df) == ("c` d", 4)
    assert rows(profile.split_report(df, "a.b", 2)) == [(0, 1, 2, 2)]


def test_slices_follow_the_rows():
    assert groups.slices_for(0, 8) == groups.slices_for(150_000, 8) == 1
    assert groups.slices_for(500_000, 8) == 5
    assert groups.slices_for(12_000_000, 8) == 8
    # A fixed setting does not make slices grow with the rows.
    for n in (10**9, 10**11, 10**12):
        assert n / groups.slices_for(n, 200) <= groups.SLICE_ROWS


def test_the_largest_window_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(groups, "SLICE_ROWS", 200)
    df, data = _hot(spark, 4000)
    sliced = groups._with_slice(df, "o", None)
    assert sliced.groupBy("k", "_slice").count().agg(F.max("count")).first()[0] < 400
    expected = sorted(((k, o, i) for k, v in _numbered(data).items() for i, o in enumerate(v, 1)), key=str)
    assert sorted(map(tuple, groups.number_rows(df, ["k"], "o").collect()), key=str) == expected


def _hot(spark, n, seed=1):
    """A third of the rows share one key, and its order values lie close together."""
    rng = random.Random(seed)
    orders = rng.sample(range(n * 50), n)
    data = [("hot" if i < n // 3 else rng.choice(["a", "b", None]), o) for i, o in enumerate(orders)]
    return spark.createDataFrame(data, "k string, o bigint").repartition(7), data


def _numbered(data):
    by_key = {}
    for k, o in data:
        by_key.setdefault(k, []).append(o)
    return {k: sorted(v) for k, v in by_key.items()}


@pytest.mark.parametrize("slices", [1, 3, 64])
def test_numbers_match_brute_force_for_any_slicing(spark, slices):
    df, data = _hot(spark, 2000)
    expected = sorted(
        ((k, o, i) for k, v in _numbered(data).items() for i, o in enumerate(v, 1)), key=str
    )
    out = groups.number_rows(df, ["k"], "o", slices=slices)
    assert sorted(map(tuple, out.collect()), key=str) == expected


def test_no_task_gets_a_hot_key_whole(spark):
    df, data = _hot(spark, 4000)
    sliced = groups._with_slice(df, "o", 20)
    biggest = sliced.groupBy("k", "_slice").count().agg(F.max("count")).first()[0]
    assert biggest < 2 * len(data) / 20


@pytest.mark.parametrize("cast", ["double", "decimal(20,0)", "timestamp", "int"])
def test_numbers_by_other_types(spark, cast):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").cast(cast).alias("o"))
    out = groups.number_rows(df, ["k"], "o", slices=8)
    assert out.groupBy("k").agg(F.max("row_no")).orderBy("k").collect() == [(0, 34), (1, 33), (2, 33)]


def test_rows_cannot_be_sliced_by_text(spark):
    with pytest.raises(TypeError):
        groups.number_rows(spark.createDataFrame([("a", "b")], "k string, o string"), ["k"], "o")


def test_numbers_of_no_rows(spark):
    assert groups.number_rows(spark.createDataFrame([], "k int, o int"), ["k"], "o").count() == 0


def test_disjoint_groups(spark):
    df, data = _hot(spark, 500)
    expected = sorted(
        ((k, o, i // 10) for k, v in _numbered(data).items() for i, o in enumerate(v)), key=str
    )
    out = groups.disjoint_groups(df, ["k"], "o", slices=9)
    assert sorted(map(tuple, out.collect()), key=str) == expected


@pytest.mark.parametrize("block_rows", [10, 13, 100_000])
def test_sliding_groups(spark, block_rows):
    df, data = _hot(spark, 600)
    data.append(("short", 3))
    df = df.unionByName(spark.createDataFrame([("short", 3)], df.schema))
    expected = []
    for k, v in _numbered(data).items():
        for i in range(max(len(v) - 9, 1)):
            expected.append((k, v[i : i + 10][0], v[i : i + 10][-1], len(v[i : i + 10]), v[i : i + 10]))
    out = groups.sliding_groups(df, ["k"], "o", slices=5, block_rows=block_rows)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(expected, key=str)


def test_twelve_rows_give_three_sliding_groups(spark):
    df = spark.range(12).select(F.lit(1).alias("k"), F.col("id").alias("o"))
    assert groups.sliding_groups(df, ["k"], "o").count() == 3
