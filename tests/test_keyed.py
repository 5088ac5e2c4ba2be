import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quayside.operators import keyed


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")


def test_search_counts_only_given_criteria(base):
    assert rows(keyed.search(base, k=1, v=None)) == [(1, "a")]
    assert keyed.search(base, k=None).count() == 3
    assert keyed.search(base, k=1, v="b").count() == 0


def test_lookup(base):
    assert keyed.lookup(base, k=2).first() == (2, "b")
    assert keyed.lookup(base, k=9).first() is None


def test_emptiness(base):
    assert not keyed.is_empty(base)
    assert keyed.is_empty(keyed.search(base, k=9))


def test_found_flag_does_not_multiply_rows(spark, base):
    other = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(keyed.with_found(base, other, ["k"])) == [
        (1, "a", True), (2, "b", False), (None, "n", False),
    ]


def test_row_ids_depend_on_the_key_only(spark):
    one = spark.createDataFrame([("x", 1)], "k string, n int")
    two = spark.createDataFrame([("x", 2)], "k string, n int")
    ids = [keyed.with_row_id(df, ["k"]).first()["id"] for df in (one, two)]
    assert ids[0] == ids[1]


def test_insert_if_absent(spark, base):
    new = spark.createDataFrame([(2, "z"), (3, "c")], "k int, v string")
    assert rows(keyed.insert_if_absent(base, new, ["k"])) == [
        (1, "a"), (2, "b"), (3, "c"), (None, "n"),
    ]


def test_update_replaces_even_with_null(spark, base):
    updates = spark.createDataFrame([(1, None), (9, "q")], "k int, v string")
    updated, unmatched = keyed.update(base, updates, ["k"])
    assert rows(updated) == [(1, None), (2, "b"), (None, "n")]
    assert rows(unmatched) == [(9, "q")]


def test_delete_parts_kept_and_deleted(spark, base):
    kept, gone = keyed.delete(base, spark.createDataFrame([(1,), (1,), (7,)], "k int"), ["k"])
    assert rows(kept) == [(2, "b"), (None, "n")]
    assert rows(gone) == [(1, "a")]


def test_delete_by_part_of_a_key(spark):
    props = spark.createDataFrame([("j", "a"), ("j", "b"), ("k", "a")], "job string, prop string")
    kept, gone = keyed.delete(props, spark.createDataFrame([("j",)], "job string"), ["job"])
    assert (rows(kept), gone.count()) == ([("k", "a")], 2)


def test_delete_cascade(spark):
    parents = spark.createDataFrame([(1, "x"), (2, "y")], "pk int, p string")
    children = spark.createDataFrame([(10, 1), (11, 2), (12, 1)], "ck int, fk int")
    doomed = parents.where("p = 'x'")
    kept_parents, kept_children = keyed.delete_cascade(parents, children, doomed, "pk", "fk")
    assert rows(kept_parents) == [(2, "y")]
    assert rows(kept_children.select("ck", "fk")) == [(11, 2)]


def test_latest_and_first_with_nulls_and_many_order_columns(spark):
    df = spark.createDataFrame(
        [("a", 1, 2, "x"), ("a", 2, 1, None), ("a", 1, 9, "z"), (None, 5, 5, "n")],
        "k string, t int, s int, v string",
    )
    assert rows(keyed.latest_per_key(df, ["k"], ["t", "s"])) == [("a", 2, 1, None), (None, 5, 5, "n")]
    assert rows(keyed.first_per_key(df, ["k"], ["t", "s"])) == [("a", 1, 2, "x"), (None, 5, 5, "n")]


def test_upsert_is_idempotent_and_matches_brute_force(spark):
    rng = random.Random(3)
    base = {k: (k, rng.random(), -1) for k in range(50)}
    # Key 7 holds a third of all incoming rows.
    incoming = [(7 if rng.random() < 0.33 else rng.randrange(100), rng.random(), i) for i in range(3000)]
    df = spark.createDataFrame(list(base.values()), "k int, v double, seq int")
    new = spark.createDataFrame(incoming, df.schema)
    expected = dict(base)
    expected.update({k: (k, v, s) for k, v, s in incoming})
    once = keyed.upsert(df, new, ["k"], ["seq"])
    assert rows(once) == sorted(expected.values())
    assert rows(keyed.upsert(once, new, ["k"], ["seq"])) == sorted(expected.values())


def test_changed_values(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d"), (5, "e")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c"), (4, None), (6, "f")], "k int, v string")
    assert rows(keyed.changed_values(base, new, ["k"], "v")) == [(2, "b", "B"), (4, "d", None)]


def test_stack_then_read_gives_the_row_back(spark):
    df = spark.createDataFrame([(1, "x", 5), (2, None, 6)], "k int, s string, n int")
    stacked = keyed.stack_properties(df, ["k"], {"name": F.col("s"), "size": F.col("n")}, "options")
    other = stacked.withColumn("prop_class", F.lit("config")).withColumn("prop_val", F.lit("no"))
    back = keyed.read_properties(
        stacked.unionByName(other), ["k"], {"name": "s", "size": "n"}, prop_class="options"
    )
    assert rows(back) == [(1, "x", "5"), (2, None, "6")]


def test_repeated_keys_and_null_orders(spark):
    target = spark.createDataFrame([(1, "old")], "id int, v string")
    batch = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (2, 2, "d")], "id int, o int, v string")
    updated, missing = keyed.update(target, batch, ["id"], ["o"])
    assert rows(updated) == [(1, "b")]
    assert rows(missing.select("id", "v")) == [(2, "d")]
    wide = target.select("id", F.lit(0).alias("o"), "v")
    assert rows(keyed.insert_if_absent(wide, batch, ["id"], ["o"])) == [(1, 0, "old"), (2, 1, "c")]
    dirty = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (2, 5, "c")], "id int, o int, v string")
    assert rows(keyed.latest_per_key(dirty, ["id"], ["o"])) == [(1, None, "a"), (2, 5, "c")]
    assert rows(keyed.first_per_key(dirty, ["id"], ["o", "v"])) == [(1, None, "a"), (2, 5, "c")]


def test_null_keys_match_nothing_and_stay(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    new = spark.createDataFrame([(None, "a"), (None, "b"), (2, "c"), (2, "c"), (1, "z")], "k int, v string")
    for order in (None, ["v"]):
        got = rows(keyed.insert_if_absent(df, new, ["k"], order))
        assert got == [(1, "x"), (2, "c"), (None, "a"), (None, "b"), (None, "y")]
        updated, unmatched = keyed.update(df, new, ["k"], order)
        assert rows(updated) == [(1, "z"), (None, "y")]
        assert rows(unmatched) == [(2, "c"), (None, "a"), (None, "b")]
