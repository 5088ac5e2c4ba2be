import pytest

from conftest import rows
from quayside.errors import LandingMissing, SchemaConflict, UnsupportedLayout
from quayside.plans import load
from quayside.session import child_names, path_exists


@pytest.fixture
def place(spark, tmp_path, database):
    """Lands and loads one batch into table `t` of a fresh database."""

    def put(df, run_id, check_col=None):
        landing = f"{tmp_path}/landing/{run_id}"
        landed = load.land(df, landing, check_col)
        target = load.ensure_target(spark, database, "t", f"{tmp_path}/target", df.schema)
        path = load.table_path(f"{tmp_path}/target", database, "t")
        loaded = load.load(spark, landing, target, path, run_id)
        load.clean_up(spark, landing)
        assert not path_exists(spark, landing)
        return landed, loaded

    put.table = f"{database}.t"
    put.path = f"{tmp_path}/target/{database}/t"
    return put


def test_counts_and_mark_come_from_the_write(spark, place):
    landed, loaded = place(spark.range(100).withColumnRenamed("id", "ID"), "r1", "ID")
    assert (landed.n_rows, landed.mark, loaded.n_rows) == (100, "99", 100)
    assert spark.table(place.table).columns == ["id"]


def test_empty_batch(spark, place):
    landed, loaded = place(spark.range(0), "r1", "id")
    assert (landed.n_rows, landed.mark, loaded.n_rows) == (0, None, 0)
    assert spark.table(place.table).count() == 0


def test_landed_files_are_snappy_and_text_is_clean(spark, tmp_path):
    load.land(spark.createDataFrame([("a\nb",)], "S string"), f"{tmp_path}/l")
    assert any(n.endswith(".snappy.parquet") for n in child_names(spark, f"{tmp_path}/l"))
    assert rows(spark.read.parquet(f"{tmp_path}/l")) == [("ab",)]


def test_same_run_twice_doubles_nothing(spark, place):
    place(spark.range(5), "r1")
    place(spark.range(7), "r2")
    place(spark.range(7), "r2")
    assert spark.table(place.table).count() == 12


def test_new_column_is_added_in_place(spark, place):
    place(spark.createDataFrame([(1,)], "a int"), "r1")
    place(spark.createDataFrame([(2, "x")], "A int, b string"), "r2")
    place(spark.createDataFrame([(3,)], "a int"), "r3")
    assert rows(spark.table(place.table)) == [(1, None), (2, "x"), (3, None)]


def test_widening_reads_old_files(spark, place):
    place(spark.createDataFrame([(1, 0.5)], "a int, f float"), "r1")
    place(spark.createDataFrame([(2**40, 1e300, "n")], "a bigint, f double, b string"), "r2")
    place(spark.createDataFrame([(3, 0.25)], "a int, f float"), "r3")
    table = spark.table(place.table)
    assert table.schema.simpleString() == "struct<a:bigint,f:double,b:string>"
    assert rows(table) == [(1, 0.5, None), (3, 0.25, None), (2**40, 1e300, "n")]


def test_nested_fields_evolve(spark, place):
    place(spark.sql("SELECT 1 AS k, named_struct('x', 1) AS s, array(1) AS a"), "r1")
    place(spark.sql("SELECT 2 AS k, named_struct('y', 'q', 'x', 5L) AS s, array(2L) AS a"), "r2")
    assert rows(spark.table(place.table).select("k", "s.x", "s.y", "a")) == [
        (1, 1, None, [1]), (2, 5, "q", [2]),
    ]


def test_a_conflict_leaves_the_table_alone(spark, place):
    place(spark.createDataFrame([(1,)], "a int"), "r1")
    with pytest.raises(SchemaConflict):
        place(spark.createDataFrame([("x",)], "a string"), "r2")
    assert rows(spark.table(place.table)) == [(1,)]


def test_a_table_the_catalogue_lost_keeps_its_fields(spark, place):
    place(spark.createDataFrame([(1, "x")], "a bigint, b string"), "r1")
    spark.sql(f"DROP TABLE {place.table}")
    place(spark.createDataFrame([(2,)], "a int"), "r2")
    assert rows(spark.table(place.table)) == [(1, "x"), (2, None)]


def test_table_and_columns_are_commented(spark, place):
    place(spark.range(1), "r1")
    described = {r["col_name"]: r for r in spark.sql(f"DESCRIBE EXTENDED {place.table}").collect()}
    assert described["Comment"]["data_type"] == "Import of t"
    assert described["id"]["comment"] == "Import of t"
    assert described["Type"]["data_type"] == "EXTERNAL"


def test_missing_landing_and_strange_layout_raise(spark, place, tmp_path):
    place(spark.range(1), "r1")
    with pytest.raises(LandingMissing):
        load.load(spark, f"{tmp_path}/none", place.table, place.path, "r2")
    with pytest.raises(UnsupportedLayout):
        load.load(spark, f"{tmp_path}/none", place.table, place.path, "r2", layout="text")


def test_unknown_schema_change_is_none(spark, place):
    place(spark.range(1), "r1")
    assert not load.evolve_target(spark, place.table, place.path, spark.range(1).schema)


def test_decimals_widen_over_old_files(spark, place):
    steps = ["decimal(5,1)", "decimal(12,2)", "decimal(20,4)", "decimal(7,3)"]
    for i, kind in enumerate(steps):
        place(spark.sql(f"SELECT {i} AS k, CAST('-12.5' AS {kind}) AS x, array(CAST(3 AS {kind})) AS a"), f"r{i}")
    table = spark.table(place.table)
    assert table.schema.simpleString() == "struct<k:int,x:decimal(20,4),a:array<decimal(20,4)>>"
    assert rows(table.selectExpr("k", "CAST(x AS double)", "CAST(a[0] AS double)")) == [
        (i, -12.5, 3.0) for i in range(4)
    ]
    with pytest.raises(SchemaConflict):
        place(spark.sql("SELECT 9 AS k, CAST(1 AS decimal(38,0)) AS x, array(CAST(3 AS decimal(5,1))) AS a"), "r9")


def test_a_batch_of_the_tables_types_is_moved(spark, place, tmp_path):
    place(spark.createDataFrame([(1, "x")], "a bigint, b string"), "r1")
    for run_id, df, moved in (
        ("r2", spark.createDataFrame([("y", 2)], "B string, a bigint"), True),  # another order
        ("r3", spark.createDataFrame([(3,)], "a bigint"), True),  # a column less
        ("r4", spark.createDataFrame([(4, "z")], "a int, b string"), False),  # a narrower type
    ):
        landing = f"{tmp_path}/landing/{run_id}"
        load.land(df, landing)
        landed = {n for n in child_names(spark, landing) if n.startswith("part-")}
        assert load.load(spark, landing, place.table, place.path, run_id).n_rows == 1
        loaded = {n for n in child_names(spark, f"{place.path}/run-{run_id}") if n.startswith("part-")}
        assert (landed == loaded, path_exists(spark, landing)) == (moved, not moved)
    assert rows(spark.table(place.table)) == [(1, "x"), (2, "y"), (3, None), (4, "z")]


def test_a_move_replaces_what_the_run_had_loaded(spark, place):
    place(spark.range(5), "r1")
    place(spark.range(100, 103), "r2")
    place(spark.range(200, 202), "r2")
    assert rows(spark.table(place.table)) == [(i,) for i in [*range(5), 200, 201]]

