import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from quayside.errors import SchemaConflict
from quayside.operators import schema


def ddl(text):
    return T.StructType.fromDDL(text)


def test_normalise_lowers_names(spark):
    assert schema.normalise(spark.createDataFrame([(1, 2)], "Id int, NAME int")).columns == ["id", "name"]


def test_names_differing_by_case_only_are_refused(spark):
    df = spark.sql("SELECT 1 AS id, 2 AS Id")
    with pytest.raises(SchemaConflict, match="id"):
        schema.normalise(df)


def test_normalised_schema_is_nullable_and_noted():
    given = T.StructType([T.StructField("ID", T.LongType(), False)])
    (field,) = schema.normalised_schema(given, "orders")
    assert (field.name, field.nullable, field.metadata) == ("id", True, {"comment": "Import of orders"})


def test_merge_of_a_schema_with_itself_changes_nothing():
    given = ddl("a int, b struct<x: int, y: array<double>>, c map<string, float>")
    assert schema.merge_schemas(given, given) == given


def test_merge_keeps_target_order_and_appends_new_fields():
    merged = schema.merge_schemas(ddl("z int, B bigint, a double"), ddl("a float, b int, k string"))
    assert merged == ddl("a double, b bigint, k string, z int")


def test_merge_goes_into_nested_types():
    merged = schema.merge_schemas(
        ddl("s struct<x: bigint, y: string>, a array<int>, m map<string, double>"),
        ddl("s struct<x: int>, a array<bigint>, m map<string, float>"),
    )
    assert merged == ddl("s struct<x: bigint, y: string>, a array<bigint>, m map<string, double>")


@pytest.mark.parametrize(
    "source, target, field",
    [
        ("a int", "a string", "a"),
        ("a bigint", "a double", "a"),
        ("s struct<x: int>", "s struct<x: string>", "s.x"),
        ("a decimal(38,0)", "a decimal(38,1)", "a"),
    ],
)
def test_types_that_do_not_widen_conflict(source, target, field):
    with pytest.raises(SchemaConflict) as error:
        schema.merge_schemas(ddl(source), ddl(target))
    assert error.value.field == field


def test_diff_names_every_action(spark):
    source = spark.createDataFrame([], "Key bigint, same string, fresh date, slim int")
    target = spark.createDataFrame([], "key int, same string, gone int, slim bigint")
    assert rows(schema.schema_diff(source, target)) == [
        ("fresh", "date", None, "added"),
        ("gone", None, "int", "kept"),
        ("key", "bigint", "int", "widened"),
        ("same", "string", "string", "same"),
        ("slim", "int", "bigint", "fitted"),
    ]


def test_conform_orders_casts_and_fills(spark):
    df = spark.sql("SELECT 'n' AS Name, CAST(1 AS int) AS k, named_struct('y', 2, 'x', 1) AS s")
    out = schema.conform(df, ddl("k bigint, gone string, name string, s struct<x: bigint, y: int, z: int>"))
    assert out.first() == (1, None, "n", (1, 2, None))
    assert out.schema.simpleString() == (
        "struct<k:bigint,gone:string,name:string,s:struct<x:bigint,y:int,z:int>>"
    )


def test_conform_keeps_null_structs_null(spark):
    df = spark.createDataFrame([(None,), ((1,),)], "s struct<x: int>")
    out = schema.conform(df, ddl("s struct<x: bigint>"))
    assert sorted(out.collect(), key=str) == [(None,), ((1,),)]


def test_conform_casts_inside_arrays_and_maps(spark):
    df = spark.sql("SELECT array(1, NULL) AS a, map('k', CAST(1.5 AS float)) AS m")
    out = schema.conform(df, ddl("a array<bigint>, m map<string, double>"))
    assert out.first() == ([1, None], {"k": 1.5})


@pytest.mark.parametrize("batch", ["k bigint, extra int", "k string", "s struct<x: int, y: int>"])
def test_conform_never_loses_values(spark, batch):
    with pytest.raises(SchemaConflict):
        schema.conform(spark.createDataFrame([], batch), ddl("k int, s struct<x: int>"))


def test_union_by_name(spark):
    one = spark.createDataFrame([(1, "a")], "k int, name string")
    two = spark.createDataFrame([(2.5, 2**40)], "x double, K bigint")
    assert rows(schema.union_by_name(one, two)) == [(1, "a", None), (2**40, None, 2.5)]


def test_values_per_field(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "A int, b string")
    assert rows(schema.values_per_field(df)) == [("a", 2), ("b", 1)]


@pytest.mark.parametrize(
    "one, other, merged",
    [
        ("decimal(10,2)", "decimal(12,2)", "decimal(12,2)"),
        ("decimal(10,2)", "decimal(10,4)", "decimal(12,4)"),
        ("decimal(5,0)", "decimal(5,5)", "decimal(10,5)"),
        ("decimal(38,10)", "decimal(20,2)", "decimal(38,10)"),
    ],
)
def test_decimals_merge_to_hold_both(spark, one, other, merged):
    a, b = (T.StructType.fromDDL(f"a {kind}") for kind in (one, other))
    wanted = T.StructType.fromDDL(f"a {merged}")
    assert schema.merge_schemas(a, b) == schema.merge_schemas(b, a) == wanted
    given = spark.createDataFrame([("0.5",), (None,)], "a string")
    for narrow in (a, b):
        df = given.select(F.col("a").cast(narrow["a"].dataType))
        kept = [(r["a"],) for r in df.collect()]
        assert [tuple(r) for r in schema.conform(df, wanted).collect()] == kept
    if wanted not in (a, b):
        with pytest.raises(SchemaConflict):
            schema.conform(given.select(F.col("a").cast(one)), b)
