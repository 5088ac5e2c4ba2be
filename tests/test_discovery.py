from conftest import rows
from quayside.operators.discovery import discover_specs


def test_specs_of_a_database(spark):
    tables = spark.createDataFrame(
        [("db", "b"), ("db", "a"), ("other", "a"), ("db", "a")], "table_schema string, table_name string"
    )
    columns = spark.createDataFrame(
        [
            ("db", "a", "id", "auto_increment", None),
            ("db", "a", "name", "", None),
            ("other", "b", "id", "auto_increment", None),
        ],
        "table_schema string, table_name string, column_name string, extra string, last_val string",
    )
    out = discover_specs(tables, columns, "mysql", "host", "db")
    assert [tuple(r) for r in out.collect()] == [
        ("a", "mysql:host:db:a:id:4:id:0"),
        ("b", "mysql:host:db:b::4::0"),
    ]
    assert rows(out) == sorted(map(tuple, out.collect()))


def test_a_key_may_start_elsewhere(spark):
    tables = spark.createDataFrame([("db", "a")], "table_schema string, table_name string")
    columns = spark.createDataFrame(
        [("db", "a", "id", "auto_increment", "-1")],
        "table_schema string, table_name string, column_name string, extra string, last_val string",
    )
    out = discover_specs(tables, columns, "parquet", "local", "db")
    assert out.first()["input"] == "parquet:local:db:a:id:4:id:-1"
