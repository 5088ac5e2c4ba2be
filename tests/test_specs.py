import pytest
from pyspark.sql import functions as F

from conftest import rows
from quayside.functions import naming
from quayside.operators.specs import describe_jobs, good_specs, parse_specs, rejected_specs

GOOD = "mysql:localhost:testdb:testtable:id:4:id:0"


def parse(spark, *specs, incremental=True):
    return parse_specs(spark.createDataFrame([(s,) for s in specs], "spec string"), "spec", incremental)


def test_the_eight_fields(spark):
    row = parse(spark, GOOD).first()
    assert [row[f] for f in naming.SPEC_FIELDS] == GOOD.split(":")
    assert row["job_name"] == "mysql:localhost:testdb:testtable"
    assert row["spec_error"] is None


def test_job_description(spark):
    row = describe_jobs(good_specs(parse(spark, GOOD)), "/data/lz").first()
    assert row["connect_string"] == "jdbc:mysql://localhost/testdb"
    assert row["target_dir"] == "/data/lz/localhost/testdb/testtable"
    assert row["enabled"] is True


def test_no_split_column_means_disabled(spark):
    row = describe_jobs(good_specs(parse(spark, "mysql:host:db:t::4::0")), "/lz").first()
    assert (row["split_by"], row["check_col"], row["enabled"]) == ("", "", False)


def test_a_port_belongs_to_the_server(spark):
    row = describe_jobs(parse(spark, "mysql:h:3306:d:t:id:4:id:0"), "/lz").first()
    assert (row["server"], row["database"], row["table"], row["last_val"]) == ("h:3306", "d", "t", "0")
    assert (row["job_name"], row["spec_error"]) == ("mysql:h:3306:d:t", None)
    assert row["connect_string"] == "jdbc:mysql://h:3306/d"
    assert row["target_dir"] == "/lz/h_3306/d/t"  # no colon in a path
    plain = parse(spark, "mysql:h:3306:d:t:id:4", incremental=False).first()
    assert (plain["server"], plain["mappers"], plain["spec_error"]) == ("h:3306", "4", None)


@pytest.mark.parametrize(
    "spec, error",
    [
        ("mysql:h:d:t:id:4:id", "expected 8 fields, found 7"),
        ("mysql:h:d:t:id:4:id:", "expected 8 fields, found 7"),
        ("mysql:h:d:t:id:4:id:0:9", "expected 8 fields, found 9"),
        ("mysql:h:d:t:id:four:id:0", "mappers is not a number"),
        ("mysql:h:3306:d:t:id:4:id", "expected 8 fields, found 7"),
        ("mysql:h:3306:d:t:id:4:id:0:9:9:9:9:9", "expected 8 fields, found 13"),
        (None, "no spec"),
    ],
)
def test_bad_specs_are_rejected(spark, spec, error):
    parsed = parse(spark, spec, GOOD)
    assert rows(rejected_specs(parsed, "spec")) == [(spec, error)]
    assert good_specs(parsed).count() == 1


def test_plain_spec_ignores_check_column(spark):
    parsed = parse(spark, GOOD, "mysql:h:d:t:id:4", "mysql:h:d:t:id", incremental=False)
    good = good_specs(parsed)
    assert rows(good.select("check_col", "last_val")) == [("", ""), ("", "")]
    assert rows(rejected_specs(parsed, "spec")) == [
        ("mysql:h:d:t:id", "expected at least 6 fields, found 5")
    ]


def test_names_and_connections_both_ways(spark):
    df = spark.createDataFrame([("mysql", "db-1.host:3306", "Shop", "t")], "a string, s string, d string, t string")
    connection = naming.connect_string(F.col("a"), F.col("s"), F.col("d"))
    row = df.select(
        connection,
        naming.job_name_of_connection(connection, F.col("t")),
        naming.config_key(F.col("a"), F.col("s"), F.col("d"), "username"),
        naming.environment_key(F.col("a"), F.col("s"), F.col("d"), "pass"),
        naming.landing_path("/lz", F.col("s"), F.col("d"), F.col("t")),
    ).first()
    assert tuple(row) == (
        "jdbc:mysql://db-1.host:3306/Shop",
        "mysql:db-1.host:3306:Shop:t",
        "mysql.db-1.host:3306.shop.username",
        "MYSQL_DB_1_HOST:3306_SHOP_PASS",
        "/lz/db-1.host:3306/Shop/t",
    )


def test_spec_part_by_name(spark):
    df = spark.createDataFrame([(GOOD,), ("mysql:h",)], "spec string")
    out = df.select(naming.spec_part(naming.spec_parts(F.col("spec")), "table"))
    assert rows(out) == [("testtable",), (None,)]
