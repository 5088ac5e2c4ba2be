import random
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from quayside.functions import clock, text
from quayside.operators.schema import flatten_types
from quayside.sources import datasets


def test_drop_delimiters_leaves_other_columns(spark):
    df = spark.createDataFrame([("a\nb\r\x01c", 1), (None, 2)], "`odd name` string, n int")
    assert rows(text.drop_all_delimiters(df)) == [("abc", 1), (None, 2)]


def test_null_and_text_are_exchanged(spark):
    df = spark.createDataFrame([(None, "x"), (3, "")], "n int, s string")
    out = df.select(text.null_to_text(F.col("n")), text.text_to_null(F.col("s")))
    assert sorted(map(tuple, out.collect()), key=str) == [("", "x"), ("3", None)]


def test_escaped_fields_survive_whatever_they_hold(spark, tmp_path):
    pieces = ["\\", ",", "\x02", "\x03", "0", "1", "2", "a", "é", "\n", '"', "'"]
    rng = random.Random(7)
    data = [
        (i, "".join(rng.choices(pieces, k=rng.randint(1, 30))), rng.choice(["b\\", "c,", "\x02"]))
        for i in range(2000)
    ]
    df = spark.createDataFrame(data, "id int, s string, t string")
    datasets.write_escaped(df, str(tmp_path / "text"))
    back = datasets.read_escaped(spark, str(tmp_path / "text"), df.schema)
    expected = sorted((i, s.replace("\n", "") or None, t) for i, s, t in data)
    assert sorted(map(tuple, back.collect())) == expected


def test_long_escaped_line(spark, tmp_path):
    long = "w\\o,rd " * 200_000
    df = spark.createDataFrame([(long, "end\\")], "s string, t string")
    datasets.write_escaped(df, str(tmp_path / "text"))
    assert datasets.read_escaped(spark, str(tmp_path / "text"), df.schema).first() == (long, "end\\")


def test_display_time_round_trip(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 29, 13, 5, 9),)], "t timestamp_ntz")
    shown = df.select(clock.to_display(F.col("t")).alias("s"))
    assert shown.first()[0] == "29-02-2024 13:05:09"
    assert shown.select(clock.from_display(F.col("s")).cast("timestamp_ntz")).first()[0] == datetime(
        2024, 2, 29, 13, 5, 9
    )


def test_flatten_rounds_down_and_ignores_the_session_zone(spark):
    df = spark.createDataFrame(
        [(datetime(1969, 12, 31, 23, 59, 59, 999_999), date(1970, 1, 2), Decimal("1.50"), 7)],
        "t timestamp_ntz, d date, x decimal(5,2), n int",
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert flatten_types(df).first() == (-1, 86_400_000, "1.50", 7)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_flatten_zoned_time(spark):
    df = spark.sql("SELECT timestamp'1970-01-01 00:00:01.999999 UTC' AS t")
    assert flatten_types(df).first() == (1999,)
