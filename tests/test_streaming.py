from conftest import rows
from quayside.streaming.file_import import land_new_files


def test_each_file_is_landed_once(spark, tmp_path):
    source, landing, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = spark.range(0).withColumnRenamed("id", "ID").schema

    def arrive(low, high):
        spark.range(low, high, 1, 3).withColumnRenamed("id", "ID").write.mode("append").parquet(source)

    for low, high in ((0, 10), (10, 25)):
        arrive(low, high)
        for _ in range(2):
            land_new_files(spark, source, schema, landing, checkpoint, max_files=2)
        assert rows(spark.read.parquet(landing)) == [(i,) for i in range(high)]
    assert spark.read.parquet(landing).columns == ["id"]
