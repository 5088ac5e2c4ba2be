"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quayside.operators import keyed


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    name
    for name in entry.queries()
    if name
    not in {"import_database", "initialise_database", "resume_import", "evolve_load", "stream_import",
                    "evolve_decimals", "import_keyless"}
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    for unwanted in ("Python", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


@pytest.mark.parametrize(
    "name, pushed, read",
    [
        ("optional_search", "EqualTo(event_type,error)", "event_id"),
        ("point_lookup", "EqualTo(o_orderkey,1000)", "o_orderkey"),
        ("split_report", "IsNotNull(o_orderkey)", "struct<o_orderkey:bigint>"),
        ("upsert_latest", "In(event_type, [click,view])", "struct<user_id:bigint,event_type:string>"),
        ("delete_cascade", "EqualTo(c_mktsegment,FURNITURE)", "struct<o_orderkey:bigint,o_custkey:bigint>"),
        ("null_substitute", "IsNotNull(doc_id)", "struct<doc_id:bigint>"),
        ("key_exists", "IsNotNull(doc_id)", "struct<doc_id:bigint,lang:string>"),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, sf_dir, name, pushed, read):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    assert pushed in plan and read in plan


@pytest.mark.parametrize(
    "name",
    ["drop_delimiters", "epoch_flatten", "conform_append", "property_stack", "json_listing",
     "spec_parse", "optional_search", "unescape_text"],
)
def test_row_wise_work_does_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan_of(entry.queries()[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["upsert_latest", "changed_values", "property_read", "run_log_fold", "run_log_view"])
def test_groups_are_combined_before_the_shuffle(spark, sf_dir, name):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    assert "partial_" in plan and "Window" not in plan


@pytest.mark.parametrize("name", ["upsert_latest", "changed_values", "property_read"])
def test_fixed_width_columns_stay_in_the_hash_aggregate(spark, sf_dir, name):
    assert "SortAggregate" not in plan_of(entry.queries()[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["batch_groups", "sliding_groups"])
def test_rows_are_windowed_by_slice(spark, sf_dir, name):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    windows = re.findall(r"Window \[(.*)\], \[(.*)\], \[(.*)\]\n", plan)
    over_rows = [by for what, by, _ in windows if "sum(_n#" not in what]
    assert over_rows and all("_slice#" in by or "_block#" in by for by in over_rows)
    # The one window over a whole key sees one row per slice, made by an aggregate.
    (over_counts,) = [by for what, by, _ in windows if "sum(_n#" in what]
    assert "," not in over_counts


SKEW_SETTINGS = {
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
}


@pytest.fixture
def skew_settings(spark):
    before = {key: spark.conf.get(key, None) for key in SKEW_SETTINGS}
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize(
    "operate",
    [
        lambda df, keys: keyed.delete(df, keys, ["k"])[0],
        lambda df, keys: keyed.delete(df, keys, ["k"])[1],
        lambda df, keys: keyed.with_found(df, keys, ["k"]),
        lambda df, keys: keyed.update(df, keys.withColumn("x", F.lit(0.0)), ["k"])[0],
        lambda df, keys: keyed.with_children(keys, df, ["k"]),
    ],
    ids=["kept", "deleted", "found", "updated", "children"],
)
def test_joins_split_a_hot_key(spark, skew_settings, operate):
    rows = spark.range(0, 200_000, 1, 8)
    hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    df = rows.select(hot.alias("k"), F.rand(1).alias("x"))
    keys = spark.range(-1, 1000, 2).withColumnRenamed("id", "k")
    execution = operate(df, keys)._jdf.queryExecution()
    execution.toRdd().count()
    final = execution.executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin(skew=true)" in final
