"""Job specs: parse, check and describe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions import naming


def parse_specs(df: DataFrame, spec: str, incremental: bool = True) -> DataFrame:
    """Add the eight fields of a spec, its job name, and `spec_error`.

    `spec_error` is null for a good spec. An incremental spec needs exactly eight fields;
    a plain one needs six, and its check column and last value are empty. The number of
    mappers must be a whole number either way.
    """
    parts = F.col("_parts")
    fields = {field: naming.spec_part(parts, field) for field in naming.SPEC_FIELDS}
    if not incremental:
        fields |= {field: F.when(parts.isNotNull(), F.lit("")) for field in ("check_col", "last_val")}
    error = _spec_error(F.size(parts), fields["mappers"], incremental)
    return (
        df.withColumn("_parts", naming.spec_parts(F.col(spec)))
        .withColumns({**fields, "job_name": naming.job_name(parts), "spec_error": error})
        .drop("_parts")
    )


REFUSED_SCHEMA = "input string, spec_error string"


def once_per_job(parsed: DataFrame, spec: str) -> DataFrame:
    """Of the good specs of one job the first by text stays good, of equal ones one row is left."""
    good = F.col("spec_error").isNull()
    first = parsed.where(good).groupBy("job_name").agg(F.min(spec).alias("_first"))
    marked = parsed.dropDuplicates().join(first, "job_name", "left")
    twice = good & (F.col(spec) != F.col("_first"))
    error = F.when(twice, F.lit("another spec of this job comes first")).otherwise(F.col("spec_error"))
    return marked.withColumn("spec_error", error).select(*parsed.columns)


def good_specs(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("spec_error").isNull()).drop("spec_error")


def rejected_specs(parsed: DataFrame, spec: str) -> DataFrame:
    return parsed.where(F.col("spec_error").isNotNull()).select(spec, "spec_error")


def describe_jobs(specs: DataFrame, landing_root: str) -> DataFrame:
    """What a job needs besides its spec fields; it is enabled when it has a split column.

    In its folder the colon of a port, which file systems refuse, becomes `_`.
    """
    folder = F.replace(F.col("server"), F.lit(naming.SPEC_SEPARATOR), F.lit("_"))
    return (
        specs.withColumn(
            "connect_string",
            naming.connect_string(F.col("db_type"), F.col("server"), F.col("database")),
        )
        .withColumn(
            "target_dir",
            naming.landing_path(landing_root, folder, F.col("database"), F.col("table")),
        )
        .withColumn("enabled", F.col("split_by") != "")
    )


def _spec_error(n_fields: Column, mappers: Column, incremental: bool) -> Column:
    if incremental:
        wrong_size = n_fields != len(naming.SPEC_FIELDS)
        expected = f"expected {len(naming.SPEC_FIELDS)} fields"
    else:
        wrong_size = n_fields < 6
        expected = "expected at least 6 fields"
    return (
        F.when(n_fields.isNull() | (n_fields < 0), F.lit("no spec"))
        .when(wrong_size, F.concat(F.lit(f"{expected}, found "), n_fields))
        .when(mappers.try_cast("int").isNull(), F.lit("mappers is not a number"))
    )
