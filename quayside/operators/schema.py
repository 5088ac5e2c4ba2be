"""Schemas: normalise, compare, merge, and fit a batch to a table."""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.errors import SchemaConflict
from quayside.functions.clock import epoch_millis
from quayside.functions.naming import named
from quayside.session import small_frame

# The digits of the longest decimal.
MOST_DIGITS = 38

# The only types that widen besides decimals, narrow to wide.
_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
WIDENINGS = {
    **{(a, b): b for i, a in enumerate(_WHOLE) for b in _WHOLE[i + 1 :]},
    (T.FloatType(), T.DoubleType()): T.DoubleType(),
}

DIFF_SCHEMA = "field string, source_type string, target_type string, action string"


def normalise(df: DataFrame) -> DataFrame:
    """Lower-case column names; names that differ by case only are an error."""
    _check_case(df.schema)
    return df.toDF(*(name.lower() for name in df.columns))


def normalised_schema(schema: T.StructType, table: str | None = None) -> T.StructType:
    """Lower-case names, every field nullable; with a table name, each field notes its origin."""
    _check_case(schema)
    note = {"comment": f"Import of {table}"} if table else None
    return T.StructType(
        [T.StructField(f.name.lower(), _all_nullable(f.dataType), True, note) for f in schema]
    )


def flatten_types(df: DataFrame) -> DataFrame:
    """Times as epoch milliseconds and decimals as text, for readers that know plain types only."""

    def plain(field: T.StructField) -> Column:
        col = named(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return col.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return epoch_millis(col, field.dataType).alias(field.name)
        return col

    return df.select(*(plain(f) for f in df.schema))


def merge_schemas(source: T.StructType, target: T.StructType) -> T.StructType:
    """Fields of both: the target's order first, then the fields new in the source.

    Names match without regard to case. A field on both sides must have the same type or
    one that widens; a field on one side stays. All come out nullable.
    """
    return _merge_structs(source, target, "")


def diff_schemas(source: T.StructType, target: T.StructType) -> list[tuple[str, str, str, str]]:
    """One (field, source type, target type, action) per field of the merged schema.

    The action is `same`, `added` (new in the source), `kept` (target only), `widened`
    (the target has to change) or `fitted` (the batch is cast to the target's type).
    """
    in_source = {f.name.lower(): f.dataType for f in source}
    in_target = {f.name.lower(): f.dataType for f in target}
    rows = []
    for field in merge_schemas(source, target):
        old, new = in_target.get(field.name), in_source.get(field.name)
        if old is None:
            action = "added"
        elif new is None:
            action = "kept"
        elif _all_nullable(old) != field.dataType:
            action = "widened"
        elif _all_nullable(new) != field.dataType:
            action = "fitted"
        else:
            action = "same"
        rows.append(
            (
                field.name,
                new.simpleString() if new is not None else None,
                old.simpleString() if old is not None else None,
                action,
            )
        )
    return rows


def schema_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """`diff_schemas` of two frames, as a frame."""
    rows = diff_schemas(source.schema, target.schema)
    return small_frame(source.sparkSession, rows, DIFF_SCHEMA)


def values_per_field(df: DataFrame) -> DataFrame:
    """How many rows hold a value in each field: (field, n_values)."""
    counted = df.agg(*(F.count(named(c)).alias(c) for c in df.columns))
    pairs = (
        F.struct(F.lit(c.lower()).alias("field"), named(c).alias("n_values"))
        for c in df.columns
    )
    return counted.select(F.inline(F.array(*pairs)))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of `schema` in its order, cast to its types, null where `df` has none.

    Raises when a value might not survive: a column the schema lacks, or a type that does
    not widen to the schema's.
    """
    present = {f.name.lower(): f for f in df.schema}
    _check_case(df.schema)
    for name in present.keys() - {f.name.lower() for f in schema}:
        raise SchemaConflict(name, "not in the target schema")
    return df.select(
        *(
            _fit(
                named(present[f.name.lower()].name) if f.name.lower() in present else None,
                present[f.name.lower()].dataType if f.name.lower() in present else None,
                f.dataType,
                f.name,
            ).alias(f.name)
            for f in schema
        )
    )


def fits_as_is(batch: T.StructType, schema: T.StructType) -> bool:
    """True if files of `batch` read under `schema` as they are: each column is there under the
    same name and with the same type. Columns that the files lack read as null."""
    wanted = {f.name: _all_nullable(f.dataType) for f in schema}
    return all(wanted.get(f.name) == _all_nullable(f.dataType) for f in batch)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames under their merged schema."""
    merged = reduce(lambda target, df: merge_schemas(df.schema, target), frames, T.StructType([]))
    return reduce(DataFrame.unionByName, (conform(df, merged) for df in frames))


def _check_case(schema: T.StructType) -> None:
    for name, count in Counter(f.name.lower() for f in schema).items():
        if count > 1:
            raise SchemaConflict(name, "names differ by case only")


def _all_nullable(data_type: T.DataType) -> T.DataType:
    if isinstance(data_type, T.StructType):
        return T.StructType(
            [T.StructField(f.name, _all_nullable(f.dataType), True, f.metadata) for f in data_type]
        )
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_all_nullable(data_type.elementType), True)
    if isinstance(data_type, T.MapType):
        return T.MapType(data_type.keyType, _all_nullable(data_type.valueType), True)
    return data_type


def _merge_structs(source: T.StructType, target: T.StructType, path: str) -> T.StructType:
    _check_case(source)
    _check_case(target)
    incoming = {f.name.lower(): f for f in source}
    merged = []
    for field in target:
        name = field.name.lower()
        other = incoming.pop(name, None)
        data_type = (
            _all_nullable(field.dataType)
            if other is None
            else _merge_types(other.dataType, field.dataType, path + name)
        )
        merged.append(T.StructField(name, data_type, True, field.metadata))
    for name, field in incoming.items():
        merged.append(T.StructField(name, _all_nullable(field.dataType), True, field.metadata))
    return T.StructType(merged)


def _merge_types(source: T.DataType, target: T.DataType, path: str) -> T.DataType:
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        return _merge_structs(source, target, path + ".")
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return T.ArrayType(_merge_types(source.elementType, target.elementType, path), True)
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        key = _merge_types(source.keyType, target.keyType, path)
        return T.MapType(key, _merge_types(source.valueType, target.valueType, path), True)
    if source == target:
        return target
    wider = _wider(source, target)
    if wider is None:
        raise SchemaConflict(
            path, f"cannot merge {source.simpleString()} with {target.simpleString()}"
        )
    return wider


def _wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds every value of both, none if there is none.

    Of decimals it has the more digits before the point and the more behind it, up to the 38
    that a decimal can have.
    """
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        precision = scale + max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(precision, scale) if precision <= MOST_DIGITS else None
    return WIDENINGS.get((a, b)) or WIDENINGS.get((b, a))


def _fit(col: Column | None, given: T.DataType | None, wanted: T.DataType, path: str) -> Column:
    """`col` of type `given` as type `wanted`, matching nested fields by name."""
    if col is None:
        return F.lit(None).cast(wanted)
    if _all_nullable(given) == _all_nullable(wanted):
        return col
    if isinstance(given, T.StructType) and isinstance(wanted, T.StructType):
        inner = {f.name.lower(): f for f in given}
        for name in inner.keys() - {f.name.lower() for f in wanted}:
            raise SchemaConflict(f"{path}.{name}", "not in the target schema")
        fields = [
            _fit(
                col.getField(inner[f.name.lower()].name) if f.name.lower() in inner else None,
                inner[f.name.lower()].dataType if f.name.lower() in inner else None,
                f.dataType,
                f"{path}.{f.name}",
            ).alias(f.name)
            for f in wanted
        ]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(given, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(
            col, lambda item: _fit(item, given.elementType, wanted.elementType, path)
        )
    if isinstance(given, T.MapType) and isinstance(wanted, T.MapType):
        keyed = F.transform_keys(col, lambda k, _: _fit(k, given.keyType, wanted.keyType, path))
        return F.transform_values(
            keyed, lambda _, v: _fit(v, given.valueType, wanted.valueType, path)
        )
    if _wider(given, wanted) != wanted:
        raise SchemaConflict(
            path, f"cannot store {given.simpleString()} as {wanted.simpleString()}"
        )
    return col.cast(wanted)
