"""Bringing rows to a declared schema: rejects, upsert, inference and schema comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.functions.clean import boolean_value, epoch_ms_to_timestamp, is_json_name, is_time_name, EPOCH_MS_MAX
from starloom.operators.lookup import broadcast_checked, last_per_key, undecided
from starloom.plans.spec import LOAD_TIME
from starloom.session import cut

REJECTS = "_rejects"


def _convert(column: Column, given: T.DataType, wanted: T.DataType) -> Column:
    if isinstance(wanted, T.TimestampType):
        return epoch_ms_to_timestamp(column, given)
    if isinstance(wanted, T.BooleanType):
        return boolean_value(column, given)
    if isinstance(wanted, T.StringType):
        if isinstance(given, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            return F.to_json(column)
        return column.cast("string")
    if isinstance(wanted, T.VariantType):
        return F.try_parse_json(column.cast("string"))
    if given == wanted:
        return column
    return column.try_cast(wanted)


def _out_of_range(column: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """Epoch milliseconds past the year 9999 are stored as NULL, they are no error."""
    if isinstance(wanted, T.TimestampType) and isinstance(given, T.NumericType):
        return column > EPOCH_MS_MAX
    return F.lit(False)


def load_with_rejects(
    df: DataFrame, schema: T.StructType, *, required: Sequence[str] = (), lengths: bool = False
) -> DataFrame:
    """``df`` in the columns and types of ``schema`` plus ``_rejects``, the reasons a row cannot be loaded, or NULL.

    Columns are matched by name in any letter case, others are ignored and absent ones
    read NULL. A value that does not convert, a NULL in a required column and, with
    ``lengths``, a text longer than declared reject the row. It is one pass without shuffle.
    """
    given = {field.name.lower(): field for field in df.schema}
    columns: list[Column] = []
    faults: list[tuple[Column, str]] = []
    for field in schema:
        source = given.get(field.name.lower())
        if source is None:
            value = F.lit(None).cast(field.dataType)
        else:
            raw = F.col(f"`{source.name}`")
            value = _convert(raw, source.dataType, field.dataType)
            if source.dataType != field.dataType:
                failed = raw.isNotNull() & value.isNull() & ~_out_of_range(raw, source.dataType, field.dataType)
                faults.append((failed, f"{field.name}: not {field.dataType.simpleString()}"))
        if field.name in required:
            faults.append((value.isNull(), f"{field.name}: NULL"))
        limit = field.metadata.get("max_length", 0)
        if lengths and limit:
            faults.append((F.coalesce(F.length(value) > limit, F.lit(False)), f"{field.name}: longer than {limit}"))
        columns.append(value.alias(field.name))
    # The reasons are spelled out for faulty rows only; for the others it is one condition.
    found = F.lit(None).cast("array<string>")
    if faults:
        reasons = F.array_compact(F.array(*[F.when(test, F.lit(text)) for test, text in faults]))
        found = F.when(reduce(Column.__or__, [test for test, _ in faults]), reasons)
    return df.select(*columns, found.alias(REJECTS))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REJECTS).isNull()).drop(REJECTS)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REJECTS).isNotNull())


def reject_sample(checked: DataFrame, limit: int = 10) -> DataFrame:
    """A few rejected rows to look at; all of them are in ``rejected``."""
    return rejected(checked).limit(limit)


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """The declared default in each column the source does not have at all."""
    absent = {name: F.lit(value) for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df


def keyed(df: DataFrame, key: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(name).isNotNull() for name in key])


def upsert(existing: DataFrame, new: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """``existing`` with the rows of ``new``: the last row of a key replaces the whole earlier row.

    A NULL in the key never collides, and without a key all rows are added. Only ``new``
    is reduced to one row per key; ``existing`` is read once and loses the replaced rows
    by an anti-join with their keys, which are broadcast if they are small enough.
    """
    names = existing.columns
    if not key:
        return existing.unionByName(new.select(*[c for c in new.columns if c in names]), allowMissingColumns=True)
    last = last_per_key(new.filter(keyed(new, key)), key, order_by)
    replaced = last.select(*key)
    if undecided(replaced):
        last = cut(last)
        replaced = broadcast_checked(last.select(*key))
    kept = existing.join(replaced, list(key), "left_anti")
    added = last.unionByName(new.filter(~keyed(new, key)))
    present = [c for c in added.columns if c in names]
    return kept.select(*names).unionByName(added.select(*present), allowMissingColumns=True)


def infer_target_schema(df: DataFrame) -> T.StructType:
    """A target schema for a table that has no declaration, from the types and names of its columns."""
    fields = []
    for field in df.schema:
        dtype: T.DataType = T.StringType()
        if is_time_name(field.name) or isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            dtype = T.TimestampType()
        elif is_json_name(field.name):
            dtype = T.VariantType()
        elif isinstance(field.dataType, T.BooleanType):
            dtype = T.BooleanType()
        elif isinstance(field.dataType, T.IntegralType):
            dtype = T.LongType()
        elif isinstance(field.dataType, (T.FractionalType, T.DecimalType)):
            dtype = T.DoubleType()
        fields.append(T.StructField(field.name, dtype))
    if LOAD_TIME not in df.columns:
        fields.append(T.StructField(LOAD_TIME, T.TimestampType()))
    return T.StructType(fields)


def _family(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return "text"
    if isinstance(dtype, T.IntegralType):
        return "integer"
    if isinstance(dtype, T.DecimalType):
        return "integer" if dtype.scale == 0 else "decimal"
    return dtype.simpleString()


def compare_schemas(expected: T.StructType, actual: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, status, expected type, actual type) by name in any letter case.

    The status is ``missing``, ``extra``, ``mismatch`` or ``ok``; integers of any width agree.
    """
    wanted = {f.name.lower(): f.dataType for f in expected}
    found = {f.name.lower(): f.dataType for f in actual}
    rows = []
    for name in sorted({*wanted, *found}):
        left, right = wanted.get(name), found.get(name)
        if right is None:
            status = "missing"
        elif left is None:
            status = "extra"
        else:
            status = "ok" if _family(left) == _family(right) else "mismatch"
        rows.append((name, status, left and left.simpleString(), right and right.simpleString()))
    return rows


def schema_diff(spark, expected: T.StructType, actual: T.StructType) -> DataFrame:
    schema = "column string, status string, expected string, actual string"
    return spark.createDataFrame(compare_schemas(expected, actual), schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the columns of ``schema``; absent ones read NULL, values that do not fit too."""
    return load_with_rejects(df, schema).drop(REJECTS)
