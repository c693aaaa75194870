"""Value cleaning as column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.functions.window import utc

# Limits of the epoch conversion, and the names that mark a column's role.
EPOCH_MS_ABOVE = 10_000_000_000
EPOCH_MS_MAX = 253_402_300_799_000
TIME_SUFFIXES = ("_time", "_at")
TIME_NAMES = ("timestamp",)
BOOLEAN_SUFFIXES = ("_enabled", "_active", "_supported", "_flaky")
BOOLEAN_NAMES = ("success", "deprecated", "auth_enabled", "api_supported")
JSON_SUFFIX = "_json"
JSON_NAMES = (
    "data_json",
    "policy_json",
    "config_json",
    "changes_json",
    "headers_json",
    "metrics_json",
    "metadata_json",
    "new_entity_data",
)


def is_time_name(name: str) -> bool:
    return name.endswith(TIME_SUFFIXES) or name in TIME_NAMES


def is_boolean_name(name: str) -> bool:
    return "is_" in name or name.endswith(BOOLEAN_SUFFIXES) or name in BOOLEAN_NAMES


def is_json_name(name: str) -> bool:
    return name.endswith(JSON_SUFFIX) or name in JSON_NAMES


def to_bool(column: Column, dtype: T.DataType) -> Column:
    """A BIT value as boolean: bytes by their number, numbers by not zero, text by not empty.

    Bytes that went through JSON arrive as text such as ``b'\\x00'`` and keep their meaning.
    """
    if isinstance(dtype, T.BooleanType):
        return column
    if isinstance(dtype, T.BinaryType):
        return F.regexp_replace(F.hex(column), "0", "") != ""
    if isinstance(dtype, T.StringType):
        zero_bytes = column.rlike(r"""^b(['"])(\\x00)*\1$""")
        return (column != "") & ~zero_bytes
    if isinstance(dtype, T.NumericType):
        return column != 0
    return F.when(column.isNotNull(), F.lit(True))


def null_default(column: Column, default: object) -> Column:
    return F.coalesce(column, F.lit(default))


def printable_bytes(column: Column) -> Column:
    """Bytes in printable form, such as ``b'a\\xff'``, with Python's quoting and escapes."""
    digits = F.hex(column)
    codes = F.transform(
        F.sequence(F.lit(1), F.octet_length(column)),
        lambda i: F.conv(F.substring(digits, i * 2 - 1, F.lit(2)), 16, 10).cast("int"),
    )
    single, double = F.array_contains(codes, 39), F.array_contains(codes, 34)
    quote = F.when(single & ~double, F.lit('"')).otherwise(F.lit("'"))

    def show(code: Column) -> Column:
        return (
            F.when(code == 92, F.lit("\\\\"))
            .when(code == 9, F.lit("\\t"))
            .when(code == 10, F.lit("\\n"))
            .when(code == 13, F.lit("\\r"))
            .when((code == 39) & double, F.lit("\\'"))
            .when(code.between(32, 126), F.char(code))
            .otherwise(F.concat(F.lit("\\x"), F.lower(F.lpad(F.hex(code), 2, "0"))))
        )

    return F.concat(F.lit("b"), quote, F.array_join(F.transform(codes, show), ""), quote)


def bytes_to_text(column: Column) -> Column:
    """UTF-8 text where the bytes are valid, else their printable form."""
    text = F.try_validate_utf8(column.cast("string"))
    return F.when(column.isNotNull(), F.coalesce(text, printable_bytes(column)))


def _has_float(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_float(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _has_float(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(_has_float(field.dataType) for field in dtype)
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def sanitize_column(column: Column, dtype: T.DataType) -> Column:
    """NaN and the infinities become NULL, at every depth."""
    if not _has_float(dtype):
        return column
    if isinstance(dtype, T.ArrayType):
        return F.transform(column, lambda item: sanitize_column(item, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(column, lambda _, value: sanitize_column(value, dtype.valueType))
    if isinstance(dtype, T.StructType):
        fields = [sanitize_column(column.getField(f.name), f.dataType).alias(f.name) for f in dtype]
        return F.when(column.isNotNull(), F.struct(*fields))
    # NaN orders above infinity in Spark, so one comparison drops all three.
    return F.when(F.abs(column) < F.lit(float("inf")).cast(dtype), column)


def sanitize(df: DataFrame) -> DataFrame:
    changes = {
        field.name: sanitize_column(F.col(field.name), field.dataType)
        for field in df.schema
        if _has_float(field.dataType)
    }
    return df.withColumns(changes) if changes else df


def epoch_ms_to_timestamp(column: Column, dtype: T.DataType) -> Column:
    """Epoch milliseconds or text as timestamp.

    Numbers up to the lower limit are no milliseconds and numbers past the year 9999
    have no timestamp: both become NULL.
    """
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return column.cast(T.TimestampType())
    if isinstance(dtype, T.NumericType):
        number = sanitize_column(column, dtype)
        millis = F.when((number > EPOCH_MS_ABOVE) & (number <= EPOCH_MS_MAX), number.cast("bigint"))
        return F.timestamp_millis(millis)
    return F.try_to_timestamp(column.cast("string"))


def normalize_timestamps(df: DataFrame) -> DataFrame:
    """Epoch milliseconds to timestamps in every numeric column with a time name."""
    changes = {
        field.name: epoch_ms_to_timestamp(F.col(field.name), field.dataType)
        for field in df.schema
        if is_time_name(field.name) and isinstance(field.dataType, (T.NumericType, T.StringType))
    }
    return df.withColumns(changes) if changes else df


def boolean_value(column: Column, dtype: T.DataType) -> Column:
    """0/1 and true/false in their usual spellings as boolean, anything else as NULL."""
    if isinstance(dtype, T.BooleanType):
        return column
    if isinstance(dtype, T.NumericType):
        return F.when(column == 0, F.lit(False)).when(column == 1, F.lit(True))
    text = column.cast("string")
    return F.when(text.isin("0", "false", "False"), F.lit(False)).when(
        text.isin("1", "true", "True"), F.lit(True)
    )


def normalize_booleans(df: DataFrame) -> DataFrame:
    """Boolean values in every column with a boolean name."""
    changes = {
        field.name: boolean_value(F.col(field.name), field.dataType)
        for field in df.schema
        if is_boolean_name(field.name)
        and not is_time_name(field.name)
        and isinstance(field.dataType, (T.NumericType, T.StringType))
    }
    return df.withColumns(changes) if changes else df


def complex_to_json(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text."""
    changes = {
        field.name: F.to_json(F.col(field.name))
        for field in df.schema
        if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
    }
    return df.withColumns(changes) if changes else df


def json_to_variant(df: DataFrame) -> DataFrame:
    """JSON text as VARIANT in every text column with a JSON name; bad JSON becomes NULL."""
    changes = {
        field.name: F.try_parse_json(F.col(field.name))
        for field in df.schema
        if is_json_name(field.name) and isinstance(field.dataType, T.StringType)
    }
    return df.withColumns(changes) if changes else df


def stamp(df: DataFrame, at: datetime | None = None, name: str = "etl_timestamp") -> DataFrame:
    """The load time; a given time makes a run repeatable."""
    return df.withColumn(name, F.current_timestamp() if at is None else F.lit(utc(at)).cast("timestamp"))


def fill_null_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    changes = {name: null_default(F.col(name), value) for name, value in defaults.items() if name in df.columns}
    return df.withColumns(changes) if changes else df
