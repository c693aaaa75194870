"""Projection by mapping, and the filters that decide which mapped rows are kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.functions.clean import bytes_to_text, null_default, to_bool
from starloom.plans.spec import MappingSet, TargetMapping


def clean_mapped(mapping: TargetMapping, target: str, column: Column, dtype: T.DataType) -> Column:
    """The cleaning a mapped value gets on its way into its target column."""
    if target in mapping.bit_columns:
        return to_bool(column, dtype)
    if isinstance(dtype, T.BinaryType):
        column = bytes_to_text(column)
    if target in mapping.null_defaults:
        column = null_default(column, mapping.null_defaults[target])
    return column


def missing(mapping: TargetMapping, target: str) -> Column:
    return F.lit(None).cast(mapping.type_of(target)).alias(target)


def project(df: DataFrame, mapping: TargetMapping, table: str, passing: Sequence[str] = ()) -> DataFrame:
    """One source table as a target, without joins: other tables' fields and absent ones read NULL."""
    columns: list[Column] = [F.col(name) for name in passing if name in df.columns]
    for target in mapping.columns:
        owner, source = mapping.field_of(target)
        if callable(source):
            columns.append(source().alias(target))
        elif owner in (None, table) and source in df.columns:
            value = clean_mapped(mapping, target, F.col(source), df.schema[source].dataType)
            columns.append(value.alias(target))
        else:
            columns.append(missing(mapping, target))
    return df.select(*columns)


def maps_any_column(df: DataFrame, mapping: TargetMapping, table: str) -> bool:
    """Whether at least one mapped column exists in the source: if so, every row is kept."""
    for target in mapping.columns:
        owner, source = mapping.field_of(target)
        if callable(source) or (owner in (None, table) and source in df.columns):
            return True
    return False


def fan_out(table: str, df: DataFrame, mappings: MappingSet) -> dict[str, DataFrame]:
    """One source table to every target that lists it; each result is its own narrow scan."""
    return {
        mapping.name: project(df, mapping, table)
        for mapping in mappings.fed_by(table)
        if maps_any_column(df, mapping, table)
    }


def has_value(name: str, dtype: T.DataType) -> str:
    """The test, as SQL, for neither NULL nor the empty text; 0 and false are values."""
    quoted = "`" + name.replace("`", "``") + "`"
    if isinstance(dtype, T.StringType):
        return f"({quoted} IS NOT NULL AND {quoted} <> '')"
    if isinstance(dtype, T.BinaryType):
        return f"({quoted} IS NOT NULL AND octet_length({quoted}) > 0)"
    return f"{quoted} IS NOT NULL"


def drop_empty_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Without the rows in which none of the columns holds a value."""
    names = list(columns if columns is not None else df.columns)
    types = {field.name: field.dataType for field in df.schema}
    return df.filter(" OR ".join(has_value(name, types[name]) for name in names)) if names else df
