"""Checks over whole tables: NULL keys, required columns, duplicate keys, text lengths.

An issue is a code and what it is about: ``null:column``, ``too_long:column``,
``key_repeated:columns``, ``column_absent:column``; for mappings ``no_sources``, ``no_key``,
``no_columns`` and ``columns_empty``, each with the target.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.operators.sets import union_all
from starloom.plans.spec import MappingSet, TargetMapping
from starloom.plans.targets import MUST_HAVE

ISSUE_SCHEMA = "table string, issue string, rows bigint"


def _counted(df: DataFrame, table: str, tests: Mapping[str, Column]) -> DataFrame:
    """(table, issue, rows) for each test that some row fails: one pass, one row per task."""
    counts = df.select(*[F.count_if(test).alias(f"_{i}") for i, test in enumerate(tests.values())])
    pairs = [F.struct(F.lit(name).alias("issue"), F.col(f"_{i}").alias("rows")) for i, name in enumerate(tests)]
    return (
        counts.select(F.explode(F.array(*pairs)).alias("p"))
        .select(F.lit(table).alias("table"), "p.issue", "p.rows")
        .filter(F.col("rows") > 0)
    )


def null_id_issues(df: DataFrame, table: str, *, scope: str = "all", order_by: Sequence[str] = ()) -> DataFrame:
    """NULLs in the ``*_id`` columns of all rows, or of the first row only with ``scope="first"``."""
    tests = _null_id_tests(df)
    if not tests:
        return df.sparkSession.createDataFrame([], ISSUE_SCHEMA)
    if scope == "first":
        value = F.struct(*[name for name in df.columns if name.endswith("_id")])
        order = F.struct(*order_by)
        df = df.agg(F.min_by(value, order).alias("r")).filter(F.col("r").isNotNull()).select("r.*")
    return _counted(df, table, tests)


def _null_id_tests(df: DataFrame) -> dict[str, Column]:
    return {f"null:{name}": F.col(name).isNull() for name in df.columns if name.endswith("_id")}


def missing_columns(df: DataFrame, table: str, must_have: Mapping[str, Sequence[str]] = MUST_HAVE) -> list[str]:
    return [name for name in must_have.get(table, ()) if name not in df.columns]


def missing_column_issues(df: DataFrame, table: str, must_have: Mapping[str, Sequence[str]] = MUST_HAVE) -> DataFrame:
    rows = df.agg(F.count("*").alias("rows"))
    found = [f"column_absent:{name}" for name in missing_columns(df, table, must_have)]
    issues = F.explode(F.array(*[F.lit(text) for text in found]).cast("array<string>"))
    return rows.select(F.lit(table).alias("table"), issues.alias("issue"), "rows").filter(F.col("rows") > 0)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with their number of rows; NULL keys do not collide."""
    filled = df.select(*key).dropna(subset=list(key))
    return filled.groupBy(*key).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def constraint_issues(df: DataFrame, mapping: TargetMapping, *, lengths: bool = True) -> DataFrame:
    """Breaches of the declaration: NULL in key or required columns, texts too long, duplicate keys."""
    return _issues(df, mapping.name, _constraint_tests(df, mapping, lengths), mapping.primary_key)


def _constraint_tests(df: DataFrame, mapping: TargetMapping, lengths: bool) -> dict[str, Column]:
    tests: dict[str, Column] = {}
    for name in dict.fromkeys((*mapping.primary_key, *mapping.required)):
        if name in df.columns:
            tests[f"null:{name}"] = F.col(name).isNull()
    for field in mapping.schema if lengths else ():
        limit = field.metadata.get("max_length", 0)
        if limit and field.name in df.columns and isinstance(df.schema[field.name].dataType, T.StringType):
            tests[f"too_long:{field.name}"] = F.length(field.name) > limit
    return tests


def _issues(df: DataFrame, table: str, tests: Mapping[str, Column], key: Sequence[str] = ()) -> DataFrame:
    """One pass for all row tests and one aggregation by key."""
    parts = [_counted(df, table, tests)] if tests else []
    key = [name for name in key if name in df.columns]
    if key:
        total = duplicate_keys(df, key).agg(F.sum("rows").alias("rows"))
        text = f"key_repeated:{','.join(key)}"
        parts.append(
            total.filter(F.col("rows") > 0).select(F.lit(table).alias("table"), F.lit(text).alias("issue"), "rows")
        )
    return union_all(parts) if parts else df.sparkSession.createDataFrame([], ISSUE_SCHEMA)


def issue_report(
    targets: Mapping[str, DataFrame], mappings: MappingSet | None = None, must_have=MUST_HAVE
) -> DataFrame:
    """All issues of all targets; a target without rows has none."""
    parts = []
    for name, df in targets.items():
        mapping = mappings.get(name) if mappings else None
        tests = _null_id_tests(df)
        if mapping:
            tests.update(_constraint_tests(df, mapping, lengths=True))
        if tests:
            parts.append(_issues(df, name, tests, mapping.primary_key if mapping else ()))
        if missing_columns(df, name, must_have):
            parts.append(missing_column_issues(df, name, must_have))
    return union_all(parts) if parts else None


def is_valid(issues: DataFrame | None) -> bool:
    return issues is None or issues.isEmpty()


def validate_mappings(spec: DataFrame) -> DataFrame:
    """(table, error) for a spec with columns table, source_tables, primary_key and column_mappings."""
    name = F.col("table")
    problems = F.array(
        F.when(F.col("source_tables").isNull(), F.concat(F.lit("no_sources:"), name)),
        F.when(F.col("primary_key").isNull(), F.concat(F.lit("no_key:"), name)),
        F.when(F.col("column_mappings").isNull(), F.concat(F.lit("no_columns:"), name)).when(
            F.size("column_mappings") == 0, F.concat(F.lit("columns_empty:"), name)
        ),
    )
    return spec.select(name, F.explode(F.array_compact(problems)).alias("error"))


def mapping_spec(spark, mappings: MappingSet) -> DataFrame:
    """A mapping set as rows, for ``validate_mappings`` and for joins with declared columns."""
    rows = [
        (m.name, list(m.sources) or None, list(m.key) or None, {k: str(v) for k, v in m.columns.items()})
        for m in mappings
    ]
    schema = "table string, source_tables array<string>, primary_key array<string>, column_mappings map<string,string>"
    return spark.createDataFrame(rows, schema)


def undeclared_columns(spec: DataFrame, declared: DataFrame) -> DataFrame:
    """Mapped columns that the declared schema (table, column) does not have."""
    mapped = spec.select("table", F.explode(F.map_keys("column_mappings")).alias("column"))
    return mapped.join(declared, ["table", "column"], "left_anti")
