"""Interchange documents: JSON that nests rows by database and table.

``read_extract``, ``read_single`` and ``read_transformed`` read files of any size in ranges, see
``documents``. The ``explode`` functions take documents that are values of a column, each of which
is parsed as one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starloom.functions.clean import boolean_value, epoch_ms_to_timestamp, to_bool
from starloom.functions.window import TEXT_FORMAT, IncrementalWindow
from starloom.operators.sets import DATABASE
from starloom.plans.build import POSITION
from starloom.plans.spec import MappingSet
from starloom.plans.targets import JOIN_KEYS, TARGETS
from starloom.sources.documents import FILE, METADATA, read_extract, read_single, read_transformed



__all__ = [
    "FILE", "METADATA", "document_tables", "explode_extract", "explode_single", "explode_transformed", "keep_rows",
    "metadata_row", "read_documents", "read_extract", "read_single", "read_transformed", "table_rows",
]


def read_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per file, plain or gzip, with its text in ``value`` and its path in ``_file``."""
    return spark.read.text(paths, wholetext=True).select("value", F.col("_metadata.file_path").alias(FILE))


def _parsed(documents: DataFrame, column: str) -> DataFrame:
    """A document that is no JSON, or too large for one value, is an error, never empty."""
    passing = [FILE] if FILE in documents.columns else []
    return documents.select(*passing, F.parse_json(column).alias("doc"))


def _rows(tables: DataFrame) -> DataFrame:
    """One row per entry of ``rows``; its position counts within its file, and files by name."""
    place = F.col("r.pos")
    if FILE in tables.columns:
        place = F.struct(F.col(FILE).alias("file"), place.alias("pos"))
    passing = [c for c in (DATABASE, "table") if c in tables.columns]
    return _entries(tables, "rows", "r").select(*passing, place.alias(POSITION), F.col("r.value").alias("row"))


def _entries(df: DataFrame, column: str | Column, name: str) -> DataFrame:
    """One row per entry of a VARIANT object or array, as struct ``name`` of pos, key and value."""
    value = F.col(column) if isinstance(column, str) else column
    entries = df.sparkSession.tvf.variant_explode(value.outer())
    return df.lateralJoin(entries.select(F.struct("pos", "key", "value").alias(name)))


def explode_extract(documents: DataFrame, column: str = "value") -> DataFrame:
    """(_database, table, _pos, row) for each row of each database's tables; the metadata entry is skipped."""
    databases = _entries(_parsed(documents, column), "doc", "d").filter(F.col("d.key") != METADATA).drop("doc")
    tables = _entries(databases, "d.value", "t").withColumns(
        {
            DATABASE: F.col("d.key"),
            "table": F.col("t.key"),
            "rows": F.try_variant_get("t.value", "$.sample", "variant"),
        }
    )
    return _rows(tables.drop("d", "t"))


def explode_single(documents: DataFrame, column: str = "value") -> DataFrame:
    """(_database, table, _pos, row) for each row of documents that hold one table."""
    tables = _parsed(documents, column).withColumns(
        {
            DATABASE: F.try_variant_get("doc", "$.database", "string"),
            "table": F.try_variant_get("doc", "$.table", "string"),
            "rows": F.try_variant_get("doc", "$.data", "variant"),
        }
    )
    return _rows(tables.drop("doc"))


def explode_transformed(documents: DataFrame, column: str = "value") -> DataFrame:
    """(table, _pos, row) for each row of transformed documents, with or without the ``tables`` wrapper."""
    parsed = _parsed(documents, column)
    parsed = parsed.withColumn("doc", F.coalesce(F.try_variant_get("doc", "$.tables", "variant"), "doc"))
    tables = _entries(parsed, "doc", "t").withColumns({"table": F.col("t.key"), "rows": F.col("t.value")})
    return _rows(tables.drop("doc", "t"))


def _from_variant(field: T.StructField) -> Column:
    """A document value in a column's type: times may be epoch milliseconds, flags 0/1, texts nested JSON."""
    path = f"$['{field.name}']"
    text = F.try_variant_get("row", path, "string")
    if field.metadata.get("bit"):
        number = F.try_variant_get("row", path, "double")
        is_text = F.schema_of_variant(F.try_variant_get("row", path, "variant")) == "STRING"
        return F.when(is_text, to_bool(text, T.StringType())).otherwise(number != 0)
    if isinstance(field.dataType, T.BooleanType):
        return boolean_value(text, T.StringType())
    if isinstance(field.dataType, T.TimestampType):
        kind = F.schema_of_variant(F.try_variant_get("row", path, "variant"))
        number = F.when(~kind.isin("STRING", "VOID"), F.try_variant_get("row", path, "double"))
        return F.coalesce(epoch_ms_to_timestamp(number, T.DoubleType()), F.when(number.isNull(), F.try_to_timestamp(text)))
    return F.try_variant_get("row", path, field.dataType.simpleString())


def table_rows(exploded: DataFrame, table: str, schema: T.StructType) -> DataFrame:
    """One table's rows as columns; a value that does not fit its type reads NULL."""
    passing = [name for name in (DATABASE, POSITION) if name in exploded.columns]
    fields = [_from_variant(field).alias(field.name) for field in schema]
    return exploded.filter(F.col("table") == table).select(*passing, *fields)


def document_tables(
    exploded: DataFrame, mappings: MappingSet = TARGETS, join_keys: Mapping[frozenset, str] = JOIN_KEYS
) -> dict[str, DataFrame]:
    """Every source table of the mappings from exploded documents, ready to build targets from.

    For more than a few tables take rows out of ``keep_rows``, as documents are else read for each table.
    """
    return {
        table: table_rows(exploded, table, mappings.source_schema(table, join_keys))
        for table in sorted(mappings.required_tables())
    }


def keep_rows(exploded: DataFrame, root: str) -> DataFrame:
    """The rows as stored below ``root``, a folder for each table: documents are parsed once, however many tables are read."""
    exploded.hint("rebalance", F.col("table")).write.partitionBy("table").parquet(root)
    return exploded.sparkSession.read.schema(exploded.schema).parquet(root)


def metadata_row(summary: DataFrame, window: IncrementalWindow, environment: str, at: datetime | None = None) -> DataFrame:
    """The extraction's metadata beside its totals (databases, tables, records)."""
    bound = lambda moment: F.lit(moment.strftime(TEXT_FORMAT) if moment else None).cast("string")
    moment = at or datetime.now(timezone.utc).replace(tzinfo=None)
    return summary.select(
        F.lit(moment.isoformat()).alias("extraction_timestamp"),
        F.lit(environment).alias("environment"),
        F.struct(
            F.lit(window.active).alias("enabled"),
            bound(window.start).alias("start_date"),
            bound(window.end).alias("end_date"),
        ).alias("date_filtering"),
        "total_databases",
        "total_tables",
        "total_records",
    )
