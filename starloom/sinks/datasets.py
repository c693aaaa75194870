"""Extracts and transformed results as datasets: one folder per table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions.window import IncrementalWindow
from starloom.operators.report import extract_summary, table_counts
from starloom.operators.sets import DATABASE
from starloom.sinks import files
from starloom.sources.envelope import METADATA, metadata_row

#: The folder of an extract's counts; the underscore keeps it apart from tables.
COUNTS = "_counts"


def write_extract(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    window: IncrementalWindow | None = None,
    environment: str = "unknown",
) -> DataFrame:
    """Each table partitioned by database, plus the metadata; the (database, table, records) written.

    The counts are kept beside the tables, so nothing has to be counted again.
    """
    for name, df in tables.items():
        # Small databases share a task and large ones are split, so files have a fair size.
        with files.open_files(df.sparkSession):
            df.hint("rebalance", F.col(DATABASE)).write.mode("overwrite").partitionBy(DATABASE).parquet(f"{root}/{name}")
    written = {name: spark.read.parquet(f"{root}/{name}").withColumn(DATABASE, F.col(DATABASE).cast("string"))
               for name, df in tables.items()}
    if not written:
        return None
    table_counts(written).coalesce(1).write.mode("overwrite").parquet(f"{root}/{COUNTS}")
    counts = read_counts(spark, root)
    summary = metadata_row(extract_summary(counts), window or IncrementalWindow(), environment)
    summary.coalesce(1).write.mode("overwrite").json(f"{root}/{METADATA}")
    return counts


def read_counts(spark: SparkSession, root: str) -> DataFrame:
    """(_database, table, records) as an extract keeps them."""
    return spark.read.schema(f"{DATABASE} string, table string, records bigint").parquet(f"{root}/{COUNTS}")


def write_transformed(targets: Mapping[str, DataFrame], root: str, *, format: str = "parquet", gzip: bool = False) -> None:
    """Each target as its own dataset, Parquet or JSON lines, optionally with gzip."""
    for name, df in targets.items():
        writer = df.write.mode("overwrite")
        if gzip:
            writer = writer.option("compression", "gzip")
        writer.format(format).save(f"{root}/{name}")


def read_datasets(spark: SparkSession, root: str, names: list[str], *, format: str = "parquet", schemas=None) -> dict[str, DataFrame]:
    """The datasets of a root by name, for a run that starts from stored results."""
    frames = {}
    for name in names:
        reader = spark.read.format(format)
        if schemas and name in schemas:
            reader = reader.schema(schemas[name])
        frames[name] = reader.load(f"{root}/{name}")
    return frames
