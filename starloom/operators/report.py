"""Counts and outcomes of extraction, transformation and load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions.window import EFFECTIVE, IncrementalWindow, apply_window
from starloom.operators.sets import DATABASE, union_all
from starloom.session import estimated_bytes

REPORT_SCHEMA = "table string, status string, parsed bigint, loaded bigint, rejected bigint, error string"
PHASES = ("extraction", "transformation", "loading")


def table_counts(
    tables: Mapping[str, DataFrame], window: IncrementalWindow | None = None, order: Sequence[str] = EFFECTIVE
) -> DataFrame:
    """(_database, table, records) of the rows that are due."""
    parts = []
    for name, df in tables.items():
        due = apply_window(df, window, order=order)
        database = F.col(DATABASE) if DATABASE in df.columns else F.lit(None).cast("string")
        counted = due.groupBy(database.alias(DATABASE)).agg(F.count("*").alias("records"))
        parts.append(counted.select(DATABASE, F.lit(name).alias("table"), "records"))
    return union_all(parts)


def estimated_rows(df: DataFrame, row_bytes: int, margin: float = 1.1) -> int:
    """A row estimate from the plan's statistics, without reading the data."""
    return int(estimated_bytes(df) / row_bytes * margin)


def extract_summary(counts: DataFrame) -> DataFrame:
    """Total databases, tables and records of ``table_counts``."""
    return counts.agg(
        F.count_distinct(DATABASE).alias("total_databases"),
        F.count_distinct(F.struct(DATABASE, "table")).alias("total_tables"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"),
    )


def database_summary(counts: DataFrame) -> DataFrame:
    """Tables and records per database, and over all of them in the row without a database."""
    return counts.rollup(DATABASE).agg(
        F.count("*").alias("tables"), F.sum("records").alias("records"), F.grouping(DATABASE).alias("is_total")
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        df.agg(F.count("*").alias("records")).select(F.lit(name).alias("table"), "records")
        for name, df in tables.items()
    )


def transform_stats(targets: Mapping[str, DataFrame]) -> DataFrame:
    """Records by table, with the number of filled tables and of all records beside each."""
    # One entry per target, so that each is counted once for its row and for the totals.
    counts = row_counts(targets).agg(
        F.collect_list(F.struct("table", "records")).alias("counts"),
        F.count_if(F.col("records") > 0).alias("filled_tables"),
        F.sum("records").alias("total_records"),
    )
    return counts.select(F.inline("counts"), "filled_tables", "total_records")


def profile_targets(targets: Mapping[str, DataFrame]) -> DataFrame:
    """Records and status, loaded or empty, per table."""
    status = F.when(F.col("records") > 0, F.lit("loaded")).otherwise(F.lit("empty"))
    return row_counts(targets).withColumn("status", status)


def status_lists(profile: DataFrame) -> DataFrame:
    """One row per status with the sorted names of its tables: as many names as targets."""
    return profile.groupBy("status").agg(
        F.count("*").alias("tables"), F.sort_array(F.collect_list("table")).alias("names")
    )


def load_report(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), REPORT_SCHEMA)


def load_totals(report: DataFrame) -> DataFrame:
    """Loaded, failed and skipped tables and the records of a load report."""
    return report.agg(
        F.count_if(F.col("status") == "loaded").alias("loaded_tables"),
        F.count_if(F.col("status") == "failed").alias("failed_tables"),
        F.count_if(F.col("status") == "skipped").alias("skipped_tables"),
        F.coalesce(F.sum("parsed"), F.lit(0)).alias("parsed_records"),
        F.coalesce(F.sum("loaded"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected_records"),
    )


def top_failed(report: DataFrame, limit: int = 5) -> DataFrame:
    """The first failed tables by name, and how many more there are."""
    failed = report.filter(F.col("status") == "failed")
    total = failed.agg(F.count("*").alias("n")).scalar()
    return failed.orderBy("table").limit(limit).select("table", "error", F.greatest(total - limit, F.lit(0)).alias("more"))


def run_metrics(events: DataFrame) -> DataFrame:
    """Per run: records by phase, first failing phase and outcome (failed, partial or success).

    ``events`` has run_id, phase, success, records, failed_tables. A run fails if a phase
    did; failed tables alone make it partial.
    """
    order = F.when(F.col("phase") == PHASES[0], 0).when(F.col("phase") == PHASES[1], 1).otherwise(2)
    failing = F.when(~F.col("success"), order)
    by_run = events.groupBy("run_id").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("phase") == phase, F.col("records"))), F.lit(0)).alias(f"{phase}_records")
            for phase in PHASES
        ],
        F.coalesce(F.sum("failed_tables"), F.lit(0)).alias("failed_tables"),
        F.min(failing).alias("_first"),
    )
    return by_run.select(
        "run_id",
        *[f"{phase}_records" for phase in PHASES],
        "failed_tables",
        F.when(F.col("_first") == 0, PHASES[0])
        .when(F.col("_first") == 1, PHASES[1])
        .when(F.col("_first") == 2, PHASES[2])
        .alias("failed_phase"),
        F.when(F.col("_first").isNotNull(), "failed")
        .when(F.col("failed_tables") > 0, "partial")
        .otherwise("success")
        .alias("outcome"),
    )
