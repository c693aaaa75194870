"""Progress, recovery and incremental state, kept as append-only rows."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starloom.functions.window import EFFECTIVE, EXTENDED, IncrementalWindow, apply_window, resolve_change_column, utc
from starloom.operators.sets import DATABASE, union_all, without

JOB_EVENTS = (
    "job_id string, at timestamp, kind string, name string, status string, records bigint, details string"
)
# Kinds of job events: phase (extraction, transformation, loading), table and job.
EPOCH = datetime(1970, 1, 1)
WATERMARKS = "table string, database string, value timestamp, run_id string, committed_at timestamp"
# Scans that the databases of a table are dealt to by their marks, so that a late one does not open the files of all.
MARK_GROUPS = 8
# Rows of (database, mark) up to which a group's marks are broadcast.
BROADCAST_MARKS = 100_000


def job_event(job_id, at, kind, name, status, records=None, details=None) -> tuple:
    return (job_id, utc(at), kind, name, status, records, details)


def append_events(spark: SparkSession, path: str, events: Iterable[tuple]) -> None:
    rows = spark.createDataFrame(list(events), JOB_EVENTS).coalesce(1)
    rows.write.mode("append").partitionBy("job_id").parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(JOB_EVENTS).parquet(path)


def forget_job(spark: SparkSession, path: str, job_id: str) -> bool:
    """Remove the events of a finished job; True if there were any."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/job_id={job_id}")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def job_state(events: DataFrame) -> DataFrame:
    """The last status of each phase, table and job."""
    latest = F.max_by(F.struct("status", "records", "details", "at"), "at").alias("last")
    state = events.groupBy("job_id", "kind", "name").agg(latest)
    return state.select("job_id", "kind", "name", "last.*")


def job_summary(events: DataFrame) -> DataFrame:
    """Per job: status, numbers of loaded, failed and skipped tables, phase states, and whether to resume.

    A job resumes if it is in progress and has loaded at least one table.
    """
    state = job_state(events)
    table = F.col("kind") == "table"
    summary = state.groupBy("job_id").agg(
        F.coalesce(F.max(F.when(F.col("kind") == "job", F.col("status"))), F.lit("in_progress")).alias("status"),
        F.count_if(table & (F.col("status") == "loaded")).alias("loaded_tables"),
        F.count_if(table & (F.col("status") == "failed")).alias("failed_tables"),
        F.count_if(table & (F.col("status") == "skipped")).alias("skipped_tables"),
        *[
            F.coalesce(
                F.max(F.when((F.col("kind") == "phase") & (F.col("name") == phase), F.col("status"))), F.lit("pending")
            ).alias(phase)
            for phase in ("extraction", "transformation", "loading")
        ],
    )
    return summary.withColumn("should_resume", (F.col("status") == "in_progress") & (F.col("loaded_tables") > 0))


def replay_due(events: DataFrame) -> DataFrame:
    """The failed jobs whose extraction was done: they start again from the stored extract."""
    summary = job_summary(events)
    return summary.filter("extraction = 'done' AND status = 'failed'").select("job_id", "transformation", "loading")


def remaining_tables(names: DataFrame, loaded: DataFrame, skip: Sequence[str] = (), column: str = "table") -> DataFrame:
    """The tables neither loaded yet nor to be skipped, in any letter case; a loaded empty table counts."""
    left = without(names, loaded, column)
    lowered = [name.lower() for name in skip]
    return left.filter(~F.lower(F.col(column)).isin(*lowered)) if lowered else left


def remaining_names(names: Iterable[str], loaded: Iterable[str], skip: Iterable[str] = ()) -> list[str]:
    """The same for names known on the driver."""
    done = {name.lower() for name in (*loaded, *skip)}
    return [name for name in names if name.lower() not in done]


def change_moment(df: DataFrame, column: str):
    """A change column as timestamp: epoch milliseconds, text or a time type."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.NumericType):
        return F.timestamp_millis(F.col(column).cast("bigint"))
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(column)
    return F.col(column).cast("timestamp")


def high_water_marks(tables: Mapping[str, DataFrame], order: Sequence[str] = EFFECTIVE) -> DataFrame | None:
    """(table, value): the latest change per table; the aggregate runs on the raw column."""
    parts = []
    for name, df in tables.items():
        column = resolve_change_column(df, order)
        if column is None:
            continue
        top = df.agg(F.max(column).alias(column))
        parts.append(top.select(F.lit(name).alias("table"), change_moment(top, column).alias("value")))
    return union_all(parts) if parts else None


def database_marks(tables: Mapping[str, DataFrame], order: Sequence[str] = EXTENDED) -> DataFrame | None:
    """(table, database, records, value): rows and latest change of each database's table, in one pass per table.

    The database is NULL for tables without one, and so is the value of tables without a change
    column. Databases without rows are not there.
    """
    parts = []
    for name, df in tables.items():
        column = resolve_change_column(df, order)
        scope = [DATABASE] if DATABASE in df.columns else []
        latest = [F.max(column).alias(column)] if column else []
        top = df.groupBy(*scope).agg(F.count("*").alias("records"), *latest)
        database = F.col(DATABASE).cast("string") if scope else F.lit(None).cast("string")
        value = change_moment(top, column) if column else F.lit(None).cast("timestamp")
        parts.append(top.select(F.lit(name).alias("table"), database.alias("database"), "records", value.alias("value")))
    return union_all(parts).filter("records > 0") if parts else None


def commit_watermarks(marks: DataFrame, path: str, run_id: str, at: datetime) -> None:
    """Keep the marks of a run; to be called after its load. What had no rows keeps its old mark."""
    database = F.col("database") if "database" in marks.columns else F.lit(None).cast("string")
    rows = marks.filter(F.col("value").isNotNull()).select(
        "table", database.alias("database"), "value", F.lit(run_id).alias("run_id"),
        F.lit(utc(at)).cast("timestamp").alias("committed_at"),
    )
    rows.coalesce(1).write.mode("append").parquet(path)


def read_watermarks(spark: SparkSession, path: str) -> DataFrame:
    """All marks that were ever committed; those kept before marks had a database have none."""
    return spark.read.schema(WATERMARKS).parquet(path)


def changed_since(
    tables: Mapping[str, DataFrame], history: DataFrame | None, order: Sequence[str] = EXTENDED
) -> dict[str, DataFrame]:
    """The rows of each database's table from its own last mark on, the mark included.

    Without a mark the history is whole: a table, or a database, that joins later or could not
    be opened before loses nothing. A mark without a database holds for tables without one.
    """
    marks: dict[str, dict[str | None, datetime]] = {}
    if history is not None:
        if "database" not in history.columns:
            history = history.withColumn("database", F.lit(None).cast("string"))
        current = current_watermarks(history).select("table", "database", F.unix_micros("value").alias("micros"))
        # One row for each table and database.
        for row in current.collect():
            marks.setdefault(row["table"], {})[row["database"]] = EPOCH + timedelta(microseconds=row["micros"])
    return {name: _since(df, marks.get(name, {}), order) for name, df in tables.items()}


def _since(df: DataFrame, marks: Mapping[str | None, datetime], order: Sequence[str]) -> DataFrame:
    column = resolve_change_column(df, order)
    if DATABASE not in df.columns:
        return apply_window(df, IncrementalWindow(start=marks[None]), column) if None in marks and column else df
    known = sorted((value, name) for name, value in marks.items() if name is not None)
    if not known or column is None:
        return df
    name = F.col(DATABASE).cast("string")
    parts = [df.filter(name.isNull() | ~name.isin([database for _, database in known]))]
    for group in _near(known):
        # A scan with a literal bound reaches the partitions and the files of its databases.
        part = df.filter(name.isin([database for _, database in group]))
        part = apply_window(part, IncrementalWindow(start=group[0][0]), column)
        if group[0][0] != group[-1][0]:
            # The bound of the group is its least mark; each database's own one decides.
            rows = [(database, utc(value)) for value, database in group]
            own = df.sparkSession.createDataFrame(rows, "_marked string, _mark timestamp")
            own = F.broadcast(own) if len(rows) <= BROADCAST_MARKS else own
            late = (name == F.col("_marked")) & (change_moment(part, column) >= F.col("_mark"))
            part = part.join(own, late, "left_semi")
        parts.append(part)
    return union_all(parts)


def _near(known: Sequence[tuple[datetime, str]]) -> list[list[tuple[datetime, str]]]:
    """Ascending marks in at most ``MARK_GROUPS`` groups, each within as short a time as that allows, a day at least."""
    span = timedelta(days=1)
    while True:
        groups: list[list[tuple[datetime, str]]] = []
        for mark in known:
            if not groups or mark[0] - groups[-1][0][0] > span:
                groups.append([])
            groups[-1].append(mark)
        if len(groups) <= MARK_GROUPS:
            return groups
        span *= 2


def current_watermarks(history: DataFrame) -> DataFrame:
    """The mark of each table, and database if there is one, as of its last commit."""
    keys = [c for c in ("table", "database") if c in history.columns]
    last = F.max_by(F.struct("value", "run_id"), "committed_at").alias("last")
    return history.groupBy(*keys).agg(last).select(*keys, "last.value", "last.run_id")
