"""Scans of source tables over many databases, in one window."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.functions.window import EFFECTIVE, IncrementalWindow, apply_window, resolve_change_column, window_condition
from starloom.operators.sets import DATABASE, union_all
from starloom.plans.build import POSITION
from starloom.sinks.files import matching
from starloom.sources.catalog import jdbc_options, keep_name, keyword_condition, tables_to_extract
from starloom.sources.splits import plan_query


@dataclass(frozen=True)
class Source:
    """A database: a directory with one dataset per table, or a JDBC connection."""

    database: str
    path: str = ""
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    split_by: str = ""
    splits: int = 16

    @classmethod
    def jdbc(cls, urls: Mapping[str, str], database: str, *, split_by: str = "", splits: int = 16, **options: str) -> Source:
        return cls(database, format="jdbc", options={**jdbc_options(urls, database), **options}, split_by=split_by, splits=splits)

    def __repr__(self) -> str:  # options hold credentials
        return f"Source({self.database!r}, {self.format!r})"

    def read(self, spark: SparkSession, table: str, order_by: Sequence[str] = ()) -> DataFrame:
        """The whole table; a JDBC table is read by several connections if ``split_by`` names a whole-number key."""
        reader = spark.read.format(self.format).options(**self.options)
        if self.format == "jdbc":
            # Fetched in steps, and in ranges side by side if there is a key or the options name a partition column.
            if self.split_by:
                parts = plan_query(lambda sql: reader.option("query", sql).load(), table, self.split_by, self.splits)
                options = {k: v for k, v in self.options.items() if k != "url"}
                df = spark.read.jdbc(self.options["url"], table, predicates=parts, properties=options)
            else:
                df = reader.option("dbtable", table).load()
            return with_position(df, order_by, in_files=False)
        return with_position(reader.load(f"{self.path.rstrip('/')}/{table}"), order_by)


def with_position(df: DataFrame, order_by: Sequence[str] = (), *, in_files: bool = True) -> DataFrame:
    """``_pos``, the arrival order of a row: given columns, else ``id``, else the place in its file.

    It is a struct, read only where a lookup needs it. A table that is not in files and has
    no ``id`` gets none, so it cannot be looked up without an order.
    """
    if POSITION in df.columns:
        return df
    names = list(order_by) or (["id"] if "id" in df.columns else [])
    if names:
        return df.withColumn(POSITION, F.struct(*names))
    if not in_files:
        return df
    return df.select(
        "*", F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias(POSITION)
    )


def scan(
    spark: SparkSession,
    source: Source,
    table: str,
    window: IncrementalWindow | None = None,
    *,
    change_columns: Sequence[str] = EFFECTIVE,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """The rows of one table that are due, tagged with the database."""
    df = source.read(spark, table, order_by)
    return apply_window(df, window, order=change_columns).withColumn(DATABASE, F.lit(source.database))


def scan_all(
    spark: SparkSession,
    sources: Iterable[Source],
    tables: Sequence[str],
    window: IncrementalWindow | None = None,
    **options,
) -> tuple[dict[str, DataFrame], list[tuple[str, str, str]]]:
    """Every selected table of every database, one frame per table.

    A table that cannot be opened is reported as (database, table, error) and does not
    stop the others.
    """
    parts: dict[str, list[DataFrame]] = {}
    failures: list[tuple[str, str, str]] = []
    for source in sources:
        for table in tables_to_extract(tables):
            try:
                parts.setdefault(table, []).append(scan(spark, source, table, window, **options))
            except PySparkException as error:
                failures.append((source.database, table, type(error).__name__))
    return {table: union_all(frames) for table, frames in parts.items() if frames}, failures


def scan_layout(
    spark: SparkSession,
    root: str,
    table: str,
    window: IncrementalWindow | None = None,
    *,
    include=None,
    exclude=None,
    format: str = "parquet",
    change_columns: Sequence[str] = EFFECTIVE,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """One table of all databases from a layout partitioned by ``_database``.

    This is one scan however many databases there are. Keywords prune partitions and
    the window reaches the files.
    """
    df = spark.read.format(format).load(f"{root.rstrip('/')}/{table}")
    df = df.withColumn(DATABASE, F.col(DATABASE).cast("string"))
    df = apply_window(df, window, order=change_columns)
    df = df.filter(keyword_condition(F.col(DATABASE), include, exclude))
    return with_position(df, order_by)


def scan_layouts(
    spark: SparkSession, root: str, tables: Iterable[str], window: IncrementalWindow | None = None, **options
) -> tuple[dict[str, DataFrame], list[tuple[str, str]]]:
    """Every table of a layout that is there, and (table, error) for those that cannot be opened."""
    frames: dict[str, DataFrame] = {}
    failures: list[tuple[str, str]] = []
    for table in tables_to_extract(tables):
        try:
            frames[table] = scan_layout(spark, root, table, window, **options)
        except PySparkException as error:
            failures.append((table, type(error).__name__))
    return frames, failures


def layout_databases(spark: SparkSession, root: str, tables: Iterable[str], include=None, exclude=None) -> dict[str, frozenset]:
    """Which databases a layout has files of, table by table, from the list of its folders alone.

    It is what ``build_all`` takes as ``available``, so that planning reads no rows.
    """
    out = {}
    for table in tables:
        folders = matching(spark, f"{root.rstrip('/')}/{table}/{DATABASE}=*")
        names = [unquote(path.rstrip("/").rsplit("=", 1)[1]) for path in folders]
        out[table] = frozenset(
            None if name == "__HIVE_DEFAULT_PARTITION__" else name for name in names if keep_name(name, include, exclude)
        )
    return out


def latest_file(spark: SparkSession, pattern: str) -> str | None:
    """The most recently changed file that fits a pattern; contents are not read."""
    files = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime")
    return files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).first()["path"]


def latest_dataset(spark: SparkSession, root: str) -> str | None:
    """The dataset below ``root`` with the most recently changed file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    inside = F.split_part(F.split_part("path", F.lit(f"{root.rstrip('/')}/"), F.lit(-1)), F.lit("/"), F.lit(1))
    files = files.select(inside.alias("name"), "modificationTime")
    name = files.agg(F.max_by("name", F.struct("modificationTime", "name")).alias("name")).first()["name"]
    return f"{root.rstrip('/')}/{name}" if name else None


def has_changes(df: DataFrame, window: IncrementalWindow, column: str | None = None) -> bool:
    """Whether any row is due; stops at the first one."""
    return not apply_window(df, window, column).isEmpty()


def changed_tables(tables: Mapping[str, DataFrame], window: IncrementalWindow, order: Sequence[str] = EFFECTIVE) -> DataFrame:
    """Per table, whether any row is due, and how many are."""
    rows = []
    for name, df in tables.items():
        column = resolve_change_column(df, order)
        due = window_condition(df, window, column) if column and window.active else F.lit(True)
        rows.append(
            df.select(due.alias("due"))
            .agg(F.count_if("due").alias("rows_due"))
            .select(F.lit(name).alias("table"), (F.col("rows_due") > 0).alias("has_changes"), "rows_due")
        )
    return union_all(rows)
