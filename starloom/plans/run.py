"""Whole runs: load with a failure strategy, recovery, and extract-transform-load in one call."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from threading import Event
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from starloom.functions.clean import stamp
from starloom.functions.window import EXTENDED, IncrementalWindow, apply_window
from starloom.operators.load import REJECTS, accepted, apply_defaults, load_with_rejects, rejected
from starloom.operators.report import PHASES, load_report
from starloom.operators.state import (
    append_events,
    changed_since,
    commit_watermarks,
    database_marks,
    job_event,
    job_state,
    read_events,
    read_watermarks,
    remaining_names,
    replay_due,
)
from starloom.operators.sets import DATABASE
from starloom.plans.build import build_all, main_order
from starloom.plans.spec import LOAD_TIME, MappingSet, TargetMapping
from starloom.plans.targets import TARGETS
from starloom.session import cut
from starloom.sinks import files
from starloom.sinks.datasets import write_extract
from starloom.sinks.store import BUCKET, LOAD, StarStore, clustered
from starloom.sources.documents import METADATA

#: Where a row stands among those that arrive with it.
ARRIVAL = "_arrival"
STRATEGIES = ("bulk", "continue_on_error", "fail_fast", "all_or_nothing")


@dataclass
class LoadResult:
    """The outcome per table: (table, status, parsed, loaded, rejected, error)."""

    strategy: str
    rows: list[tuple] = field(default_factory=list)

    def names(self, status: str) -> list[str]:
        return [row[0] for row in self.rows if row[1] == status]

    @property
    def total_records(self) -> int:
        return sum(row[3] or 0 for row in self.rows)

    @property
    def success(self) -> bool:
        """Some table loaded, or under the other strategies: no stop, or no failure at all."""
        if self.strategy == "continue_on_error":
            return bool(self.names("loaded"))
        if self.strategy in ("fail_fast", "all_or_nothing"):
            return not self.names("failed")
        return True

    def report(self, spark: SparkSession) -> DataFrame:
        return load_report(spark, self.rows)


def load_table(
    store: StarStore,
    table: str,
    df: DataFrame,
    mappings: MappingSet | None = TARGETS,
    *,
    mode: str = "append",
    order_by: Sequence[str] = (),
    rejects_path: str | None = None,
    check_required: bool = True,
    per_database: bool = False,
    fill_defaults: bool = False,
    cluster: bool = False,
    buckets: int = 0,
    keep_versions: int = 2,
) -> tuple[str, str, int, int, int, str | None]:
    """Load one target and report it; a target without rows is skipped and leaves no table behind.

    Rejected rows are kept below ``rejects_path``, by default ``_rejects`` in the store's root.
    Rows and rejects are counted while they are written, so the target is computed once. An
    append writes its rows once, accepted and rejected ones apart, and hands the files over;
    an upsert stages them, as it reads them several times. Of rows of one key that ``order_by``
    does not tell apart the one that arrives last stays. An upsert removes what only versions
    before the last ``keep_versions`` need.

    With ``per_database`` the table is partitioned by ``_database``, which becomes part of
    the key, so equal keys of different databases stay apart. With ``buckets`` a new table is
    dealt by its key into so many folders, of which an upsert rewrites only those it touches.
    ``fill_defaults`` gives columns that ``df`` does not have their declared default instead of
    NULL, and ``cluster`` writes the rows in the declared layout.
    """
    mapping = mappings.get(table) if mappings else None
    if mapping and fill_defaults:
        df = apply_defaults(df, mapping.defaults)
    if LOAD_TIME not in df.columns:
        df = stamp(df)
    parts = (DATABASE,) if per_database and DATABASE in df.columns else ()
    created = store.ensure_for(table, df, mapping, parts, buckets=buckets)
    required = tuple(dict.fromkeys((*mapping.primary_key, *mapping.required))) if mapping and check_required else ()
    version = store.version(table)
    schema = _declared(version.schema, mapping)
    seen = Observation(f"{table}-{uuid4().hex}")
    checked = load_with_rejects(df, schema, required=required, lengths=mapping is not None)
    # Counted last of all: sorting into ranges runs what is before it twice.
    counted = lambda rows: rows.observe(
        seen, F.count("*").alias("parsed"), F.count_if(F.col(REJECTS).isNotNull()).alias("rejected")
    )
    layout = mapping.cluster_by if mapping and cluster else ()
    rejects_path = rejects_path or f"{store.root}/_rejects"
    staged = store.staging(table)
    counts = None
    try:
        if mode == "upsert":
            counted(checked.withColumn(ARRIVAL, F.monotonically_increasing_id())).write.parquet(staged)
            rows = store.spark.read.parquet(staged)
            key = (*mapping.primary_key, *parts) if mapping else ()
            order = list(order_by) or [c for c in ("updated_at", *key) if c in schema.names]
            store.upsert(table, accepted(rows), key, [*order, ARRIVAL], cluster_by=layout)
            store.drop_old_versions(table, keep_versions)
        else:
            load = uuid4().hex
            rows = store.laid_out(version, checked, load)
            dealt = [c for c in version.layout if c != LOAD]
            if layout:
                rows = clustered(rows, [*dealt, *layout], tie=mapping.primary_key)
            elif dealt:
                rows = rows.hint("rebalance", *[F.col(c) for c in dealt])
            bad = F.col(REJECTS).isNotNull().alias("_rejected")
            with files.open_files(rows.sparkSession):
                counted(rows).select("*", bad).write.partitionBy("_rejected", *version.layout).parquet(staged)
            store.adopt(table, f"{staged}/_rejected=false", load)
        counts = seen.get
        if counts["rejected"]:
            rows = store.spark.read.parquet(staged if mode == "upsert" else f"{staged}/_rejected=true")
            rejected(rows).drop(ARRIVAL, BUCKET, LOAD).write.mode("append").parquet(f"{rejects_path.rstrip('/')}/{table}")
    finally:
        store.remove(staged)
        # A table made for a load that failed or had no rows would look loaded to a recovery.
        if created and not (counts and counts["parsed"]):
            store.drop(table)
    if not counts["parsed"]:
        return (table, "skipped", 0, 0, 0, None)
    loaded = counts["parsed"] - counts["rejected"]
    return (table, "loaded", counts["parsed"], loaded, counts["rejected"], None)


def _declared(schema: T.StructType, mapping: TargetMapping | None) -> T.StructType:
    """The table's schema with the declared text lengths, which the catalog does not keep."""
    known = {f.name.lower(): f.metadata for f in mapping.schema} if mapping else {}
    return T.StructType([T.StructField(f.name, f.dataType, True, known.get(f.name.lower(), {})) for f in schema])


def load_all(
    store: StarStore,
    targets: Mapping[str, DataFrame],
    strategy: str = "bulk",
    mappings: MappingSet | None = TARGETS,
    *,
    parallel: int = 1,
    **options,
) -> LoadResult:
    """Load every target; a failing one is recorded and, but for ``fail_fast``, the rest goes on.

    With ``parallel`` several targets are written at a time, so that small ones fill the
    gaps large ones leave; the report keeps the order of the targets.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    stopped = Event()

    def attempt(table: str) -> tuple | None:
        if stopped.is_set():
            return None
        try:
            return load_table(store, table, targets[table], mappings, **options)
        except (PySparkException, Py4JJavaError, ValueError) as error:
            # An unreadable file is a Java error; it fails its target like any other.
            if strategy == "fail_fast":
                stopped.set()
            return (table, "failed", None, 0, None, str(error))

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        rows = list(pool.map(inheritable_thread_target(store.spark)(attempt), targets))
    return LoadResult(strategy, [row for row in rows if row is not None])


def load_many(store: StarStore, inputs: Mapping[str, Mapping[str, DataFrame]], strategy: str = "bulk", **options) -> dict[str, LoadResult]:
    """Load several inputs; each has its own result."""
    return {name: load_all(store, targets, strategy, **options) for name, targets in inputs.items()}


def recover(
    store: StarStore,
    targets: Mapping[str, DataFrame],
    skip: Iterable[str] = (),
    strategy: str = "continue_on_error",
    **options,
) -> LoadResult:
    """Load only the targets that the store does not have; nothing left to do is a success."""
    names = remaining_names(targets, store.tables(), skip)
    if not names:
        return LoadResult("bulk")
    return load_all(store, {name: targets[name] for name in names}, strategy, **options)


def run(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    store: StarStore,
    *,
    mappings: MappingSet = TARGETS,
    window: IncrementalWindow | None = None,
    incremental: bool = False,
    whole_lookups: bool = False,
    strategy: str = "bulk",
    mode: str = "append",
    state_path: str | None = None,
    job_id: str | None = None,
    at: datetime | None = None,
    load_options: Mapping[str, object] | None = None,
    failures: Iterable[tuple] = (),
    extract_path: str | None = None,
    resume: bool = False,
    **build_options,
) -> LoadResult:
    """Source tables to loaded targets.

    ``window`` limits all tables; ``incremental`` starts each database's table at its last
    mark, and reads a database without one in whole. With ``whole_lookups`` tables that no
    target has as its main table are read whole, so that a changed row also finds related rows
    that did not change.

    One pass over the sources counts their rows by database and takes the marks, before anything
    is loaded, so rows that change meanwhile are due again. Marks are committed after the load,
    never by runs with a window (it leaves a gap), and of each source only if every target it
    feeds was loaded or had no rows. ``failures`` are the sources that could not be opened, as
    ``scan_all`` and ``scan_layouts`` report them: they go into the events and metrics, and no
    table that is joined with one of them gets a mark in that database. A mark is included in the
    next run, so incremental runs must upsert. Progress, marks and metrics are kept below
    ``state_path``.

    With ``extract_path`` the rows that are due are stored there first, in a folder of the job, and
    targets are built from these; ``replay`` goes on from there after a failure. ``resume`` leaves
    out the targets that the events of this ``job_id`` tell were loaded before.
    """
    if incremental and mode == "append":
        raise ValueError("an incremental run reads the rows at its marks again; use mode='upsert'")
    job = job_id or uuid4().hex
    moment = at or _now()
    history = f"{state_path}/watermarks"

    def note(*events: tuple) -> None:
        if state_path:
            append_events(spark, f"{state_path}/job_events", [job_event(job, _now(), *event) for event in events])

    needed = {name: df for name, df in tables.items() if name in mappings.required_tables()}
    phase = "extraction"
    result = LoadResult(strategy)
    failures = list(failures)
    extracted = 0
    note(("job", "run", "in_progress"), *[("source", ".".join(f[:-1]), "failed", None, f[-1]) for f in failures])
    try:
        mains = {main_order(mapping)[0] for mapping in mappings}
        limited = {name: df for name, df in needed.items() if name in mains or not whole_lookups}
        if incremental and state_path:
            known = read_watermarks(spark, history) if files.exists(spark, history) else None
            limited = changed_since(limited, known)
        needed.update({name: apply_window(df, window, order=EXTENDED) for name, df in limited.items()})
        if extract_path:
            needed = keep_extract(spark, needed, f"{extract_path.rstrip('/')}/{job}")
        marks = database_marks(needed)
        if marks is not None:
            marks = cut(marks)
            # One row for each table and database, as many as the catalog has.
            found = marks.select("table", "database", "records").collect()
            extracted = sum(row["records"] for row in found)
            held = {name: frozenset(r["database"] for r in found if r["table"] == name) for name in needed}
            build_options.setdefault("available", held)
        note(("phase", phase, "done", extracted))
        phase = "transformation"
        targets = build_all(mappings, needed, etl_timestamp=at, **build_options)
        if resume and state_path:
            done = _loaded_before(spark, f"{state_path}/job_events", job)
            targets = {name: df for name, df in targets.items() if name not in done}
        note(("phase", phase, "done"))
        phase = "loading"
        result = load_all(store, targets, strategy, mappings, mode=mode, **(load_options or {}))
        note(*[("table", row[0], row[1], row[3], row[5]) for row in result.rows])
        if marks is not None and state_path and result.success and not (window and window.active):
            whole = sources_loaded(mappings, targets, result)
            whole = marks.filter(F.col("table").isin(sorted(whole)))
            for database, tables_ in joined_with(mappings, failures).items():
                there = F.col("table").isin(sorted(tables_))
                whole = whole.filter(~(there if database is None else there & F.col("database").eqNullSafe(database)))
            commit_watermarks(whole, history, job, moment)
        note(
            ("phase", phase, "done" if result.success else "failed"),
            ("job", "run", "completed" if result.success else "failed"),
        )
    except Exception:
        note(("phase", phase, "failed"), ("job", "run", "failed"))
        raise
    finally:
        if state_path:
            _append_metrics(spark, f"{state_path}/run_metrics", job, phase, result, extracted, len(failures))
    return result


def keep_extract(spark: SparkSession, tables: Mapping[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """The tables as stored below ``root``, a dataset each, partitioned by database if they have one."""
    scoped = {name: df for name, df in tables.items() if DATABASE in df.columns}
    write_extract(spark, scoped, root)
    for name, df in tables.items():
        if name not in scoped:
            df.write.mode("overwrite").parquet(f"{root}/{name}")
    return stored_extract(spark, root, {name: df.schema for name, df in tables.items()})


def stored_extract(spark: SparkSession, root: str, schemas: Mapping[str, T.StructType]) -> dict[str, DataFrame]:
    frames = {name: spark.read.schema(schema).parquet(f"{root}/{name}") for name, schema in schemas.items()}
    return {name: df.select(*schemas[name].names) for name, df in frames.items()}


def replay(spark: SparkSession, store: StarStore, state_path: str, extract_path: str, **options) -> dict[str, LoadResult]:
    """Run each failed job again whose extract is stored, without the targets it had loaded; by job."""
    out = {}
    # One row for each failed job.
    for row in replay_due(read_events(spark, f"{state_path}/job_events")).select("job_id").sort("job_id").collect():
        root = f"{extract_path.rstrip('/')}/{row['job_id']}"
        names = [path.rstrip("/").rsplit("/", 1)[-1] for path in files.matching(spark, f"{root}/*")]
        tables = {name: spark.read.parquet(f"{root}/{name}") for name in names if name != METADATA}
        tables = {n: df.withColumn(DATABASE, F.col(DATABASE).cast("string")) if DATABASE in df.columns else df for n, df in tables.items()}
        out[row["job_id"]] = run(spark, tables, store, state_path=state_path, job_id=row["job_id"], resume=True, **options)
    return out


def _loaded_before(spark: SparkSession, path: str, job: str) -> set[str]:
    """The targets that were loaded, or had no rows, as the job's events tell; as many as there are targets."""
    state = job_state(read_events(spark, path).filter(F.col("job_id") == job))
    return {row["name"] for row in state.filter("kind = 'table' AND status IN ('loaded', 'skipped')").select("name").collect()}


def sources_loaded(mappings: MappingSet, targets: Iterable[str], result: LoadResult) -> set[str]:
    """The source tables of which every one of ``targets`` that reads them was loaded or had no rows."""
    done = {*result.names("loaded"), *result.names("skipped")}
    open_ = {table for name in targets if name not in done for table in mappings.sources_of(name)}
    return mappings.required_tables() - open_


def joined_with(mappings: MappingSet, failures: Iterable[tuple]) -> dict[str | None, set[str]]:
    """By database, the tables whose rows would miss related rows of a source that could not be opened; None is all of them."""
    out: dict[str | None, set[str]] = {}
    for failure in failures:
        database, table = (None, failure[0]) if len(failure) == 2 else failure[:2]
        for mapping in mappings.fed_by(table):
            out.setdefault(database, set()).update(mapping.sources)
    return out


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _append_metrics(
    spark: SparkSession, path: str, job: str, reached: str, result: LoadResult, extracted: int, unopened: int
) -> None:
    """One row per phase that was reached, in the form ``run_metrics`` reads."""
    rows = []
    for phase in PHASES[: PHASES.index(reached) + 1]:
        ended = phase != reached or (phase == "loading" and bool(result.rows) and result.success)
        parsed = sum(r[2] or 0 for r in result.rows)
        records = {"extraction": extracted, "transformation": parsed, "loading": result.total_records}[phase]
        failed = {"extraction": unopened, "transformation": 0, "loading": len(result.names("failed"))}[phase]
        rows.append((job, phase, ended, records, failed))
    schema = "run_id string, phase string, success boolean, records bigint, failed_tables bigint"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def run_from(
    spark: SparkSession, frames: Mapping[str, DataFrame], store: StarStore, *, mappings: MappingSet = TARGETS, **options
) -> LoadResult:
    """A run from stored frames: targets are loaded as they are, source tables are transformed first."""
    names = set(mappings.names())
    if frames and set(frames) <= names:
        strategy = options.pop("strategy", "bulk")
        return load_all(store, frames, strategy, mappings, mode=options.pop("mode", "append"))
    return run(spark, frames, store, mappings=mappings, **options)
