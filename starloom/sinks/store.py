"""The star schema at rest: versioned Parquet tables, known to the catalog and to later sessions."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from threading import Lock
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starloom.operators.load import compare_schemas, conform, infer_target_schema, upsert
from starloom.operators.ranges import interleaved
from starloom.plans.spec import LOAD_TIME, TargetMapping
from starloom.sinks import files

#: Hidden partition columns: the bucket of the key, and the load that wrote a folder.
BUCKET, LOAD = "_bucket", "_load"
#: Tries of a commit that meets another one.
TRIES = 10
_HERE = Lock()


def write_clustered(
    df: DataFrame, columns: Sequence[str], path: str, *, tie: Sequence[str] = (), mode="overwrite", together: bool = False
) -> None:
    """Parquet in range partitions of the cluster columns, sorted within, so that min/max prune files.

    ``tie`` columns, such as the key, split a value that holds a large part of the rows.
    """
    clustered(df, columns, tie=tie, together=together).write.mode(mode).parquet(path)


def clustered(df: DataFrame, columns: Sequence[str], *, tie: Sequence[str] = (), together: bool = False) -> DataFrame:
    """Rows in ranges of the columns, the first one decides; with ``together`` all columns count alike.

    Then the order is that of the columns' ranges with their bits interleaved, so that a filter
    on any one of them leaves files out, where the other order does so for the first one only.
    """
    order = [c for c in dict.fromkeys((*columns, *tie)) if c in df.columns]
    if not order:
        return df
    near = [c for c in columns if c in df.columns]
    if not together or len(near) < 2:
        return df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = df.withColumn("_near", interleaved(df, near))
    return rows.repartitionByRange("_near", *order).sortWithinPartitions("_near", *order).drop("_near")


@dataclass(frozen=True)
class Target:
    """Where results go: files by format, or a database by JDBC or a connector's format."""

    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def __repr__(self) -> str:  # options may hold credentials
        return f"Target({self.format!r})"

    def write(self, df: DataFrame, table: str, mode: str = "append") -> None:
        writer = df.write.format(self.format).options(**self.options).mode(mode)
        if self.format == "jdbc":
            writer.option("dbtable", table).save()
        elif "path" in self.options:
            writer.option("path", f"{self.options['path'].rstrip('/')}/{table}").save()
        else:
            writer.option("dbtable", table).save()


@dataclass(frozen=True)
class Version:
    """A table as it is now: its schema, where its files are, and which batches it has taken in.

    A table with partitions or buckets is a set of ``folders`` below its location, one for each
    partition, bucket and load; another one is all of its location.
    """

    number: int
    location: str
    schema: T.StructType
    partitions: tuple[str, ...] = ()
    buckets: int = 0
    key: tuple[str, ...] = ()
    folders: tuple[str, ...] = ()
    batches: Mapping[str, int] = field(default_factory=dict)

    @property
    def in_folders(self) -> bool:
        return bool(self.partitions or self.buckets)

    @property
    def layout(self) -> list[str]:
        """The partition columns of the files, hidden ones included."""
        if not self.in_folders:
            return []
        return [*self.partitions, *([BUCKET] if self.buckets else []), LOAD]

    def values(self, folder: str) -> dict[str, str | None]:
        """A folder's partition values as text."""
        pairs = [part.split("=", 1) for part in folder.split("/")]
        return {name: None if value == "__HIVE_DEFAULT_PARTITION__" else unquote(value) for name, value in pairs}

    def file_schema(self) -> T.StructType:
        hidden = {BUCKET: T.IntegerType(), LOAD: T.StringType()}
        return T.StructType([*self.schema, *[T.StructField(c, hidden[c]) for c in self.layout if c in hidden]])

    def text(self) -> str:
        return json.dumps({
            "location": self.location, "schema": self.schema.jsonValue(), "partitions": self.partitions, "buckets": self.buckets,
            "key": self.key, "folders": self.folders, "batches": dict(self.batches),
        })

    @classmethod
    def read(cls, number: int, text: str) -> Version:
        x = json.loads(text)
        return cls(
            number, x["location"], T.StructType.fromJson(x["schema"]), tuple(x["partitions"]), x["buckets"], tuple(x["key"]),
            tuple(x["folders"]), x["batches"],
        )


class StarStore:
    """Target tables below one root, as Parquet, and in a catalog database for SQL.

    Beside the data, each table has a small file per version (``_versions/<table>/<number>.json``)
    that says what the table is. A change writes new files first and then adds the next version
    under its own name, which fails if another writer was first. So a reader sees one version
    or the next, a load that dies in between changes nothing, and a later session, or another
    process, finds the tables by their root. Earlier files stay for readers that are still at
    work until ``drop_old_versions`` removes them. Whoever inserts by SQL writes into the files
    of a table without partitions; its other versions come from here alone.
    """

    def __init__(self, spark: SparkSession, database: str, root: str):
        self.spark = spark
        self.database = database
        self.root = root.rstrip("/")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        for table in self.tables():
            if not spark.catalog.tableExists(f"{database}.{table}"):
                self._define(table, self.version(table))

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table.lower()}`"

    # Versions

    def _versions(self, table: str) -> str:
        return f"{self.root}/_versions/{table.lower()}"

    def version(self, table: str) -> Version:
        found = files.matching(self.spark, f"{self._versions(table)}/*.json")
        if not found:
            raise ValueError(f"no table {table}")
        return Version.read(_number(found[-1]), files.read_text(self.spark, found[-1]))

    def _commit(self, table: str, made: Version) -> bool:
        """Add a version; False if there is one of its number already."""
        return files.create_text(self.spark, f"{self._versions(table)}/{made.number:012d}.json", made.text())

    def _change(self, table: str, change: Callable[[Version], Version], based_on: Version | None = None) -> Version:
        """Add the next version, as ``change`` makes it of the current one.

        ``based_on`` is the version that was read. If others came meanwhile, ``change`` is made on
        theirs, provided it is still possible there, which it has to tell by an error.
        """
        now = based_on or self.version(table)
        for _ in range(TRIES):
            made = replace(change(now), number=now.number + 1)
            with _HERE:
                done = self._commit(table, made)
            if done:
                self._show(table, now, made)
                return made
            now = self.version(table)
        raise RuntimeError(f"{table}: other writers were first, {TRIES} times")

    def _define(self, table: str, version: Version) -> None:
        """The catalog's entry of a version."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        columns = ", ".join(_column(f) for f in version.file_schema())
        parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in version.layout)}) " if version.layout else ""
        self.spark.sql(f"CREATE TABLE {self.name(table)} ({columns}) USING parquet {parts}LOCATION '{version.location}'")
        self._partitions(table, "ADD IF NOT EXISTS", version, version.folders)

    def _partitions(self, table: str, verb: str, version: Version, folders: Iterable[str]) -> None:
        specs = [
            "PARTITION (" + ", ".join(f"`{c}`={_literal(v)}" for c, v in version.values(folder).items()) + ")" for folder in folders
        ]
        for k in range(0, len(specs), 200):
            separator = ", " if verb.startswith("DROP") else " "
            self.spark.sql(f"ALTER TABLE {self.name(table)} {verb} {separator.join(specs[k : k + 200])}")

    def _show(self, table: str, before: Version, after: Version) -> None:
        """Bring the catalog from one version to another."""
        if before.schema != after.schema or (before.in_folders and before.location != after.location):
            self._define(table, after)
        elif after.in_folders:
            # The new ones first: a query in between sees a row twice rather than never.
            self._partitions(table, "ADD IF NOT EXISTS", after, [f for f in after.folders if f not in set(before.folders)])
            self._partitions(table, "DROP IF EXISTS", before, [f for f in before.folders if f not in set(after.folders)])
        elif before.location != after.location:
            self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{after.location}'")
        self.spark.catalog.refreshTable(f"{self.database}.{table.lower()}")

    # Reading

    def exists(self, table: str) -> bool:
        return bool(files.matching(self.spark, f"{self._versions(table)}/*.json"))

    def tables(self) -> list[str]:
        return sorted({path.rsplit("/", 2)[1] for path in files.matching(self.spark, f"{self.root}/_versions/*/*.json")})

    def read(self, table: str) -> DataFrame:
        version = self.version(table)
        return self._rows(version, version.folders).select(*version.schema.names)

    def _rows(self, version: Version, folders: Sequence[str]) -> DataFrame:
        reader = self.spark.read.schema(version.file_schema())
        if not version.in_folders:
            return reader.parquet(version.location)
        if not folders:
            return self.spark.createDataFrame([], version.file_schema())
        return reader.option("basePath", version.location).parquet(*[f"{version.location}/{f}" for f in folders])

    def frames(self) -> dict[str, DataFrame]:
        return {table: self.read(table) for table in self.tables()}

    def partition_columns(self, table: str) -> list[str]:
        return list(self.version(table).partitions)

    # Tables

    def _new_location(self, table: str) -> str:
        location = f"{self.root}/{table.lower()}/v-{uuid4().hex}"
        files.make_folder(self.spark, location)
        return location

    def ensure_table(
        self,
        table: str,
        schema: T.StructType,
        defaults: Mapping[str, object] | None = None,
        partition_by: Sequence[str] = (),
        *,
        key: Sequence[str] = (),
        buckets: int = 0,
    ) -> bool:
        """Create the table if it is not there; True if it was created.

        With ``buckets`` its rows are dealt by ``key`` to so many folders (of each partition), and
        an upsert by that key rewrites only the folders its rows fall into.
        """
        if self.exists(table):
            return False
        if buckets and not key:
            raise ValueError("buckets need a key")
        clauses = []
        for item in schema:
            value = (defaults or {}).get(item.name)
            default = f" DEFAULT {str(value).upper()}" if value is not None else ""
            if item.name == LOAD_TIME:
                default = " DEFAULT current_timestamp()"
            clauses.append(f"`{item.name}` {item.dataType.simpleString()}{default}")
        location = self._new_location(table)
        # The catalog turns the defaults into what readers of older files go by.
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        self.spark.sql(f"CREATE TABLE {self.name(table)} ({', '.join(clauses)}) USING parquet LOCATION '{location}'")
        known = self.spark.table(f"{self.database}.{table.lower()}").schema
        ordered = [*[f for f in known if f.name not in partition_by], *[known[c] for c in partition_by]]
        made = Version(0, location, T.StructType(ordered), tuple(partition_by), buckets, tuple(key) if buckets else ())
        files.make_folder(self.spark, self._versions(table))
        if not self._commit(table, made):
            return False  # another writer was first
        if made.in_folders:
            self._define(table, made)
        return True

    def ensure_target(self, mapping: TargetMapping) -> bool:
        return self.ensure_table(mapping.name, mapping.schema, mapping.defaults)

    def ensure_for(
        self, table: str, df: DataFrame, mapping: TargetMapping | None = None, partition_by: Sequence[str] = (), *, buckets: int = 0
    ) -> bool:
        """Create the table from the declaration, or inferred, or widen it where needed; True if created.

        A partition column the declaration lacks is added to it.
        """
        schema = mapping.schema if mapping else infer_target_schema(df)
        extra = [T.StructField(c, df.schema[c].dataType) for c in partition_by if c not in schema.names]
        schema = T.StructType([*schema, *extra])
        key = (*mapping.primary_key, *partition_by) if mapping else ()
        created = self.ensure_table(
            table, schema, mapping.defaults if mapping else {}, partition_by, key=key, buckets=buckets if key else 0
        )
        if not created:
            self.evolve(table, schema)
        return created

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        files.remove(self.spark, self._versions(table))

    def evolve(self, table: str, expected: T.StructType, on_mismatch: str = "cast") -> list[str]:
        """Add missing columns; the new column names.

        A column of another type is rewritten with a cast, where what does not convert
        reads NULL. ``on_mismatch="recreate"`` starts an empty table instead, and
        ``"fail"`` raises. Partitions, buckets and defaults stay.
        """
        now = self.version(table)
        compared = compare_schemas(expected, now.schema)
        mismatched = [row for row in compared if row[1] == "mismatch"]
        if mismatched and on_mismatch == "fail":
            raise ValueError(f"{table}: " + ", ".join(f"{c} is {a}, not {e}" for c, _, e, a in mismatched))
        missing = [row[0] for row in compared if row[1] == "missing"]
        types = {f.name.lower(): f.dataType for f in expected}
        if not missing and not mismatched:
            return []
        if mismatched and on_mismatch == "recreate":
            defaults = {f.name.lower(): f.metadata for f in now.schema}
            fields = [T.StructField(f.name, f.dataType, True, defaults.get(f.name.lower(), {})) for f in expected]
            location = self._new_location(table)
            schema = T.StructType([*[f for f in fields if f.name not in now.partitions], *[now.schema[c] for c in now.partitions]])
            self._change(table, lambda v: replace(v, schema=schema, location=location, folders=()), now)
            return []
        off = {"CURRENT_DEFAULT": "false", "EXISTS_DEFAULT": "false"}
        added = [T.StructField(c, types[c], True, off if isinstance(types[c], T.BooleanType) else {}) for c in missing]
        wanted = {row[0]: types[row[0]] for row in mismatched}
        fields = [T.StructField(f.name, wanted.get(f.name.lower(), f.dataType), True, f.metadata) for f in now.schema]
        tail = len(fields) - len(now.partitions)
        schema = T.StructType([*fields[:tail], *added, *fields[tail:]])
        if mismatched:
            made = replace(now, schema=schema, location=self._new_location(table))
            rows = conform(self._rows(now, now.folders), T.StructType(fields))
            # What older files would read: the default.
            rows = rows.withColumns({f.name: F.lit(False) for f in added if f.metadata})
            folders = self._write(made, self._by_name(rows, schema), made.location)
            self._change(table, _only(now, replace(made, folders=folders)), now)
        else:
            self._change(table, lambda v: replace(v, schema=schema), now)
        return missing

    # Writing

    @staticmethod
    def _by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
        given = {name.lower(): name for name in df.columns}
        return df.select(
            *[
                (F.col(given[f.name.lower()]).cast(f.dataType) if f.name.lower() in given else F.lit(None).cast(f.dataType))
                .alias(f.name)
                for f in schema
            ]
        )

    @staticmethod
    def _bucket(version: Version) -> Column:
        """The bucket of a row's key; rows without a whole key never meet another and are spread."""
        whole = F.pmod(F.xxhash64(*version.key), F.lit(version.buckets))
        if not version.key:
            return F.lit(0)
        spread = F.pmod(F.xxhash64(*version.schema.names), F.lit(version.buckets))
        return F.when(reduce(Column.__and__, [F.col(c).isNotNull() for c in version.key]), whole).otherwise(spread).cast("int")

    def laid_out(self, version: Version, df: DataFrame, load: str) -> DataFrame:
        """Rows with the hidden columns of the table's folders."""
        if not version.in_folders:
            return df
        if version.buckets:
            df = df.withColumn(BUCKET, self._bucket(version))
        return df.withColumn(LOAD, F.lit(load))

    def _write(self, version: Version, rows: DataFrame, location: str) -> tuple[str, ...]:
        """Write rows that have the table's columns; the folders they are in."""
        load = uuid4().hex
        rows = self.laid_out(version, rows, load)
        if not version.in_folders:
            rows.write.mode("append").parquet(location)
            return ()
        dealt = [c for c in version.layout if c != LOAD]
        rows = rows.hint("rebalance", *[F.col(c) for c in dealt])
        # A folder of its own for the job, as jobs that write below one folder disturb each other.
        draft = f"{location}/_draft-{load}"
        try:
            with files.open_files(rows.sparkSession):
                rows.write.partitionBy(*version.layout).parquet(draft)
            return self._take(version, draft, location, load)
        finally:
            files.remove(self.spark, draft)

    def _take(self, version: Version, path: str, location: str, load: str) -> tuple[str, ...]:
        """Rename a load's folders into a table's location; what they are called there."""
        folders = self._folders(version, path, load)
        for folder in folders:
            files.move(self.spark, f"{path}/{folder}", f"{location}/{folder}")
        return folders

    def _folders(self, version: Version, location: str, load: str) -> tuple[str, ...]:
        stars = "/".join("*" for _ in version.layout[:-1])
        found = files.matching(self.spark, f"{location}/{stars}/{LOAD}={load}")
        return tuple("/".join(path.rstrip("/").rsplit("/", len(version.layout))[1:]) for path in found)

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows by column name; columns the table lacks are left out, absent ones read NULL."""
        now = self.version(table)
        folders = self._write(now, self._by_name(df, now.schema), now.location)
        self._appended(table, now, folders)

    def adopt(self, table: str, path: str, load: str) -> None:
        """Take over files that were written for the table's layout by load ``load``, as they are, by renaming them."""
        now = self.version(table)
        folders = ()
        if now.in_folders:
            folders = self._take(now, path, now.location, load)
        else:
            for part in files.matching(self.spark, f"{path}/part-*"):
                files.move(self.spark, part, f"{now.location}/{part.rsplit('/', 1)[-1]}")
        self._appended(table, now, folders)

    def _appended(self, table: str, now: Version, folders: tuple[str, ...]) -> None:
        if now.in_folders:
            self._change(table, lambda v: replace(v, folders=(*v.folders, *folders)), now)
        else:
            self.spark.catalog.refreshTable(f"{self.database}.{table.lower()}")

    def upsert(
        self,
        table: str,
        df: DataFrame,
        key: Sequence[str],
        order_by: Sequence[str],
        *,
        cluster_by: Sequence[str] = (),
        batch: tuple[str, int] | None = None,
    ) -> bool:
        """Replace by key and add; False if the batch was taken in before.

        If the table is partitioned by columns of the key, or has buckets of it, a row stays in
        its folder, and only folders that get rows are written anew; the files of the others
        stay as they are. Writers of different folders don't wait for each other; one that
        meets another in the same folder starts again. ``batch`` is the name of a stream and the
        number of its batch: the table remembers the last one with the rows themselves.
        """
        for _ in range(TRIES):
            now = self.version(table)
            if batch and now.batches.get(batch[0], -1) >= batch[1]:
                return False
            try:
                self._upsert(table, now, df, key, order_by, cluster_by, dict([batch] if batch else []))
                return True
            except _Met:
                continue
        raise RuntimeError(f"{table}: other writers were first, {TRIES} times")

    def _upsert(self, table, now: Version, df, key, order_by, cluster_by, batches) -> None:
        # An upsert by another key than the buckets' may find a key in any folder.
        fixed = [c for c in now.partitions if c in key] + ([BUCKET] if now.buckets and set(now.key) <= set(key) else [])
        old = now.folders
        if fixed:
            typed = self._by_name(df, now.schema)
            typed = typed.withColumn(BUCKET, self._bucket(now)) if BUCKET in fixed else typed
            # At most as many rows as the table has partitions times buckets.
            touched = {tuple(row) for row in typed.select(*[F.col(c).cast("string") for c in fixed]).distinct().collect()}
            if not touched:
                return
            where = {f: tuple(now.values(f)[c] for c in fixed) for f in now.folders}
            old = tuple(f for f in now.folders if where[f] in touched)
        existing = self._rows(now, old).select(*now.schema.names)
        merged = self._by_name(upsert(existing, df, key, order_by), now.schema)
        if now.in_folders:
            new = self._write(now, merged, now.location)

            def change(v: Version) -> Version:
                if v.location != now.location or not set(old) <= set(v.folders):
                    raise _Met
                added = [f for f in v.folders if f not in set(now.folders)]
                if any(not fixed or tuple(v.values(f)[c] for c in fixed) in touched for f in added):
                    raise _Met
                return replace(v, folders=(*[f for f in v.folders if f not in set(old)], *new), batches={**v.batches, **batches})

        else:
            location = self._new_location(table)
            clustered(merged, cluster_by, tie=key).write.mode("append").parquet(location)
            change = _only(now, replace(now, location=location, batches={**now.batches, **batches}))
        self._change(table, change, now)

    def recluster(self, table: str, columns: Sequence[str], *, tie: Sequence[str] = (), together: bool = False) -> None:
        """Rewrite the table in the layout of ``clustered``, as a new version."""
        rows = self.read(table)
        if together and not self.version(table).in_folders:
            now = self.version(table)
            made = replace(now, location=self._new_location(table))
            clustered(rows, columns, tie=tie, together=True).write.mode("append").parquet(made.location)
            self._change(table, _only(now, made), now)
            return
        self.overwrite(table, rows, cluster_by=columns, tie=tie)

    def overwrite(self, table: str, df: DataFrame, *, cluster_by: Sequence[str] = (), tie: Sequence[str] = ()) -> None:
        """All rows anew; partitions and buckets stay."""
        now = self.version(table)
        rows = self._by_name(df, now.schema)
        if now.in_folders:
            made = replace(now, location=self._new_location(table))
            order = [c for c in dict.fromkeys((*cluster_by, *tie)) if c in rows.columns]
            load = uuid4().hex
            rows = self.laid_out(made, rows, load)
            dealt = [c for c in made.layout if c != LOAD]
            rows = rows.repartitionByRange(*dealt, *order).sortWithinPartitions(*dealt, *order) if order else rows.hint(
                "rebalance", *[F.col(c) for c in dealt]
            )
            with files.open_files(rows.sparkSession):
                rows.write.mode("append").partitionBy(*made.layout).parquet(made.location)
            made = replace(made, folders=self._folders(made, made.location, load))
        else:
            made = replace(now, location=self._new_location(table))
            clustered(rows, cluster_by, tie=tie).write.mode("append").parquet(made.location)
        self._change(table, _only(now, made), now)

    def compact(self, table: str, most: int = 1) -> int:
        """Write the partitions and buckets of more than ``most`` folders anew, one folder each; how many there were."""
        now = self.version(table)
        if not now.in_folders:
            self.overwrite(table, self.read(table).hint("rebalance"))
            return 1
        where: dict[tuple, list[str]] = {}
        for folder in now.folders:
            values = now.values(folder)
            where.setdefault(tuple(values[c] for c in now.layout[:-1]), []).append(folder)
        many = [f for folders in where.values() if len(folders) > most for f in folders]
        if not many:
            return 0
        new = self._write(now, self._rows(now, many).select(*now.schema.names), now.location)

        def change(v: Version) -> Version:
            if v.location != now.location or not set(many) <= set(v.folders):
                raise RuntimeError(f"{table} was changed while it was compacted")
            return replace(v, folders=(*[f for f in v.folders if f not in set(many)], *new))

        self._change(table, change, now)
        return len(where) - sum(len(folders) <= most for folders in where.values())

    def clear(self, tables: Sequence[str] | None = None) -> DataFrame:
        """Remove all rows, keep schemas, partitions and buckets; (table, cleared, left) per table."""
        names = list(tables) if tables is not None else self.tables()
        rows = []
        for table in names:
            before = self.read(table).count()
            location = self._new_location(table)
            self._change(table, lambda v, location=location: replace(v, location=location, folders=()))
            rows.append((table, before, self.read(table).count()))
        return self.spark.createDataFrame(rows, "table string, cleared bigint, left bigint")

    def staging(self, table: str) -> str:
        """A fresh folder for rows on their way into a table."""
        return f"{self.root}/_staging/{table.lower()}-{uuid4().hex}"

    def remove(self, path: str) -> None:
        files.remove(self.spark, path)

    def drop_old_versions(self, table: str, keep: int = 2) -> int:
        """Remove what only versions before the newest ``keep`` need: their files and folders; how many.

        Files that no version knows are those of loads at work, or of loads that died; they stay.
        """
        found = files.matching(self.spark, f"{self._versions(table)}/*.json")
        versions = [Version.read(_number(path), files.read_text(self.spark, path)) for path in found]
        kept, old = versions[-max(1, keep) :], versions[: -max(1, keep)]
        whole = {v.location for v in kept}
        parts = {f"{v.location}/{f}" for v in kept for f in v.folders}
        stale = {v.location for v in old if v.location not in whole}
        stale |= {f"{v.location}/{f}" for v in old for f in v.folders if v.location in whole} - parts
        for path in sorted(stale):
            files.remove(self.spark, path)
        for path in found[: len(old)]:
            files.remove(self.spark, path)
        return len(stale)


class _Met(RuntimeError):
    """Another writer changed what this one was based on."""


def _only(now: Version, made: Version) -> Callable[[Version], Version]:
    """A change of the whole table, which is possible on the version it was made of alone."""

    def change(version: Version) -> Version:
        if version.number != now.number:
            raise _Met(f"version {version.number} came first")
        return made

    return change


def _number(path: str) -> int:
    return int(path.rsplit("/", 1)[-1].split(".")[0])


def _column(f: T.StructField) -> str:
    default = f.metadata.get("CURRENT_DEFAULT") if f.metadata else None
    return f"`{f.name}` {f.dataType.simpleString()}" + (f" DEFAULT {default}" if default else "")


def _literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
