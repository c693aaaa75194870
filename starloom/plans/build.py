"""From source tables to star-schema targets: one plan per target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starloom.functions.clean import sanitize, stamp
from starloom.operators.lookup import Lookup, lookup_join
from starloom.operators.project import clean_mapped, drop_empty_rows, fan_out, missing
from starloom.operators.sets import DATABASE, union_all
from starloom.plans.spec import MappingSet, TargetMapping
from starloom.plans.targets import JOIN_KEYS

POSITION = "_pos"


def table_availability(tables: Mapping[str, DataFrame]) -> dict[str, frozenset]:
    """Which databases hold rows of which table; None stands for frames without a database.

    The result is as large as the catalog, one entry per table and database. On a layout
    partitioned by database the distinct reads partition values only.
    """
    held: dict[str, set] = {name: set() for name in tables}
    scoped = {name: df for name, df in tables.items() if DATABASE in df.columns}
    if scoped:
        pairs = union_all(
            df.select(F.lit(name).alias("table"), F.col(DATABASE).alias("database")).distinct()
            for name, df in scoped.items()
        )
        for row in pairs.collect():
            held[row["table"]].add(row["database"])
    for name, df in tables.items():
        if name not in scoped and not df.isEmpty():
            held[name].add(None)
    return {name: frozenset(databases) for name, databases in held.items()}


def main_order(mapping: TargetMapping) -> list[str]:
    """The sources by claim to be the main table: the owner of the first key column, then as listed."""
    owner, _ = mapping.field_of(mapping.key[0]) if mapping.key and mapping.key[0] in mapping.columns else (None, "")
    return sorted(mapping.sources, key=lambda table: table != owner)


def choose_main(mapping: TargetMapping, available: Sequence[str]) -> str | None:
    return next((table for table in main_order(mapping) if table in available), None)


def build_target(
    mapping: TargetMapping,
    tables: Mapping[str, DataFrame],
    *,
    available: Mapping[str, frozenset] | None = None,
    on_miss: str = "first",
    join_keys: Mapping[frozenset, str] = JOIN_KEYS,
    position: Sequence[str] = (POSITION,),
    etl_timestamp: datetime | None = None,
    stamped: bool = True,
) -> DataFrame | None:
    """The target from its source tables, or None if no source has rows.

    Frames with a ``_database`` column are joined within each database, and each database
    takes the first of its filled sources as main table. A related frame without one belongs to
    all databases, and a main one without is joined with the rows of all. ``position`` names
    the columns that order related rows.
    """
    present = {name: tables[name] for name in mapping.sources if name in tables}
    held = available if available is not None else table_availability(present)
    scope = (DATABASE,) if any(DATABASE in df.columns for df in present.values()) else ()
    branches: list[DataFrame] = []
    served: set = set()
    for table in main_order(mapping):
        databases = held.get(table, frozenset()) - served
        if served:
            # What belongs to all databases is no further one of them.
            databases -= {None}
        if table not in present or not databases or None in served:
            continue
        main = present[table]
        if scope and databases != held[table]:
            main = main.filter(F.col(DATABASE).isin(*databases))
        # A table with no rows in these databases has nothing to look up.
        common = None in databases
        related = {
            name: df for name, df in present.items()
            if name != table and (rows := held.get(name, frozenset())) and (common or None in rows or rows & databases)
        }
        served |= databases
        if _reads_any(mapping, table, main, related):
            branches.append(_join_sources(mapping, table, main, related, scope, on_miss, join_keys, position))
    if not branches:
        return None
    out = _typed(union_all(branches), mapping)
    return stamp(out, etl_timestamp) if stamped else out


def _typed(df: DataFrame, mapping: TargetMapping) -> DataFrame:
    """Columns no branch had a source for, in their declared type."""
    void = [f.name for f in df.schema if isinstance(f.dataType, T.NullType)]
    return df.withColumns({name: missing(mapping, name) for name in void}) if void else df


def _reads_any(mapping, table, main, related) -> bool:
    """Whether any target column has a source here; if not, every row would be dropped as empty."""
    for target in mapping.columns:
        owner, source = mapping.field_of(target)
        if callable(source) or (owner in (None, table) and source in main.columns):
            return True
        if owner in related and source in related[owner].columns:
            return True
    return False


def _join_sources(mapping, table, main, related, scope, on_miss, join_keys, position) -> DataFrame:
    wanted: dict[str, dict[str, str]] = {}
    for target in mapping.columns:
        owner, source = mapping.field_of(target)
        if owner in related and not callable(source) and source in related[owner].columns:
            wanted.setdefault(owner, {})[target] = source
    lookups = {
        owner: Lookup(related[owner], fields, position, join_keys.get(frozenset((table, owner))), on_miss)
        for owner, fields in wanted.items()
    }
    scope = tuple(c for c in scope if c in main.columns)
    scoped = {owner: x for owner, x in lookups.items() if scope and DATABASE in x.related.columns}
    shared = {owner: x for owner, x in lookups.items() if owner not in scoped}
    joined = lookup_join(main, scoped, scope) if scoped else main
    joined = lookup_join(joined, shared) if shared else joined

    columns: list[Column] = []
    for target in mapping.columns:
        owner, source = mapping.field_of(target)
        if callable(source):
            columns.append(source().alias(target))
        elif owner in (None, table) and source in main.columns:
            dtype = main.schema[source].dataType
            columns.append(clean_mapped(mapping, target, F.col(source), dtype).alias(target))
        elif target in wanted.get(owner, {}):
            dtype = related[owner].schema[source].dataType
            value = F.col(f"_hit_{owner}").getField(target)
            columns.append(clean_mapped(mapping, target, value, dtype).alias(target))
        else:
            columns.append(F.lit(None).alias(target))
    mapped = joined.select(*[F.col(c) for c in scope], *columns)
    return sanitize(drop_empty_rows(mapped, list(mapping.columns)))


def fan_out_all(mappings: MappingSet, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every target from single tables, without joins: each table adds its rows to all targets it feeds."""
    parts: dict[str, list[DataFrame]] = {}
    for table, df in tables.items():
        for name, rows in fan_out(table, df, mappings).items():
            parts.setdefault(name, []).append(sanitize(rows))
    return {name: union_all(frames) for name, frames in parts.items()}


def build_all(
    mappings: MappingSet,
    tables: Mapping[str, DataFrame],
    *,
    available: Mapping[str, frozenset] | None = None,
    **options,
) -> dict[str, DataFrame]:
    """Every target that has source rows; the sources are probed once for all of them."""
    needed = {name: df for name, df in tables.items() if name in mappings.required_tables()}
    held = available if available is not None else table_availability(needed)
    built = {m.name: build_target(m, needed, available=held, **options) for m in mappings}
    return {name: df for name, df in built.items() if df is not None}
