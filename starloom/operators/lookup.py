"""First-match lookup joins.

A main row takes the first related row with its key, and the first related row of all
where none matches. The main table keeps its cardinality. Related tables are brought to
one row per key before the join, with map-side combine, so a key that holds a third of a
related table costs one row per task. The key comparison is null-safe; Spark plans it as
an equi-join on derived keys, whose shuffle AQE may split where the main side is skewed.

Whether the main table has to be shuffled depends on the size of the reduced side, which
Spark only knows in advance for small inputs. For larger ones the reduced side is stored
and measured first: it is broadcast if it fits, and otherwise joined by shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starloom.session import auto_broadcast_bytes, cut, estimated_bytes

# A related side is broadcast by hint only below this measured size.
BROADCAST_BYTES = 32 * 1024 * 1024


@dataclass(frozen=True)
class Lookup:
    """A related table, the fields to take from it and the order that says which row is first.

    ``order_by`` must tell rows with the same key apart. Without ``key`` the lookup always
    gives the first row. ``on_miss`` is ``first`` or ``null``.
    """

    related: DataFrame
    fields: Mapping[str, str]
    order_by: Sequence[str]
    key: str | None = None
    on_miss: str = "first"

    def value(self) -> Column:
        return F.struct(*[F.col(source).alias(target) for target, source in self.fields.items()])

    def order(self) -> Column:
        # A struct is never NULL, so rows with a NULL order value take part and come first.
        return F.struct(*[F.col(name) for name in self.order_by])


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each key."""
    return _extreme_per_key(df, keys, order_by, F.min_by)


def last_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of each key, whole: NULLs in it replace earlier values."""
    return _extreme_per_key(df, keys, order_by, F.max_by)


def _extreme_per_key(df, keys, order_by, pick) -> DataFrame:
    order = F.struct(*[F.col(name) for name in order_by])
    rest = [name for name in df.columns if name not in keys]
    picked = df.groupBy(*keys).agg(pick(F.struct(*rest), order).alias("_picked"))
    return picked.select(*keys, "_picked.*").select(*df.columns)


def broadcast_checked(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows; ``df`` should be stored already."""
    size = df.select(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("n")).first()["n"] or 0
    return F.broadcast(df) if size <= limit else df


def undecided(df: DataFrame) -> bool:
    """Whether Spark may broadcast, but cannot tell yet if ``df`` is small enough."""
    threshold = auto_broadcast_bytes(df.sparkSession)
    return 0 <= threshold < estimated_bytes(df)


def _ranked(lookup: Lookup, name: str, passing: Sequence[Column]) -> DataFrame:
    """The related rows as (value, order) beside the passing columns."""
    return lookup.related.select(
        *passing, lookup.value().alias(f"_value_{name}"), lookup.order().alias(f"_order_{name}")
    )


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _firsts(names) -> list[Column]:
    # min_by skips rows whose order is NULL, that is the rows of the other lookups.
    return [F.min_by(f"_value_{name}", f"_order_{name}").alias(f"_value_{name}") for name in names]


def lookup_join(
    main: DataFrame,
    lookups: Mapping[str, Lookup],
    scope: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``main`` with one struct column ``_hit_<name>`` per lookup.

    All lookups on the same key share one join. ``scope`` names columns, such as the
    database, within which lookups stay.
    """
    keyed: dict[tuple, dict[str, Lookup]] = {}
    for name, lookup in lookups.items():
        if lookup.key and lookup.key in main.columns and lookup.key in lookup.related.columns:
            dtype = lookup.related.schema[lookup.key].dataType
            keyed.setdefault((lookup.key, dtype.simpleString()), {})[name] = lookup
    falling = [name for name, lookup in lookups.items() if lookup.on_miss == "first"]

    out = main
    # Related rows by lookup, for the first of all; once reduced and stored, from there.
    ranked = {name: _ranked(lookups[name], name, [F.col(c) for c in scope]) for name in falling}
    for number, ((key, _), group) in enumerate(keyed.items()):
        by_key = [F.col(c) for c in scope] + [F.col(key).alias("_key")]
        rows = _stack([_ranked(lookup, name, by_key) for name, lookup in group.items()])
        orders = [F.min(f"_order_{name}").alias(f"_order_{name}") for name in group if name in falling]
        reduced = rows.groupBy(*scope, "_key").agg(*_firsts(group), *orders)
        names = {c: f"_scope_{number}_{c}" for c in scope}

        def join_side(df: DataFrame) -> DataFrame:
            matches = [F.col(f"_value_{name}").alias(f"_match_{name}") for name in group]
            return df.select(*[F.col(c).alias(alias) for c, alias in names.items()], "_key", *matches)

        side = join_side(reduced)
        if undecided(side):
            reduced = cut(reduced)
            side = broadcast_checked(join_side(reduced), broadcast_bytes)
            for name in group:
                if name in falling:
                    ranked[name] = reduced.select(*scope, f"_value_{name}", f"_order_{name}")
        condition = F.col(key).eqNullSafe(F.col("_key"))
        for c, alias in names.items():
            condition = condition & (F.col(c) == F.col(alias))
        out = out.join(side, condition, "left").drop("_key", *names.values())

    matched = {name for group in keyed.values() for name in group}
    fallback: dict[str, Column] = {}
    if falling and scope:
        # One row per scope value.
        rows = _stack([ranked[name] for name in falling]).groupBy(*scope).agg(*_firsts(falling))
        if undecided(rows):
            rows = broadcast_checked(cut(rows), broadcast_bytes)
        out = out.join(rows, list(scope), "left")
        fallback = {name: F.col(f"_value_{name}") for name in falling}
    elif falling:
        fallback = {name: ranked[name].agg(*_firsts([name])).scalar() for name in falling}

    hits = []
    for name in lookups:
        # The struct decides, not its fields: a match with NULL fields is a match.
        options = [F.col(f"_match_{name}")] if name in matched else []
        options += [fallback[name]] if name in fallback else []
        hit = F.coalesce(*options) if options else F.lit(None).cast(_value_type(lookups[name]))
        hits.append(hit.alias(f"_hit_{name}"))
    return out.select(*main.columns, *hits)


def _value_type(lookup: Lookup):
    return lookup.related.select(lookup.value().alias("v")).schema["v"].dataType
