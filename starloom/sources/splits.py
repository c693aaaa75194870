"""Ranges of a key for reads of one large table by many connections.

Equal ranges of a key hold unequal numbers of rows where keys are uneven. So the database counts
its rows in equal ranges of the key first, ranges that hold too much are counted more finely, and
neighbours are put together to splits of about the same number of rows. Only counts cross the
connection, as many as there are ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

#: Ranges counted at once, and how often a heavy range is counted more finely.
BINS, DEPTH = 1_000, 6
#: (lowest key, width, number of ranges) to (range, rows) of those that have rows.
Count = Callable[[int, int, int], Sequence[tuple[int, int]]]


@dataclass(frozen=True)
class Split:
    """The keys from ``low`` up to, but without, ``high``."""

    low: int
    high: int
    rows: int

    def predicate(self, key: str) -> str:
        return f"{key} >= {self.low} AND {key} < {self.high}"


def bins(count: Count, low: int, high: int, most: int, ranges: int = BINS, depth: int = DEPTH) -> list[Split]:
    """Ranges of at most ``most`` rows each, unless one key alone has more."""
    width = max(1, -(-(high - low) // ranges))
    out = []
    for number, rows in sorted(count(low, width, -(-(high - low) // width))):
        part = Split(low + number * width, min(high, low + (number + 1) * width), rows)
        if rows > most and part.high - part.low > 1 and depth > 1:
            out += bins(count, part.low, part.high, most, ranges, depth - 1)
        else:
            out.append(part)
    return out


def splits(parts: Sequence[Split], number: int) -> list[Split]:
    """Neighbouring ranges together, ``number`` splits at most, by where the rows before them end."""
    total, before = sum(p.rows for p in parts), 0
    out: dict[int, Split] = {}
    for p in parts:
        k = before * number // total
        out[k] = Split(out[k].low, p.high, out[k].rows + p.rows) if k in out else p
        before += p.rows
    return list(out.values())


def plan(count: Count, low: int | None, high: int | None, rows: int, number: int, ranges: int = BINS) -> list[Split]:
    """At most ``number`` splits of the keys ``low`` to ``high``, both included."""
    if low is None or high is None or number < 1:
        return []
    most = max(1, rows // (2 * number))
    return splits(bins(count, low, high + 1, most, ranges), number)


def predicates(key: str, found: Sequence[Split], nulls: bool = True) -> list[str]:
    """One condition for each split; rows without a key have one of their own."""
    return [*[split.predicate(key) for split in found], *([f"{key} IS NULL"] if nulls or not found else [])]


# Counting


def count_sql(table: str, key: str, low: int, width: int, ranges: int) -> str:
    """The query that counts a range of keys, in plain SQL."""
    number = f"FLOOR(({key} - {low}) / {width})"
    return (
        f"SELECT {number} AS part, COUNT(*) AS n FROM {table} "
        f"WHERE {key} >= {low} AND {key} < {low + width * ranges} GROUP BY {number}"
    )


def stats_sql(table: str, key: str) -> str:
    return f"SELECT MIN({key}) AS low, MAX({key}) AS high, COUNT({key}) AS n, COUNT(*) AS total FROM {table}"


def plan_query(ask: Callable[[str], DataFrame], table: str, key: str, number: int, ranges: int = BINS) -> list[str]:
    """Predicates for a table that answers SQL; ``ask`` runs a query there."""
    stats = ask(stats_sql(table, key)).first()
    count = lambda *of: [(int(r[0]), int(r[1])) for r in ask(count_sql(table, key, *of)).collect()]
    low, high = (None if x is None else int(x) for x in stats[:2])
    return predicates(key, plan(count, low, high, int(stats[2]), number, ranges), int(stats[3]) > int(stats[2]))


def plan_frame(df: DataFrame, key: str, number: int, ranges: int = BINS) -> list[Split]:
    """Splits of a frame's rows."""
    stats = df.agg(F.min(key), F.max(key), F.count(key)).first()

    def count(low: int, width: int, of: int) -> list[tuple[int, int]]:
        inside = df.filter((F.col(key) >= low) & (F.col(key) < low + width * of))
        part = F.floor((F.col(key) - low) / width)
        return [(int(r[0]), int(r[1])) for r in inside.groupBy(part).agg(F.count("*")).collect()]

    return plan(count, stats[0], stats[1], stats[2], number, ranges)
