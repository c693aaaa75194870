"""Unions over databases and files, semi and anti joins on names, pages and samples."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starloom.operators.ranges import bounds_of, range_of, within_range

DATABASE = "_database"
#: Rows before a page that are sorted with it, and ranges that are counted at once to find a deeper one.
SHALLOW, RANGES = 100_000, 64


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames, duplicates kept; a column some frame lacks reads NULL there.

    Neighbours are put together, then these, so the plan of many frames is wide and not deep.
    """
    parts = list(frames)
    while len(parts) > 1:
        pairs = [parts[k : k + 2] for k in range(0, len(parts), 2)]
        parts = [p[0].unionByName(p[1], allowMissingColumns=True) if len(p) > 1 else p[0] for p in pairs]
    return parts[0]


def union_databases(frames: Mapping[str, DataFrame]) -> DataFrame:
    """All rows of all databases, each tagged with its database."""
    return union_all(df.withColumn(DATABASE, F.lit(name)) for name, df in frames.items())


def _values(other: DataFrame, value: Column) -> DataFrame:
    """The distinct values of one side, NULL left out as it equals nothing.

    The joins below compare null-safely: their keys then differ from the key of this
    aggregation, so its result is shuffled for the join, and AQE can split a hot value.
    """
    return other.select(value.alias("_value")).dropna().distinct()


def without(df: DataFrame, other: DataFrame, column: str, other_column: str | None = None) -> DataFrame:
    """The rows whose name is not in ``other``; letter case does not matter."""
    names = _values(other, F.lower(F.col(other_column or column)))
    return df.join(names, F.lower(F.col(column)).eqNullSafe(F.col("_value")), "left_anti")


def within(df: DataFrame, other: DataFrame, column: str, other_column: str | None = None) -> DataFrame:
    """The rows whose value is in ``other``."""
    values = _values(other, F.col(other_column or column))
    return df.join(values, F.col(column).eqNullSafe(F.col("_value")), "left_semi")


def page(df: DataFrame, order_by: Sequence[str], size: int, number: int = 0, shallow: int = SHALLOW) -> DataFrame:
    """One page in a fixed order; the order must tell rows apart.

    A page behind more than ``shallow`` rows is looked up by counts: rows are counted in ranges of
    the first order column, those before the page are left out by a condition that the scan can
    use, and so on with finer ranges, or the next column where one value holds too many. So only
    the rows around the page are sorted.
    """
    offset = size * number
    if offset > shallow:
        df, offset = _around(df, list(order_by), offset, size, shallow)
    return df.orderBy(*order_by).offset(offset).limit(size)


def _around(df: DataFrame, order_by: Sequence[str], offset: int, size: int, shallow: int) -> tuple[DataFrame, int]:
    """The rows around a page, and how many of them are before it."""
    for column in order_by:
        while True:
            bounds = bounds_of(df, column, RANGES)
            counted = _counted(df, column, bounds)
            if len(counted) == 1 and counted[0]["low"] == counted[0]["high"]:
                break  # one value: the next column tells its rows apart
            if len(counted) == 1:
                # All drawn values are equal, the others too rare: the greatest of them is a range.
                bounds = [counted[0]["high"]]
                counted = _counted(df, column, bounds)
            counts = [(row["part"], row["n"]) for row in counted]
            before, kept = 0, []
            for part, n in counts:
                if not kept and before + n <= offset:
                    before += n
                elif not kept or sum(m for _, m in kept) + before < offset + size:
                    kept.append((part, n))
            if len(kept) in (0, len(counts)):
                return df, offset  # behind the end, or the page reaches over all ranges
            df, offset = df.filter(within_range(column, bounds, kept[0][0], kept[-1][0])), offset - before
            if offset <= shallow:
                return df, offset
    return df, offset


def _counted(df: DataFrame, column: str, bounds: Sequence) -> list:
    """Rows and ends of the ranges that have rows, in order; as many as there are ranges."""
    ends = (F.min(column).alias("low"), F.max(column).alias("high"))
    parts = df.groupBy(range_of(column, bounds).alias("part")).agg(F.count("*").alias("n"), *ends)
    return sorted(parts.collect(), key=lambda row: row["part"])


def sample_limit(df: DataFrame, order_by: Sequence[str], limit: int) -> DataFrame:
    """The first rows in a fixed order, for tables cut to a sample."""
    return df.orderBy(*order_by).limit(limit)
