"""Ranges of a column's values of about equal numbers of rows, from a sample of bounded size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Values that are drawn to find bounds.
DRAWN = 4_096


def bounds_of(df: DataFrame, column: str, ranges: int) -> list:
    """At most ``ranges - 1`` ascending values that part a column's rows into about equal numbers; NULLs aside.

    One scan, of which ``DRAWN`` values come to the driver. Bounds decide how rows are dealt, never which.
    """
    drawn = df.select(column).dropna().orderBy(F.rand(7)).limit(DRAWN).sort(column).collect()
    values = [row[0] for row in drawn]
    picked = [values[len(values) * k // ranges] for k in range(1, ranges)] if values else []
    # The least value, which may hold almost all rows, is a range of its own.
    above = next((x for x in values if x != values[0]), None)
    return sorted({x for x in picked if x != values[0]} | ({above} if above is not None else set()))


def range_of(column: str, bounds: Sequence) -> Column:
    """The number of the range that a value is in, from 1 on; 0 is NULL, which sorts first."""
    passed = [F.when(F.col(column) >= F.lit(x), 1).otherwise(0) for x in bounds]
    return F.when(F.col(column).isNull(), 0).otherwise(reduce(Column.__add__, passed, F.lit(1)))


def within_range(column: str, bounds: Sequence, first: int, last: int) -> Column:
    """The rows of ranges ``first`` to ``last``, as a condition on the values that a scan can use."""
    if last == 0:
        return F.col(column).isNull()
    condition = F.lit(True)
    if first > 1:
        condition = condition & (F.col(column) >= F.lit(bounds[first - 2]))
    if last <= len(bounds):
        condition = condition & (F.col(column) < F.lit(bounds[last - 1]))
    return condition & F.col(column).isNotNull() if first else condition | F.col(column).isNull()


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """A number whose order keeps rows near each other that are near in all columns: the ranges' numbers, bit by bit."""
    out = F.lit(0).cast(T.LongType())
    for place, column in enumerate(columns):
        number = range_of(column, bounds_of(df, column, 1 << bits)).cast(T.LongType())
        for bit in range(bits):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1))
            out = out + F.shiftleft(one, bit * len(columns) + len(columns) - 1 - place)
    return out
