from datetime import datetime

import pytest

from conftest import plan_of
from starloom.functions.window import (
    EFFECTIVE,
    EXTENDED,
    IncrementalWindow,
    apply_window,
    resolve_change_column,
)

DAY = datetime(2024, 1, 10)


@pytest.mark.parametrize(
    "args, start, end",
    [
        (("2024-01-10", "old"), None, DAY),
        (("2024-01-10", "old", 2, 3), datetime(2024, 1, 7, 21), DAY),
        (("2024-01-10", "new"), DAY, None),
        (("2024-01-10", "new", "1", ""), DAY, datetime(2024, 1, 11)),
        (("2024-01-10 05:06:07", "new", "", "2"), datetime(2024, 1, 10, 5, 6, 7), datetime(2024, 1, 10, 7, 6, 7)),
        (("2024-01-10", "NEW"), None, None),
        (("2024-01-10", ""), None, None),
        (("2024-01-10", "sideways", 1), None, None),
        (("10/01/2024", "new"), None, None),
        (("2024-01-10", "new", "two"), None, None),
        (("", "new", 2), None, None),
        ((None, None), None, None),
    ],
)
def test_resolve(args, start, end):
    window = IncrementalWindow.resolve(*args)
    assert (window.start, window.end) == (start, end)
    assert window.active == bool(start or end)


def test_lenient_direction_and_remarks():
    window = IncrementalWindow.resolve("2024-01-10 # base", " NEW ", "1 # day", lenient=True)
    assert (window.start, window.end) == (DAY, datetime(2024, 1, 11))


def test_cutoff_adds_counts_to_midnight():
    assert IncrementalWindow.cutoff(datetime(2024, 1, 10, 15), 1, 2) == IncrementalWindow(None, datetime(2024, 1, 11, 2))


def test_between_end_of_day():
    assert IncrementalWindow.between(end="2024-01-10", end_of_day=True).end == datetime(2024, 1, 10, 23, 59, 59)
    assert IncrementalWindow.between(end="2024-01-10 01:00:00", end_of_day=True).end == datetime(2024, 1, 10, 1)
    assert IncrementalWindow.between(end="2024-01-10").end == DAY


def test_change_column_priority():
    names = ["created_date", "updated_date", "created_at", "last_updated_epoch"]
    assert resolve_change_column(names) == "created_at"
    assert resolve_change_column(names, EXTENDED) == "last_updated_epoch"
    assert resolve_change_column(["created_date", "updated_date"], EFFECTIVE) == "created_date"
    assert resolve_change_column(["created_date", "updated_date"], EXTENDED) == "updated_date"
    assert resolve_change_column(["id"]) is None


def test_bounds_are_inclusive_and_null_never_matches(spark):
    low, high = 1704844800000, 1704931200000
    df = spark.createDataFrame([(low - 1,), (low,), (high,), (high + 1,), (None,)], "updated_at_epoch bigint")
    window = IncrementalWindow.resolve("2024-01-10", "new", 1)
    assert sorted(r[0] for r in apply_window(df, window).collect()) == [low, high]


def test_table_without_change_column_stays_whole(spark):
    df = spark.range(3)
    assert apply_window(df, IncrementalWindow.resolve("2024-01-10", "new")).count() == 3


@pytest.mark.parametrize("name, column", [("events", "ts"), ("orders", "o_orderdate")])
def test_window_reaches_the_scan(spark, name, column):
    df = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").withColumnRenamed(column, "updated_at")
    plan = plan_of(apply_window(df, IncrementalWindow.resolve("1999-01-10", "new", 5)))
    assert f"GreaterThanOrEqual({column}" in plan and f"LessThanOrEqual({column}" in plan
