"""The incremental window over events, and what depends on the change column."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from starloom.functions.window import EFFECTIVE, EXTENDED, IncrementalWindow, apply_window, resolve_change_column
from starloom.operators.report import table_counts
from starloom.operators.sets import DATABASE, union_all
from starloom.operators.state import high_water_marks
from starloom.queries.registry import query, table
from starloom.sources.scan import changed_tables


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", F.col("ts").alias("updated_at"))


@query(
    "window_new_range",
    """
    SELECT event_id, ts AS updated_at FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-15 06:00:00'
    """,
)
def window_new_range(spark, sf):
    return apply_window(_events(spark, sf), IncrementalWindow.resolve("2024-01-10", "new", 5, 6))


@query("window_new_open", "SELECT event_id, ts AS updated_at FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:30:00'")
def window_new_open(spark, sf):
    return apply_window(_events(spark, sf), IncrementalWindow.resolve("2024-01-20 12:30:00", "new"))


@query(
    "window_old_range",
    """
    SELECT event_id, ts AS updated_at FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-17 20:00:00' AND TIMESTAMP '2024-01-20 00:00:00'
    """,
)
def window_old_range(spark, sf):
    return apply_window(_events(spark, sf), IncrementalWindow.resolve("2024-01-20", "old", "2", "4"))


@query("window_old_open", "SELECT event_id, ts AS updated_at FROM events WHERE ts <= TIMESTAMP '2024-01-08 00:00:00'")
def window_old_open(spark, sf):
    return apply_window(_events(spark, sf), IncrementalWindow.resolve("2024-01-08", "old", "", ""))


@query("window_unreadable", "SELECT event_id, ts AS updated_at FROM events")
def window_unreadable(spark, sf):
    """A window that cannot be read filters nothing."""
    return apply_window(_events(spark, sf), IncrementalWindow.resolve("10.01.2024", "new", 5))


@query(
    "window_epoch_ms",
    """
    SELECT event_id, epoch_us(ts) // 1000 AS updated_at_epoch FROM events
    WHERE epoch_us(ts) // 1000 BETWEEN epoch_us(TIMESTAMP '2024-01-10 00:00:00') // 1000
                                   AND epoch_us(TIMESTAMP '2024-01-13 00:00:00') // 1000
    """,
)
def window_epoch_ms(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("updated_at_epoch")
    )
    return apply_window(events, IncrementalWindow.resolve("2024-01-10", "new", 3))


@query(
    "window_text",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS updated_at FROM events
    WHERE strftime(ts, '%Y-%m-%d %H:%M:%S') BETWEEN '2024-01-10 00:00:00' AND '2024-01-11 00:00:00'
    """,
)
def window_text(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("updated_at")
    )
    return apply_window(events, IncrementalWindow.resolve("2024-01-10", "new", 1))


@query("relative_cutoff", "SELECT event_id, ts AS updated_at FROM events WHERE ts <= TIMESTAMP '2024-01-17 03:00:00'")
def relative_cutoff(spark, sf):
    return apply_window(_events(spark, sf), IncrementalWindow.cutoff(datetime(2024, 1, 15, 13, 45), days=2, hours=3))


@query(
    "window_end_of_day",
    """
    SELECT event_id, ts AS updated_at FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-06 23:59:59'
    """,
)
def window_end_of_day(spark, sf):
    return apply_window(_events(spark, sf), IncrementalWindow.between("2024-01-05", "2024-01-06", end_of_day=True))


def _changing(spark, sf):
    orders = table(spark, sf, "orders")
    events = table(spark, sf, "events")
    lines = table(spark, sf, "lineitem")
    return {
        "orders": orders.select(
            F.col("o_orderdate").alias("created_date"), (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("updated_date")
        ),
        "events": events.select(
            F.col("ts").alias("created_at"), F.unix_millis(F.col("ts").cast("timestamp")).alias("updated_at_epoch")
        ),
        "lineitem": lines.select(F.col("l_shipdate").alias("update_time")),
    }


@query(
    "change_column",
    """
    SELECT 'effective' AS priority, 'orders' AS "table", 'created_date' AS change_column, count(*) AS rows,
           CAST(max(o_orderdate) AS VARCHAR) AS latest FROM orders
    UNION ALL SELECT 'extended', 'orders', 'updated_date', count(*), CAST(max(o_orderdate + INTERVAL 1 DAY) AS VARCHAR) FROM orders
    UNION ALL SELECT 'effective', 'events', 'updated_at_epoch', count(*), CAST(max(epoch_us(ts) // 1000) AS VARCHAR) FROM events
    UNION ALL SELECT 'extended', 'events', 'updated_at_epoch', count(*), CAST(max(epoch_us(ts) // 1000) AS VARCHAR) FROM events
    UNION ALL SELECT 'effective', 'lineitem', 'update_time', count(*), CAST(max(l_shipdate) AS VARCHAR) FROM lineitem
    UNION ALL SELECT 'extended', 'lineitem', 'update_time', count(*), CAST(max(l_shipdate) AS VARCHAR) FROM lineitem
    """,
)
def change_column(spark, sf):
    parts = []
    for priority, order in (("effective", EFFECTIVE), ("extended", EXTENDED)):
        for name, df in _changing(spark, sf).items():
            column = resolve_change_column(df, order)
            found = df.agg(F.count(column).alias("rows"), F.max(column).cast("string").alias("latest"))
            parts.append(
                found.select(
                    F.lit(priority).alias("priority"), F.lit(name).alias("table"),
                    F.lit(column).alias("change_column"), "rows", "latest",
                )
            )
    return union_all(parts)


@query(
    "high_water_mark",
    """
    SELECT 'orders' AS "table", max(o_orderdate + INTERVAL 1 DAY) AS value FROM orders
    UNION ALL SELECT 'events', make_timestamp(max(epoch_us(ts) // 1000) * 1000) FROM events
    UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem
    """,
)
def high_water_mark(spark, sf):
    return high_water_marks(_changing(spark, sf), EXTENDED)


@query(
    "has_changes",
    """
    SELECT 'orders' AS "table", count(*) > 0 AS has_changes, count(*) AS rows_due FROM orders
    WHERE o_orderdate >= TIMESTAMP '2001-01-01'
    UNION ALL SELECT 'events', count(*) > 0, count(*) FROM events WHERE ts >= TIMESTAMP '2001-01-01'
    UNION ALL SELECT 'lineitem', count(*) > 0, count(*) FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01'
    """,
)
def has_changes_query(spark, sf):
    return changed_tables(_changing(spark, sf), IncrementalWindow.resolve("2001-01-01", "new"))


@query(
    "counts_in_window",
    """
    SELECT o_orderstatus AS _database, 'orders' AS "table", count(*) AS records FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31' GROUP BY 1
    UNION ALL
    SELECT l_returnflag, 'lineitem', count(*) FROM lineitem
    WHERE l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31' GROUP BY 1
    UNION ALL
    SELECT NULL, 'part', count(*) FROM part
    """,
)
def counts_in_window(spark, sf):
    tables = {
        "orders": table(spark, sf, "orders").withColumnsRenamed({"o_orderdate": "created_at", "o_orderstatus": DATABASE}),
        "lineitem": table(spark, sf, "lineitem").withColumnsRenamed({"l_shipdate": "created_at", "l_returnflag": DATABASE}),
        "part": table(spark, sf, "part"),
    }
    return table_counts(tables, IncrementalWindow.between("1996-01-01", "1997-12-31"))
