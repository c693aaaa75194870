"""Counts, quality checks, recovery and run outcomes."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators.quality import constraint_issues, duplicate_keys, issue_report, null_id_issues
from starloom.operators.report import (
    database_summary,
    extract_summary,
    load_totals,
    profile_targets,
    run_metrics,
    status_lists,
    table_counts,
    top_failed,
    transform_stats,
)
from starloom.operators.sets import DATABASE
from starloom.operators.state import changed_since, current_watermarks, database_marks, job_state, job_summary, remaining_tables, replay_due
from starloom.plans.spec import MappingSet, TargetMapping
from starloom.queries.registry import query, table

GIVEN = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

COUNTS_SQL = """
    SELECT o_orderstatus AS _database, 'orders' AS "table", count(*) AS records FROM orders GROUP BY 1
    UNION ALL SELECT l_linestatus, 'lineitem', count(*) FROM lineitem GROUP BY 1
"""


def _counts(spark, sf):
    return table_counts(
        {
            "orders": table(spark, sf, "orders").withColumnRenamed("o_orderstatus", DATABASE),
            "lineitem": table(spark, sf, "lineitem").withColumnRenamed("l_linestatus", DATABASE),
        }
    )


@query(
    "extract_summary",
    f"""
    SELECT count(DISTINCT _database) AS total_databases, count(*) AS total_tables,
           CAST(sum(records) AS BIGINT) AS total_records FROM ({COUNTS_SQL})
    """,
)
def extract_summary_query(spark, sf):
    return extract_summary(_counts(spark, sf))


@query(
    "db_rollup",
    f"""
    SELECT _database, count(*) AS tables, CAST(sum(records) AS BIGINT) AS records,
           CAST(grouping(_database) AS INTEGER) AS is_total
    FROM ({COUNTS_SQL}) GROUP BY ROLLUP (_database)
    """,
)
def db_rollup(spark, sf):
    return database_summary(_counts(spark, sf)).withColumn("is_total", F.col("is_total").cast("int"))


@query(
    "transform_stats",
    """
    WITH c AS (SELECT 'orders' AS "table", count(*) AS records FROM orders
               UNION ALL SELECT 'labels', count(*) FROM labels
               UNION ALL SELECT 'none', count(*) FROM orders WHERE o_totalprice < 0)
    SELECT "table", records, (SELECT count(*) FROM c WHERE records > 0) AS filled_tables,
           (SELECT CAST(sum(records) AS BIGINT) FROM c) AS total_records
    FROM c
    """,
)
def transform_stats_query(spark, sf):
    orders = table(spark, sf, "orders")
    return transform_stats({"orders": orders, "labels": table(spark, sf, "labels"), "none": orders.filter("o_totalprice < 0")})


PROFILE_SQL = " UNION ALL ".join(f"SELECT '{name}' AS \"table\", count(*) AS records FROM {name}" for name in GIVEN)
PROFILE_SQL += " UNION ALL SELECT 'refunds', count(*) FROM orders WHERE o_totalprice < 0"


def _profile(spark, sf):
    tables = {name: table(spark, sf, name) for name in GIVEN}
    return profile_targets({**tables, "refunds": tables["orders"].filter("o_totalprice < 0")})


@query(
    "profile_targets",
    f"SELECT \"table\", records, CASE WHEN records > 0 THEN 'loaded' ELSE 'empty' END AS status FROM ({PROFILE_SQL})",
)
def profile_targets_query(spark, sf):
    return _profile(spark, sf)


@query(
    "status_lists",
    f"""
    SELECT CASE WHEN records > 0 THEN 'loaded' ELSE 'empty' END AS status, count(*) AS tables,
           string_agg("table", ',' ORDER BY "table") AS names
    FROM ({PROFILE_SQL}) GROUP BY 1
    """,
)
def status_lists_query(spark, sf):
    return status_lists(_profile(spark, sf)).withColumn("names", F.array_join("names", ","))


def _report(spark, sf):
    """A load report with one row per supplier, from the lines it delivered."""
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.count("*").alias("parsed"), F.count_if(F.col("l_tax") > 0.07).alias("rejected")
    )
    failed = F.col("s_acctbal") < 500
    return (
        table(spark, sf, "supplier")
        .join(lines, "s_suppkey", "left")
        .select(
            F.col("s_name").alias("table"),
            F.when(failed, "failed").when(F.col("parsed").isNull(), "skipped").otherwise("loaded").alias("status"),
            F.coalesce("parsed", F.lit(0)).alias("parsed"),
            F.when(failed | F.col("parsed").isNull(), F.lit(0)).otherwise(F.col("parsed") - F.col("rejected")).alias("loaded"),
            F.when(failed | F.col("parsed").isNull(), F.lit(0)).otherwise(F.col("rejected")).alias("rejected"),
            F.when(failed, F.lit("no credit")).alias("error"),
        )
    )


REPORT_SQL = """
    WITH l AS (SELECT l_suppkey, count(*) AS p, count(*) FILTER (l_tax > 0.07) AS r FROM lineitem GROUP BY 1),
         rep AS (
            SELECT s_name AS "table",
                   CASE WHEN s_acctbal < 500 THEN 'failed' WHEN p IS NULL THEN 'skipped' ELSE 'loaded' END AS status,
                   coalesce(p, 0) AS parsed,
                   CASE WHEN s_acctbal < 500 OR p IS NULL THEN 0 ELSE p - r END AS loaded,
                   CASE WHEN s_acctbal < 500 OR p IS NULL THEN 0 ELSE r END AS rejected,
                   CASE WHEN s_acctbal < 500 THEN 'no credit' END AS error
            FROM supplier LEFT JOIN l ON s_suppkey = l_suppkey)
"""


@query(
    "load_report",
    REPORT_SQL
    + """
    SELECT count(*) FILTER (status = 'loaded') AS loaded_tables, count(*) FILTER (status = 'failed') AS failed_tables,
           count(*) FILTER (status = 'skipped') AS skipped_tables, CAST(sum(parsed) AS BIGINT) AS parsed_records,
           CAST(sum(loaded) AS BIGINT) AS total_records, CAST(sum(rejected) AS BIGINT) AS rejected_records
    FROM rep
    """,
)
def load_report_query(spark, sf):
    return load_totals(_report(spark, sf))


@query(
    "top_failed",
    REPORT_SQL
    + """
    SELECT "table", error, greatest((SELECT count(*) FROM rep WHERE status = 'failed') - 5, 0) AS more
    FROM rep WHERE status = 'failed' ORDER BY "table" LIMIT 5
    """,
)
def top_failed_query(spark, sf):
    return top_failed(_report(spark, sf))


@query(
    "null_id_issues",
    """
    SELECT 'fct_orders' AS "table", 'null:customer_id' AS issue, count(*) AS rows FROM orders
    WHERE o_orderstatus = 'P' HAVING count(*) > 0
    UNION ALL SELECT 'fct_orders', 'null:priority_id', count(*) FROM orders
    WHERE o_orderpriority = '5-LOW' HAVING count(*) > 0
    """,
)
def null_id_issues_query(spark, sf):
    return null_id_issues(_faulty_orders(table(spark, sf, "orders")), "fct_orders")


def _faulty_orders(orders):
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("customer_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority_id"),
    )


@query(
    "null_id_first_row",
    """
    SELECT 'fct_orders' AS "table", 'null:customer_id' AS issue, 1 AS rows
    FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 1) WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'fct_orders', 'null:priority_id', 1
    FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 1) WHERE o_orderpriority = '5-LOW'
    """,
)
def null_id_first_row(spark, sf):
    return null_id_issues(_faulty_orders(table(spark, sf, "orders")), "fct_orders", scope="first", order_by=["order_id"])


@query(
    "pk_duplicates",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
    """,
)
def pk_duplicates(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


LINE = TargetMapping(
    name="fct_line",
    sources=("lineitem",),
    key=("order_id", "line_id"),
    columns={"order_id": "lineitem.l_orderkey", "line_id": "lineitem.l_linenumber", "part_id": "lineitem.l_partkey"},
    required=("part_id",),
)


@query(
    "constraint_issues",
    """
    SELECT 'fct_line' AS "table", 'null:part_id' AS issue, count(*) AS rows FROM lineitem
    WHERE l_returnflag = 'N' HAVING count(*) > 0
    UNION ALL
    SELECT 'fct_line', 'key_repeated:order_id,line_id', CAST(sum(n) AS BIGINT) FROM (
        SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    """,
)
def constraint_issues_query(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_id"),
        F.when(F.col("l_returnflag") != "N", F.col("l_partkey")).alias("part_id"),
    )
    return constraint_issues(lines, LINE)


@query(
    "issue_report",
    """
    SELECT 'fct_orders' AS "table", 'null:customer_id' AS issue, count(*) AS rows FROM orders
    WHERE o_orderstatus = 'P' HAVING count(*) > 0
    UNION ALL SELECT 'fct_orders', 'null:priority_id', count(*) FROM orders
    WHERE o_orderpriority = '5-LOW' HAVING count(*) > 0
    UNION ALL SELECT 'dim_features', 'column_absent:feature_id', count(*) FROM part
    UNION ALL SELECT 'fct_line', 'key_repeated:order_id,line_id', CAST(sum(n) AS BIGINT) FROM (
        SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    """,
)
def issue_report_query(spark, sf):
    orders = _faulty_orders(table(spark, sf, "orders"))
    lines = table(spark, sf, "lineitem").selectExpr("l_orderkey AS order_id", "l_linenumber AS line_id", "l_partkey AS part_id")
    return issue_report(
        {
            "fct_orders": orders,
            "fct_empty": orders.filter("order_id < 0"),
            "dim_features": table(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_name"),
            "fct_line": lines,
        },
        MappingSet([LINE]),
    )


@query(
    "recover_remaining",
    """
    SELECT upper(c_name) AS "table" FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
      AND lower(c_name) NOT IN ('customer#000000001', 'customer#000000002')
    """,
)
def recover_remaining(spark, sf):
    """Names neither loaded yet nor to be skipped, whatever their letter case."""
    customers = table(spark, sf, "customer")
    urgent = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'")
    loaded = customers.join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select(F.col("c_name").alias("table"))
    names = customers.select(F.upper("c_name").alias("table"))
    return remaining_tables(names, loaded, skip=["Customer#000000001", "CUSTOMER#000000002"])


def _job_events(spark, sf):
    """Events as a job log: the user is the job, kinds and states come from the event type and value."""
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("job_id"),
        F.col("ts").cast("timestamp").alias("at"),
        F.expr("CASE event_type WHEN 'signup' THEN 'phase' WHEN 'purchase' THEN 'job' ELSE 'table' END").alias("kind"),
        F.expr(
            "CASE event_type WHEN 'signup' THEN CASE WHEN value > 50 THEN 'extraction' WHEN value > 20 THEN 'loading'"
            " ELSE 'transformation' END WHEN 'purchase' THEN 'run' ELSE event_type || '_' || props END"
        ).alias("name"),
        F.expr(
            "CASE event_type WHEN 'click' THEN 'loaded' WHEN 'view' THEN 'skipped' WHEN 'error' THEN 'failed'"
            " WHEN 'purchase' THEN CASE WHEN value > 30 THEN 'in_progress' ELSE 'completed' END"
            " ELSE CASE WHEN value > 25 THEN 'done' ELSE 'failed' END END"
        ).alias("status"),
        F.col("event_id").alias("records"),
        F.lit(None).cast("string").alias("details"),
    )


JOB_SQL = """
    WITH e AS (
        SELECT CAST(user_id AS VARCHAR) AS job_id, ts AS "at", event_id AS records,
               CASE event_type WHEN 'signup' THEN 'phase' WHEN 'purchase' THEN 'job' ELSE 'table' END AS kind,
               CASE event_type WHEN 'signup' THEN CASE WHEN value > 50 THEN 'extraction' WHEN value > 20 THEN 'loading'
                    ELSE 'transformation' END WHEN 'purchase' THEN 'run' ELSE event_type || '_' || props END AS name,
               CASE event_type WHEN 'click' THEN 'loaded' WHEN 'view' THEN 'skipped' WHEN 'error' THEN 'failed'
                    WHEN 'purchase' THEN CASE WHEN value > 30 THEN 'in_progress' ELSE 'completed' END
                    ELSE CASE WHEN value > 25 THEN 'done' ELSE 'failed' END END AS status
        FROM events),
    s AS (SELECT job_id, kind, name, status, records, CAST(NULL AS VARCHAR) AS details, "at" FROM e
          QUALIFY row_number() OVER (PARTITION BY job_id, kind, name ORDER BY "at" DESC) = 1)
"""


@query("job_state", JOB_SQL + "SELECT * FROM s")
def job_state_query(spark, sf):
    return job_state(_job_events(spark, sf))


@query(
    "job_summary",
    JOB_SQL
    + """
    , j AS (
        SELECT job_id, coalesce(max(status) FILTER (kind = 'job'), 'in_progress') AS status,
               count(*) FILTER (kind = 'table' AND status = 'loaded') AS loaded_tables,
               count(*) FILTER (kind = 'table' AND status = 'failed') AS failed_tables,
               count(*) FILTER (kind = 'table' AND status = 'skipped') AS skipped_tables,
               coalesce(max(status) FILTER (kind = 'phase' AND name = 'extraction'), 'pending') AS extraction,
               coalesce(max(status) FILTER (kind = 'phase' AND name = 'transformation'), 'pending') AS transformation,
               coalesce(max(status) FILTER (kind = 'phase' AND name = 'loading'), 'pending') AS loading
        FROM s GROUP BY job_id)
    SELECT *, status = 'in_progress' AND loaded_tables > 0 AS should_resume FROM j
    """,
)
def job_summary_query(spark, sf):
    return job_summary(_job_events(spark, sf))


@query(
    "current_watermarks",
    """
    SELECT event_type || '_' || user_id AS "table", ts - INTERVAL 1 HOUR AS value, CAST(event_id AS VARCHAR) AS run_id
    FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC) = 1
    """,
)
def current_watermarks_query(spark, sf):
    history = table(spark, sf, "events").select(
        F.concat_ws("_", "event_type", "user_id").alias("table"),
        (F.col("ts").cast("timestamp") - F.expr("INTERVAL 1 HOUR")).alias("value"),
        F.col("event_id").cast("string").alias("run_id"),
        F.col("ts").cast("timestamp").alias("committed_at"),
    )
    return current_watermarks(history)


MARKED = """
    SELECT 'tenant_' || lower(o_orderstatus) AS _database, o_orderkey, o_orderdate AS created_date FROM orders
"""


@query(
    "marks_by_database",
    f"""
    WITH o AS ({MARKED}),
    first AS (SELECT _database, max(created_date) AS mark FROM o
              WHERE _database <> 'tenant_p' AND (_database = 'tenant_o' OR created_date < DATE '1998-06-01') GROUP BY 1)
    SELECT _database, o_orderkey, created_date FROM o LEFT JOIN first USING (_database)
    WHERE mark IS NULL OR created_date >= mark
    """,
)
def marks_by_database(spark, sf):
    """What is due in a second run: one database stands behind, one joins and is read whole."""
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit("tenant_"), F.lower("o_orderstatus")).alias(DATABASE), "o_orderkey", F.col("o_orderdate").alias("created_date")
    )
    first = orders.filter("_database <> 'tenant_p' AND (_database = 'tenant_o' OR created_date < DATE '1998-06-01')")
    marks = database_marks({"orders": first}).select(
        "table", "database", "value", F.lit("first").alias("run_id"), F.current_timestamp().alias("committed_at")
    )
    return changed_since({"orders": orders}, marks)["orders"]


@query(
    "run_outcome",
    """
    WITH e AS (SELECT o_custkey AS run_id,
                      CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS p,
                      o_totalprice > 60000 AS ok, o_orderkey AS records,
                      CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 1 ELSE 0 END AS bad FROM orders),
    r AS (SELECT run_id, CAST(coalesce(sum(records) FILTER (p = 0), 0) AS BIGINT) AS extraction_records,
                 CAST(coalesce(sum(records) FILTER (p = 1), 0) AS BIGINT) AS transformation_records,
                 CAST(coalesce(sum(records) FILTER (p = 2), 0) AS BIGINT) AS loading_records,
                 CAST(sum(bad) AS BIGINT) AS failed_tables, min(p) FILTER (NOT ok) AS f
          FROM e GROUP BY 1)
    SELECT run_id, extraction_records, transformation_records, loading_records, failed_tables,
           CASE f WHEN 0 THEN 'extraction' WHEN 1 THEN 'transformation' WHEN 2 THEN 'loading' END AS failed_phase,
           CASE WHEN f IS NOT NULL THEN 'failed' WHEN failed_tables > 0 THEN 'partial' ELSE 'success' END AS outcome
    FROM r
    """,
)
def run_outcome(spark, sf):
    events = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("run_id"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'extraction' WHEN 'O' THEN 'transformation' ELSE 'loading' END").alias("phase"),
        (F.col("o_totalprice") > 60000).alias("success"),
        F.col("o_orderkey").alias("records"),
        F.expr("CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 1 ELSE 0 END").alias("failed_tables"),
    )
    return run_metrics(events)


@query(
    "replay_due",
    JOB_SQL
    + """
    , j AS (
        SELECT job_id, max(status) FILTER (kind = 'job') AS status,
               coalesce(max(status) FILTER (kind = 'phase' AND name = 'extraction'), 'pending') AS extraction,
               coalesce(max(status) FILTER (kind = 'phase' AND name = 'transformation'), 'pending') AS transformation,
               coalesce(max(status) FILTER (kind = 'phase' AND name = 'loading'), 'pending') AS loading
        FROM (SELECT job_id, kind, name, CASE status WHEN 'completed' THEN 'failed' ELSE status END AS status FROM s)
        GROUP BY job_id)
    SELECT job_id, transformation, loading FROM j WHERE extraction = 'done' AND status = 'failed'
    """,
)
def replay_due_query(spark, sf):
    events = _job_events(spark, sf)
    return replay_due(events.replace("completed", "failed", subset=["status"]))
