"""Discovery, selection, unions and interchange documents."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from starloom.operators.sets import page, sample_limit, union_databases, within
from starloom.queries.registry import query, table
from starloom.sources.catalog import classify_tables, discover_databases, filter_by_keywords, select_tables, table_catalog
from starloom.sources.envelope import explode_extract, explode_single, explode_transformed, table_rows
from starloom.sources.splits import plan_frame

DATABASES = """
    CASE c_mktsegment WHEN 'BUILDING' THEN 'Identity' WHEN 'MACHINERY' THEN 'MASTER'
         WHEN 'FURNITURE' THEN 'Tenant_' || c_nationkey WHEN 'HOUSEHOLD' THEN 'tenant-' || c_custkey
         ELSE 'old_tenant_' || c_nationkey END
"""


@query(
    "catalog_roles",
    f"""
    WITH c AS (SELECT DISTINCT {DATABASES} AS database FROM customer)
    SELECT database,
           CASE WHEN lower(database) IN ('identity', 'master') THEN lower(database) ELSE 'tenant' END AS role
    FROM c WHERE lower(database) IN ('identity', 'master') OR lower(database) LIKE 'tenant%'
    """,
)
def catalog_roles(spark, sf):
    return discover_databases(table(spark, sf, "customer").select(F.expr(DATABASES).alias("database")))


SERVER_DATABASES = """
    CASE c_mktsegment WHEN 'BUILDING' THEN 'mysql' WHEN 'MACHINERY' THEN 'information_schema'
         WHEN 'FURNITURE' THEN 'sys' ELSE 'db_' || c_nationkey END
"""


@query(
    "catalog_without_roles",
    f"""
    SELECT DISTINCT {SERVER_DATABASES} AS database FROM customer
    WHERE {SERVER_DATABASES} NOT IN ('information_schema', 'mysql', 'performance_schema', 'sys')
    """,
)
def catalog_without_roles(spark, sf):
    catalog = table(spark, sf, "customer").select(F.expr(SERVER_DATABASES).alias("database"))
    return discover_databases(catalog, roles=False)


@query(
    "keyword_filter",
    """
    SELECT c_custkey, c_mktsegment FROM customer
    WHERE (lower(c_mktsegment) LIKE '%ure%' OR lower(c_mktsegment) LIKE '%build%')
      AND NOT lower(c_mktsegment) LIKE '%furn%'
    """,
)
def keyword_filter(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return filter_by_keywords(customers, "c_mktsegment", " URE, build,", "furn")


@query(
    "catalog_listing",
    """
    WITH c AS (SELECT DISTINCT p_brand, p_type, p_size, p_name FROM part)
    SELECT p_brand AS database, p_type AS "table", string_agg(p_name, ',' ORDER BY p_size, p_name) AS columns
    FROM c GROUP BY 1, 2 ORDER BY 1, 2
    """,
)
def catalog_listing(spark, sf):
    columns = table(spark, sf, "part").select(
        F.col("p_brand").alias("database"),
        F.col("p_type").alias("table"),
        F.col("p_name").alias("column"),
        F.col("p_size").alias("ordinal"),
    )
    return table_catalog(columns).withColumn("columns", F.array_join("columns", ","))


@query(
    "table_selection",
    """
    SELECT DISTINCT user_id AS database, event_type AS "table" FROM events
    WHERE event_type NOT IN ('error', 'signup') AND event_type IN ('click', 'purchase', 'error')
    """,
)
def table_selection(spark, sf):
    catalog = table(spark, sf, "events").select(F.col("user_id").alias("database"), F.col("event_type").alias("table"))
    return select_tables(catalog, skip=("error", "signup"), only=("click", "purchase", "error")).distinct()


@query(
    "table_classes",
    """
    SELECT user_id AS database, event_type AS "table", count(*) AS rows,
           CASE event_type WHEN 'error' THEN 'skip' WHEN 'click' THEN 'dynamic' WHEN 'purchase' THEN 'dynamic'
                WHEN 'view' THEN 'semi_static' ELSE 'unknown' END AS category,
           CASE event_type WHEN 'error' THEN false WHEN 'click' THEN true WHEN 'purchase' THEN true
                WHEN 'view' THEN true END AS required
    FROM events GROUP BY 1, 2
    """,
)
def table_classes(spark, sf):
    events = table(spark, sf, "events")
    catalog = events.groupBy(F.col("user_id").alias("database"), F.col("event_type").alias("table")).agg(
        F.count("*").alias("rows")
    )
    classes = classify_tables(catalog, skip=("error",), required=("click", "purchase"), semi_static=("view",))
    return classes.drop("reason")


@query(
    "required_semi",
    """
    SELECT l_returnflag, count(*) AS rows, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem
    WHERE EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 25) GROUP BY 1
    """,
)
def required_semi(spark, sf):
    parts = table(spark, sf, "part").filter("p_size > 25")
    kept = within(table(spark, sf, "lineitem"), parts, "l_partkey", "p_partkey")
    return kept.groupBy("l_returnflag").agg(F.count("*").alias("rows"), F.sum("l_linenumber").alias("lines"))


@query(
    "multi_db_union",
    """
    SELECT 'tenant_f' AS _database, o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS o_orderpriority
    FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'tenant_o', o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'tenant_p', o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P'
    """,
)
def multi_db_union(spark, sf):
    orders = table(spark, sf, "orders")
    wide = ["o_orderkey", "o_custkey", "o_orderpriority"]
    return union_databases(
        {
            "tenant_f": orders.filter("o_orderstatus = 'F'").select(*wide[:2]),
            "tenant_o": orders.filter("o_orderstatus = 'O'").select(*wide),
            "tenant_p": orders.filter("o_orderstatus = 'P'").select(*wide),
        }
    )


@query("sample_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def sample_limit_query(spark, sf):
    return sample_limit(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 100)


@query("page", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 1000")
def page_query(spark, sf):
    return page(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 500, 2)


@query(
    "page_deep",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 200 OFFSET 50000
    """,
)
def page_deep(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return page(lines, lines.columns, 200, 250, shallow=1_000)


@query(
    "range_splits",
    """
    WITH s AS (SELECT min(l_partkey) AS low, max(l_partkey) + 1 AS high, count(*) AS total FROM lineitem),
    w AS (SELECT low, high, total, greatest(1, CAST(ceil((high - low) / 200.0) AS BIGINT)) AS width FROM s),
    b AS (SELECT (l_partkey - low) // width AS part, count(*) AS n FROM lineitem, w GROUP BY 1),
    c AS (SELECT part, n, sum(n) OVER (ORDER BY part) - n AS before FROM b)
    SELECT CAST(min(low + part * width) AS BIGINT) AS low, CAST(max(least(high, low + (part + 1) * width)) AS BIGINT) AS high,
           CAST(sum(n) AS BIGINT) AS rows
    FROM c, w GROUP BY before * 8 // total
    """,
)
def range_splits(spark, sf):
    """The ranges by which eight connections would read the lines: about equal numbers of rows."""
    found = plan_frame(table(spark, sf, "lineitem"), "l_partkey", 8, ranges=200)
    return spark.createDataFrame([(x.low, x.high, x.rows) for x in found], "low bigint, high bigint, rows bigint")


ORDER_ROW = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderpriority", T.StringType()),
        T.StructField("absent", T.BooleanType()),
    ]
)


def _row(shift: int = 0):
    return F.struct((F.col("o_orderkey") + shift).alias("o_orderkey"), "o_totalprice", "o_orderpriority")


@query(
    "read_extract_multi",
    """
    SELECT 'tenant_' || lower(o_orderstatus) AS _database, p AS _pos, o_orderkey + 1000000000 * p AS o_orderkey,
           o_totalprice, o_orderpriority, CAST(NULL AS BOOLEAN) AS absent
    FROM orders, (VALUES (0), (1)) AS v(p)
    """,
)
def read_extract_multi(spark, sf):
    database = F.concat(F.lit("tenant_"), F.lower("o_orderstatus"))
    sample = F.array(_row(), _row(1_000_000_000))
    tables = F.create_map(F.lit("orders"), F.struct(F.size(sample).alias("records"), sample.alias("sample")))
    text = F.concat(
        F.lit('{"'), database, F.lit('":'), F.to_json(tables), F.lit(',"extraction_metadata":{"total_tables":1}}')
    )
    documents = table(spark, sf, "orders").select(text.alias("value"))
    return table_rows(explode_extract(documents), "orders", ORDER_ROW)


@query(
    "read_extract_single",
    """
    SELECT 'shop' AS _database, 0 AS _pos, o_orderkey, o_totalprice, o_orderpriority, CAST(NULL AS BOOLEAN) AS absent
    FROM orders
    """,
)
def read_extract_single(spark, sf):
    document = F.struct(
        F.lit("shop").alias("database"), F.lit("orders").alias("table"), F.lit(1).alias("row_count"),
        F.array(_row()).alias("data"),
    )
    documents = table(spark, sf, "orders").select(F.to_json(document).alias("value"))
    return table_rows(explode_single(documents), "orders", ORDER_ROW)


@query(
    "read_transformed",
    """
    SELECT 0 AS _pos, doc_id, text FROM documents
    """,
)
def read_transformed_query(spark, sf):
    tables = F.struct(
        F.array(F.struct("doc_id", "text")).alias("dim_documents"), F.array().cast("array<string>").alias("dim_none")
    )
    document = F.struct(F.lit("2024-01-01T00:00:00").alias("etl_timestamp"), tables.alias("tables"))
    documents = table(spark, sf, "documents").select(F.to_json(document).alias("value"))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    return table_rows(explode_transformed(documents), "dim_documents", schema)
