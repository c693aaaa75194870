"""Declarative projection, fan-out, the choice of the main table and mapping checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators.project import drop_empty_rows, fan_out, project
from starloom.operators.quality import undeclared_columns, validate_mappings
from starloom.operators.sets import DATABASE, union_all
from starloom.plans.build import build_target
from starloom.plans.spec import MappingSet, TargetMapping
from starloom.queries.registry import query, table

CUSTOMER = TargetMapping(
    name="dim_customer",
    sources=("customer", "nation"),
    key=("customer_id",),
    columns={
        "customer_id": "customer.c_custkey",
        "name": "customer.c_name",
        "label": "customer.c_name",
        "segment": "c_mktsegment",
        "phone": "customer.c_phone",
        "nation": "nation.n_name",
        "balance_cents": lambda: F.round(F.col("c_acctbal") * 100).cast("bigint"),
    },
)


@query(
    "project_mapping",
    """
    SELECT c_custkey AS customer_id, c_name AS name, c_name AS label, c_mktsegment AS segment,
           CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS nation,
           CAST(round(c_acctbal * 100) AS BIGINT) AS balance_cents
    FROM customer
    """,
)
def project_mapping(spark, sf):
    return project(table(spark, sf, "customer"), CUSTOMER, "customer")


CONTACT = TargetMapping(
    name="brg_contact",
    sources=("customer",),
    key=("contact_id",),
    columns={"contact_id": "customer.c_custkey", "nation_id": "customer.c_nationkey", "name": "customer.c_name"},
)


@query(
    "fan_out_two_targets",
    """
    SELECT 'dim_customer' AS target, c_custkey AS id, c_name AS name FROM customer
    UNION ALL SELECT 'brg_contact', c_custkey, c_name FROM customer
    """,
)
def fan_out_two_targets(spark, sf):
    fanned = fan_out("customer", table(spark, sf, "customer"), MappingSet([CUSTOMER, CONTACT]))
    ids = {"dim_customer": "customer_id", "brg_contact": "contact_id"}
    return union_all(df.select(F.lit(name).alias("target"), F.col(ids[name]).alias("id"), "name") for name, df in fanned.items())


SUPPLIER = TargetMapping(
    name="dim_supplier",
    sources=("supplier", "ratings"),
    key=("supplier_id",),
    columns={
        "supplier_id": "supplier.s_suppkey",
        "name": "supplier.s_name",
        "fax": "supplier.s_fax",
        "rating": "ratings.value",
    },
)


@query(
    "missing_column_null",
    """
    SELECT s_suppkey AS supplier_id, s_name AS name, CAST(NULL AS VARCHAR) AS fax, CAST(NULL AS VARCHAR) AS rating
    FROM supplier
    """,
)
def missing_column_null(spark, sf):
    return build_target(SUPPLIER, {"supplier": table(spark, sf, "supplier")}, stamped=False)


SALE = TargetMapping(
    name="fct_sale",
    sources=("refunds", "orders"),
    key=("sale_id",),
    columns={
        "sale_id": "refunds.o_orderkey",
        "order_id": "orders.o_orderkey",
        "status": "o_orderstatus",
        "amount": "orders.o_totalprice",
    },
)


@query(
    "main_table_fallback",
    """
    SELECT CAST(NULL AS BIGINT) AS sale_id, o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS amount
    FROM orders
    """,
)
def main_table_fallback(spark, sf):
    """The table that owns the key has no rows, so the next one is the main table."""
    orders = table(spark, sf, "orders")
    refunds = orders.filter("o_totalprice < 0")
    return build_target(SALE, {"refunds": refunds, "orders": orders}, position=("o_orderkey",), stamped=False)


@query(
    "main_table_per_database",
    """
    SELECT 'tenant_' || lower(o_orderstatus) AS _database, o_orderkey AS sale_id, f.first_key AS order_id,
           o_orderstatus AS status, f.first_price AS amount
    FROM orders JOIN (
        SELECT o_orderstatus AS st, min(o_orderkey) AS first_key, min_by(o_totalprice, o_orderkey) AS first_price
        FROM orders GROUP BY 1) f ON o_orderstatus = f.st
    WHERE o_orderstatus IN ('F', 'O')
    UNION ALL
    SELECT 'tenant_p', CAST(NULL AS BIGINT), o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE o_orderstatus = 'P'
    """,
)
def main_table_per_database(spark, sf):
    """One database lacks the table that owns the key; the others keep it as main table."""
    orders = table(spark, sf, "orders").withColumn(DATABASE, F.concat(F.lit("tenant_"), F.lower("o_orderstatus")))
    refunds = orders.filter("o_orderstatus <> 'P'")
    return build_target(SALE, {"refunds": refunds, "orders": orders}, position=("o_orderkey",), stamped=False)


@query(
    "mapping_validation",
    """
    WITH s AS (
        SELECT p_name || '#' || p_partkey AS t, p_type, p_size FROM part)
    SELECT t AS "table", 'no_sources:' || t AS error FROM s WHERE p_type = 'ECONOMY'
    UNION ALL SELECT t, 'no_key:' || t FROM s WHERE p_size > 40
    UNION ALL SELECT t, 'no_columns:' || t FROM s WHERE p_type = 'PROMO'
    UNION ALL SELECT t, 'columns_empty:' || t FROM s WHERE p_type = 'SMALL'
    """,
)
def mapping_validation(spark, sf):
    spec = table(spark, sf, "part").select(
        F.concat("p_name", F.lit("#"), "p_partkey").alias("table"),
        F.when(F.col("p_type") != "ECONOMY", F.array("p_brand")).alias("source_tables"),
        F.when(F.col("p_size") <= 40, F.array(F.lit("id"))).alias("primary_key"),
        F.when(F.col("p_type") == "SMALL", F.create_map().cast("map<string,string>"))
        .when(F.col("p_type") != "PROMO", F.create_map(F.col("p_name"), F.col("p_brand")))
        .alias("column_mappings"),
    )
    return validate_mappings(spec)


@query(
    "undeclared_columns",
    """
    SELECT DISTINCT p_brand AS "table", p_name AS "column" FROM part p
    WHERE NOT EXISTS (SELECT 1 FROM part d WHERE d.p_brand = p.p_brand AND d.p_name = p.p_name AND d.p_size > 25)
    """,
)
def undeclared_columns_query(spark, sf):
    parts = table(spark, sf, "part")
    declared = parts.filter("p_size > 25").select(F.col("p_brand").alias("table"), F.col("p_name").alias("column"))
    spec = parts.select(
        F.col("p_brand").alias("table"), F.create_map(F.col("p_name"), F.col("p_type")).alias("column_mappings")
    )
    return undeclared_columns(spec, declared.distinct()).distinct()


@query(
    "drop_empty_rows",
    """
    WITH c AS (
        SELECT nullif(c_mktsegment, 'BUILDING') AS a,
               CASE WHEN c_nationkey > 5 THEN '' ELSE c_name END AS b,
               CASE WHEN c_acctbal > 0 THEN NULL ELSE c_nationkey - c_nationkey END AS n,
               CASE WHEN c_acctbal > 500 THEN NULL ELSE false END AS f
        FROM customer)
    SELECT * FROM c WHERE (a IS NOT NULL AND a <> '') OR (b IS NOT NULL AND b <> '') OR n IS NOT NULL OR f IS NOT NULL
    """,
)
def drop_empty_rows_query(spark, sf):
    """Zero and false are values, NULL and the empty text are not."""
    customers = table(spark, sf, "customer").selectExpr(
        "nullif(c_mktsegment, 'BUILDING') AS a",
        "CASE WHEN c_nationkey > 5 THEN '' ELSE c_name END AS b",
        "CASE WHEN c_acctbal > 0 THEN NULL ELSE c_nationkey - c_nationkey END AS n",
        "CASE WHEN c_acctbal > 500 THEN NULL ELSE false END AS f",
    )
    return drop_empty_rows(customers)
