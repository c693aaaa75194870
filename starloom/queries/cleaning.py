"""Value cleaning: binary, booleans, epoch times, NaN, JSON."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F, types as T

from starloom.functions.clean import (
    boolean_value,
    bytes_to_text,
    complex_to_json,
    fill_null_defaults,
    json_to_variant,
    normalize_booleans,
    normalize_timestamps,
    sanitize,
    stamp,
    to_bool,
)
from starloom.queries.registry import query, table


@query(
    "bit_to_bool",
    """
    SELECT o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN false WHEN 'O' THEN true END AS from_bytes,
           o_orderpriority <> '5-LOW' AND o_custkey <> 0 AS from_number,
           CASE o_orderpriority WHEN '1-URGENT' THEN false WHEN '2-HIGH' THEN true WHEN '3-MEDIUM' THEN false
                WHEN '5-LOW' THEN true END AS from_text
    FROM orders
    """,
)
def bit_to_bool(spark, sf):
    rows = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "CASE o_orderstatus WHEN 'F' THEN x'0000' WHEN 'O' THEN x'0100' END AS bits",
        "CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE o_custkey END AS number",
        "CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '2-HIGH' THEN '0' WHEN '5-LOW' THEN 'no' END AS text",
        "o_orderpriority",
    )
    # Bytes that went through JSON as text.
    rows = rows.withColumn("text", F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("b'\\x00'")).otherwise(F.col("text")))
    types = {f.name: f.dataType for f in rows.schema}
    return rows.select(
        "o_orderkey",
        to_bool(F.col("bits"), types["bits"]).alias("from_bytes"),
        to_bool(F.col("number"), types["number"]).alias("from_number"),
        to_bool(F.col("text"), types["text"]).alias("from_text"),
    )


@query("null_default", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_custkey END AS tenant_id FROM orders")
def null_default_query(spark, sf):
    orders = table(spark, sf, "orders").selectExpr("o_orderkey", "nullif(o_orderstatus, 'P') IS NOT NULL AS known", "o_custkey")
    orders = orders.select("o_orderkey", F.when(F.col("known"), F.col("o_custkey")).alias("tenant_id"))
    return fill_null_defaults(orders, {"tenant_id": 0})


@query("bytes_to_text", "SELECT doc_id, text FROM documents")
def bytes_to_text_query(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", F.encode("text", "UTF-8").alias("raw"))
    return documents.select("doc_id", bytes_to_text(F.col("raw")).alias("text"))


@query(
    "bytes_printable",
    r"""
    SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'b''\xff' || c_name || '\n'''
           WHEN 'MACHINERY' THEN 'b"\xfe''' || c_name || '"' WHEN 'FURNITURE' THEN 'b''\x80\'' "\\' || c_name || ''''
           WHEN 'HOUSEHOLD' THEN c_name END AS text
    FROM customer
    """,
)
def bytes_printable(spark, sf):
    """Bytes that are no UTF-8, with line feed, both quotes and backslash, in printable form."""
    name = F.encode("c_name", "UTF-8")
    raw = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.unhex(F.lit("FF")), name, F.unhex(F.lit("0A"))))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.unhex(F.lit("FE27")), name))
        .when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.unhex(F.lit("802720225C")), name))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", name)
    )
    return table(spark, sf, "customer").select("c_custkey", bytes_to_text(raw).alias("text"))


@query(
    "sanitize_nan",
    """
    SELECT l_orderkey, l_partkey, l_suppkey,
           CASE WHEN l_returnflag = 'N' THEN l_extendedprice END AS price,
           CASE WHEN l_linestatus = 'F' THEN l_discount END AS discount
    FROM lineitem
    """,
)
def sanitize_nan(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey",
        "CASE l_returnflag WHEN 'A' THEN double('NaN') WHEN 'R' THEN double('-Infinity') ELSE l_extendedprice END AS price",
        "CASE WHEN l_linestatus = 'O' THEN double('Infinity') ELSE l_discount END AS discount",
    )
    return sanitize(lines)


@query(
    "sanitize_nested",
    """
    SELECT vec_id, i - 1 AS pos,
           CASE WHEN embedding[i] > 0.1 OR embedding[i] < -0.1 THEN NULL ELSE embedding[i] END AS value,
           CASE WHEN embedding[1] > 0 THEN NULL ELSE embedding[1] END AS head
    FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
    """,
)
def sanitize_nested(spark, sf):
    """NaN and infinities inside arrays and structs."""
    vectors = table(spark, sf, "embeddings").selectExpr(
        "vec_id",
        "transform(embedding, x -> CASE WHEN x > 0.1D THEN float('NaN') WHEN x < -0.1D THEN float('-Infinity') ELSE x END) AS v",
        "named_struct('head', CASE WHEN embedding[0] > 0 THEN float('Infinity') ELSE embedding[0] END) AS s",
    )
    return sanitize(vectors).select("vec_id", F.posexplode("v").alias("pos", "value"), "s.head")


@query(
    "epoch_to_ts",
    """
    SELECT event_id,
           CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN NULL
                ELSE make_timestamp(epoch_us(ts) // 1000 * 1000) END AS created_at,
           CASE WHEN event_type = 'view' THEN NULL ELSE date_trunc('second', ts) END AS end_time
    FROM events
    """,
)
def epoch_to_ts(spark, sf):
    """Seconds and values past the year 9999 are no epoch milliseconds; text that is no time reads NULL."""
    events = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.unix_seconds(F.col("ts").cast("timestamp")))
        .when(F.col("event_type") == "signup", F.lit(253402300799001))
        .otherwise(F.unix_millis(F.col("ts").cast("timestamp")))
        .alias("created_at"),
        F.when(F.col("event_type") == "view", F.lit("soon"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("end_time"),
    )
    return normalize_timestamps(events)


@query(
    "bool_normalize",
    """
    SELECT event_id, CASE event_type WHEN 'click' THEN true WHEN 'view' THEN true WHEN 'signup' THEN false
                          WHEN 'error' THEN false END AS is_active,
           CASE WHEN event_type = 'click' THEN true WHEN event_type = 'view' THEN false END AS api_supported
    FROM events
    """,
)
def bool_normalize(spark, sf):
    events = table(spark, sf, "events").selectExpr(
        "event_id",
        "CASE event_type WHEN 'click' THEN '1' WHEN 'view' THEN 'True' WHEN 'signup' THEN 'false'"
        " WHEN 'error' THEN '0' ELSE 'yes' END AS is_active",
        "CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 0 ELSE event_id + 2 END AS api_supported",
    )
    return normalize_booleans(events)


@query(
    "json_text",
    """
    SELECT event_id, '{"user_id":' || user_id || ',"kind":"' || event_type || '"}' AS item,
           '["' || event_type || '","' || event_type || '"]' AS list
    FROM events
    """,
)
def json_text(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id",
        F.struct("user_id", F.col("event_type").alias("kind")).alias("item"),
        F.array("event_type", "event_type").alias("list"),
    )
    return complex_to_json(events)


@query(
    "json_variant",
    """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
    FROM events
    """,
)
def json_variant(spark, sf):
    """JSON text as VARIANT; text that is no JSON reads NULL."""
    events = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.concat(F.lit("{"), "props")).otherwise(F.col("props")).alias("data_json"),
    )
    return json_to_variant(events).select("event_id", F.try_variant_get("data_json", "$.k", "bigint").alias("k"))


@query(
    "load_time",
    "SELECT o_orderkey, TIMESTAMP '2024-06-01 12:00:00' AS etl_timestamp FROM orders",
)
def load_time(spark, sf):
    return stamp(table(spark, sf, "orders").select("o_orderkey"), datetime(2024, 6, 1, 12))


@query(
    "boolean_values",
    "SELECT doc_id, quality = 1 AS quality, toxic = 1 AS toxic FROM labels",
)
def boolean_values(spark, sf):
    labels = table(spark, sf, "labels")
    return labels.select(
        "doc_id",
        boolean_value(F.col("quality"), T.IntegerType()).alias("quality"),
        boolean_value(F.col("toxic").cast("string"), T.StringType()).alias("toxic"),
    )
