"""Explicit schemas, so that no read has to infer one."""

from __future__ import annotations

from pyspark.sql import types as T

# The star-schema files the retail tables are derived from.
STAR = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

# JSON event as produced on the topic; `timestamp` is ISO text there and becomes a timestamp on decoding.
EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("device", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("search_query", T.StringType()),
    T.StructField("search_results_count", T.IntegerType()),
    T.StructField("view_duration", T.IntegerType()),
])

# One line of the SQL log with the fields that may come along with it.
LOG_LINE = T.StructType([
    T.StructField("message", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("service", T.StringType()),
    T.StructField("sql_query", T.StringType()),
    T.StructField("sql_params", T.StringType()),
    T.StructField("execution_time_ms", T.DoubleType()),
    T.StructField("error_message", T.StringType()),
])
