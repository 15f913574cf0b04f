"""Named schemas and key columns (one registry instead of repeated literals)."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- wire formats (JSON events; timestamp is epoch seconds as a double) ----
ORDER_EVENT = T.StructType([
    T.StructField("eventType", T.StringType()),
    T.StructField("orderId", T.StringType()),
    T.StructField("userId", T.StringType()),
    T.StructField("productId", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
])

VIEW_EVENT = T.StructType([
    T.StructField("eventType", T.StringType()),
    T.StructField("userId", T.StringType()),
    T.StructField("productId", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
])

USER_EVENT = T.StructType([
    T.StructField("eventType", T.StringType()),
    T.StructField("userId", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("device", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
])

# ---- tables ----------------------------------------------------------------
ORDERS_RAW = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])

REVENUE_BY_CURRENCY = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("currency", T.StringType()),
    T.StructField("total_revenue", T.DoubleType()),
    T.StructField("order_count", T.LongType()),
    T.StructField("avg_order_value", T.DoubleType()),
])

CONVERSION_FUNNEL = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("view_count", T.LongType()),
    T.StructField("order_count", T.LongType()),
    T.StructField("conversion_rate", T.DoubleType()),
])

PRODUCT_RECOMMENDATIONS = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("recommended_product_id", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("co_purchase_count", T.LongType()),
    T.StructField("last_updated", T.TimestampType()),
])

USER_SESSIONS = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_duration_seconds", T.LongType()),
    T.StructField("events_count", T.LongType()),
    T.StructField("views_count", T.LongType()),
    T.StructField("orders_count", T.LongType()),
    T.StructField("has_conversion", T.BooleanType()),
])

METRIC_SAMPLES = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("name", T.StringType()),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("value", T.DoubleType()),
])

# table name -> (schema, key columns); keys drive dedupe and upsert sinks
TABLES = {
    "orders_raw": (ORDERS_RAW, ["order_id"]),
    "revenue_by_currency_5min": (REVENUE_BY_CURRENCY, ["window_start", "currency"]),
    "conversion_funnel_5min": (CONVERSION_FUNNEL, ["window_start", "user_id"]),
    "product_recommendations": (PRODUCT_RECOMMENDATIONS, ["product_id", "recommended_product_id"]),
    "user_sessions_5min": (USER_SESSIONS, ["window_start", "user_id"]),
    "metric_samples": (METRIC_SAMPLES, ["ts", "name", "labels"]),
}


def ddl(schema: T.StructType) -> str:
    """Column list in Spark DDL form, for CREATE TABLE statements."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)

#: Output tables whose rows are written once (append mode).
APPENDED = {"user_sessions_5min", "metric_samples"}
