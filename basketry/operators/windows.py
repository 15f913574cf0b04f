"""Windowed aggregate tables (Q02, Q03, Q05; ST3; J1; U1).

Each function is a pure transform: given batch DataFrames it is a batch
query, given streaming DataFrames (with a watermark already applied) it is
the stateful streaming query.  Grouping is on ``(window, key)`` so the
partial aggregate runs before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry import config


def _unnest(agg: DataFrame, *cols) -> DataFrame:
    # Flatten the window struct
    return agg.select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), *cols)


def revenue_by_currency(orders: DataFrame, window: str = config.REVENUE_WINDOW,
                        ts: str = "timestamp") -> DataFrame:
    """Tumbling-window revenue per currency (Q02)."""
    agg = (orders.groupBy(F.window(ts, window).alias("window"), "currency")
                 .agg(F.sum("price").alias("total_revenue"),
                      F.count(F.lit(1)).alias("order_count"),
                      F.avg("price").alias("avg_order_value")))
    return _unnest(agg, "currency", "total_revenue", "order_count", "avg_order_value")


def funnel_events(views: DataFrame, orders: DataFrame) -> DataFrame:
    """One stream of (user_id, timestamp, event_type) from views and orders."""
    v = views.select("user_id", "timestamp", F.lit("view").alias("event_type"))
    o = orders.select("user_id", "timestamp", F.lit("order").alias("event_type"))
    return v.unionByName(o)


def _is(kind: str):
    return F.when(F.col("event_type") == kind, 1).otherwise(0)


def conversion_funnel_from_events(events: DataFrame,
                                  window: str = config.FUNNEL_WINDOW) -> DataFrame:
    """Per (window, user): views, orders and orders/views (0.0 without views)."""
    agg = (events.groupBy(F.window("timestamp", window).alias("window"), "user_id")
                 .agg(F.sum(_is("view")).alias("view_count"),
                      F.sum(_is("order")).alias("order_count")))
    rate = F.when(F.col("view_count") > 0,
                  F.col("order_count").cast("double") / F.col("view_count")).otherwise(F.lit(0.0))
    return _unnest(agg, "user_id", "view_count", "order_count", rate.alias("conversion_rate"))


def conversion_funnel(views: DataFrame, orders: DataFrame,
                      window: str = config.FUNNEL_WINDOW) -> DataFrame:
    """Q03 in the union form the reference runs."""
    return conversion_funnel_from_events(funnel_events(views, orders), window)


def conversion_funnel_join(views: DataFrame, orders: DataFrame,
                           window: str = config.FUNNEL_WINDOW) -> DataFrame:
    """The documented full-outer-join form (batch cross-check of Q03).

    Both sides aggregate on (window struct, user) and join on the same
    columns, so the join reuses the aggregation's hash partitioning.
    """
    v = (views.groupBy(F.window("timestamp", window).alias("window"), "user_id")
              .agg(F.count(F.lit(1)).alias("v")))
    o = (orders.groupBy(F.window("timestamp", window).alias("window"), "user_id")
               .agg(F.count(F.lit(1)).alias("o")))
    j = v.join(o, on=["window", "user_id"], how="full_outer")
    vc = F.coalesce(F.col("v"), F.lit(0)).cast("long")
    oc = F.coalesce(F.col("o"), F.lit(0)).cast("long")
    rate = F.when(vc > 0, oc.cast("double") / vc).otherwise(F.lit(0.0))
    return _unnest(j, "user_id", vc.alias("view_count"), oc.alias("order_count"),
                   rate.alias("conversion_rate"))


def user_sessions_from_events(events: DataFrame,
                              window: str = config.SESSION_WINDOW) -> DataFrame:
    """Fixed-window activity per user (Q05, T15: not gap sessions).

    Duration subtracts floored epoch seconds, as the reference does.
    """
    agg = (events.groupBy(F.window("timestamp", window).alias("window"), "user_id")
                 .agg(F.count(F.lit(1)).alias("events_count"),
                      F.sum(_is("view")).alias("views_count"),
                      F.sum(_is("order")).alias("orders_count"),
                      F.min("timestamp").alias("session_start"),
                      F.max("timestamp").alias("session_end")))
    dur = F.unix_timestamp("session_end") - F.unix_timestamp("session_start")
    return _unnest(agg, "user_id", dur.alias("session_duration_seconds"),
                   "events_count", "views_count", "orders_count",
                   (F.col("orders_count") > 0).alias("has_conversion"))


def user_sessions(views: DataFrame, orders: DataFrame,
                  window: str = config.SESSION_WINDOW) -> DataFrame:
    return user_sessions_from_events(funnel_events(views, orders), window)


def gap_sessions(views: DataFrame, orders: DataFrame, gap: str = "5 minutes") -> DataFrame:
    """Extension, named apart from Q05: true inactivity-gap sessions via
    ``session_window`` (works in batch and streaming)."""
    ev = funnel_events(views, orders)
    agg = (ev.groupBy(F.session_window("timestamp", gap).alias("window"), "user_id")
             .agg(F.count(F.lit(1)).alias("events_count"),
                  F.sum(_is("view")).alias("views_count"),
                  F.sum(_is("order")).alias("orders_count")))
    return _unnest(agg, "user_id", "events_count", "views_count", "orders_count",
                   (F.col("orders_count") > 0).alias("has_conversion"))
