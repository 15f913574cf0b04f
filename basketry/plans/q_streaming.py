"""Streaming queries replayed from files (``st_*``): Q01-Q05.

Each callable publishes the fixture feeds as JSON-lines files, runs the
streaming query over them piece by piece (availableNow, restart from the
checkpoint between pieces) and returns the table its sink built.  In-order
replay drops nothing, so the update-mode tables equal the batch answers; the
append-mode tables hold the windows the final watermark has closed.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import functions as F

from basketry import schemas
from basketry.plans.q_windows import _funnel_sql, _revenue_sql
from basketry.plans.registry import register
from basketry.plans.sqlviews import bucket, sessions_table, with_
from basketry.sources import fixtures as fx
from basketry.streaming import health, late, sinks, sketches
from basketry.streaming import pipelines as pl
from basketry.streaming.replay import replay, replayed_orders

NOW_TRIGGER = pl.Trigger(processing_time=None, available_now=True)
PIECES = 4


@register("st_orders_ingest", with_("orders_raw") + "SELECT * FROM orders_raw")
def st_orders(spark, sf):
    """Q01: decode, idempotent append of every row, one row per order id on read."""
    root = replay(spark, sf, lambda st, root: pl.start_orders_ingest(
        st["orders"], f"{root}/tables/orders_raw", f"{root}/checkpoints", NOW_TRIGGER,
        quarantine_path=f"{root}/tables/orders_quarantine"), "orders", PIECES, ("orders",))
    return sinks.read_orders(spark, f"{root}/tables/orders_raw", schemas.ORDERS_RAW)


@register("st_revenue_by_currency_5min", _revenue_sql("5 minutes"))
def st_revenue(spark, sf):
    """Q02: update mode + keyed upsert."""
    root = replay(spark, sf, lambda st, root: [pl.start_revenue(
        st["orders"], f"{root}/tables/revenue", f"{root}/checkpoints", NOW_TRIGGER)],
        "revenue", PIECES, ("orders",))
    return sinks.read_latest(spark, f"{root}/tables/revenue",
                             schemas.TABLES["revenue_by_currency_5min"][1],
                             schemas.REVENUE_BY_CURRENCY)


@register("st_conversion_funnel_5min", _funnel_sql("5 minutes"))
def st_funnel(spark, sf):
    """Q03: union of the two feeds, one watermark, update mode + upsert."""
    root = replay(spark, sf, lambda st, root: [pl.start_funnel(
        st["views"], st["orders"], f"{root}/tables/funnel", f"{root}/checkpoints", NOW_TRIGGER)],
        "funnel", PIECES)
    return sinks.read_latest(spark, f"{root}/tables/funnel",
                             schemas.TABLES["conversion_funnel_5min"][1],
                             schemas.CONVERSION_FUNNEL)


_CLOSED = ("(SELECT MAX(t) FROM (SELECT \"timestamp\" AS t FROM orders_raw UNION ALL "
           "SELECT \"timestamp\" FROM product_views) x) - INTERVAL '10 minutes'")


@register("st_user_sessions_5min", with_("orders_raw", "product_views", sessions_table("ses")) +
          f"SELECT * FROM ses WHERE window_end <= {_CLOSED}")
def st_sessions(spark, sf):
    """Q05: append mode; windows closed by the final watermark."""
    root = replay(spark, sf, lambda st, root: [pl.start_sessions(
        st["views"], st["orders"], f"{root}/tables/sessions", f"{root}/checkpoints", NOW_TRIGGER)],
        "sessions", PIECES)
    return sinks.read_appended(spark, f"{root}/tables/sessions", schemas.USER_SESSIONS)


def _pairs_sql() -> str:
    b = bucket('"timestamp"', "30 minutes")
    return with_("orders_raw") + f""", b AS (
  SELECT DISTINCT window_start, user_id, product_id FROM (
    SELECT {b} AS window_start, user_id, product_id FROM orders_raw
    UNION ALL
    SELECT {b} - INTERVAL '30 minutes', user_id, product_id FROM orders_raw) x
  WHERE product_id IS NOT NULL)
SELECT a.product_id, b2.product_id AS recommended_product_id,
       CAST(COUNT(*) AS DOUBLE) AS score, COUNT(*) AS co_purchase_count
FROM b a JOIN b b2 ON a.window_start = b2.window_start AND a.user_id = b2.user_id
                  AND a.product_id < b2.product_id
GROUP BY 1, 2"""


@register("st_product_recommendations", _pairs_sql())
def st_recommendations(spark, sf):
    """Q04 / ST9: closed baskets -> per-batch pair deltas -> summed table, and the
    baskets that are still open at the end of the run."""
    root = replay(spark, sf, lambda st, root: [pl.start_recommendations(
        st["orders"], f"{root}/tables/pairs", f"{root}/checkpoints", NOW_TRIGGER)],
        "recommendations", PIECES, ("orders",))
    pl.flush_recommendations(replayed_orders(spark, root), f"{root}/tables/pairs")
    t = sinks.read_summed(spark, f"{root}/tables/pairs", ["product_id", "recommended_product_id"],
                          ["co_purchase_count"])
    return t.select("product_id", "recommended_product_id",
                    F.col("co_purchase_count").cast("double").alias("score"), "co_purchase_count")


# ---- ST5: late rows kept and repaired ----------------------------------------------

@register("st_revenue_repaired_after_disorder", _revenue_sql("5 minutes"))
def st_revenue_repaired(spark, sf):
    """Q02 on a feed whose pieces arrive out of order: the stream drops what comes
    too late, the side table keeps it, and the repair computes those windows again
    from the raw table."""
    def start(st, root):
        return [*pl.start_orders_ingest(st["orders"], f"{root}/tables/orders_raw", f"{root}/checkpoints", NOW_TRIGGER),
                pl.start_revenue(st["orders"], f"{root}/tables/revenue", f"{root}/checkpoints", NOW_TRIGGER),
                late.start_late_orders(st["orders"], f"{root}/tables/late", f"{root}/checkpoints", NOW_TRIGGER)]
    root = replay(spark, sf, start, "disorder", PIECES, ("orders",), order=[1, 3, 0, 2])
    orders = sinks.read_orders(spark, f"{root}/tables/orders_raw", schemas.ORDERS_RAW)
    late.repair_revenue(spark, f"{root}/tables/late", orders, f"{root}/tables/revenue")
    return sinks.read_latest(spark, f"{root}/tables/revenue", schemas.TABLES["revenue_by_currency_5min"][1],
                             schemas.REVENUE_BY_CURRENCY)


# ---- ST14: job health ---------------------------------------------------------------

@register("st14_job_health", with_("orders_raw", "product_views") + """
SELECT job, rows AS input_rows, 0 AS dropped_rows, 0 AS failures FROM (
  SELECT 'orders' AS job, COUNT(*) AS rows FROM orders_raw
  UNION ALL SELECT 'revenue', COUNT(*) FROM orders_raw
  UNION ALL SELECT 'recommendations', COUNT(*) FROM orders_raw
  UNION ALL SELECT 'funnel', (SELECT COUNT(*) FROM orders_raw) + (SELECT COUNT(*) FROM product_views)
  UNION ALL SELECT 'sessions', (SELECT COUNT(*) FROM orders_raw) + (SELECT COUNT(*) FROM product_views)) x""")
def st_health(spark, sf):
    """Every job of ``start_all``, watched by the listener's table."""
    tag = f"h{uuid.uuid4().hex[:8]}"
    jobs = ("orders", "revenue", "funnel", "recommendations", "sessions")
    out = {}

    def start(st, root):
        if not out:
            out["session"] = st["orders"].sparkSession
            out["listener"] = health.HealthListener(spark, f"{root}/tables/job_health", watch={f"{tag}-{j}" for j in jobs})
            out["session"].streams.addListener(out["listener"])
        return pl.start_all(st["orders"], st["views"], root, NOW_TRIGGER, names=tag)
    root = replay(spark, sf, start, "health", 2)
    listener = out["listener"]
    for _ in range(200):                 # the listener's bus runs behind the jobs
        if listener.settled():
            break
        time.sleep(0.1)
    listener.flush()
    out["session"].streams.removeListener(listener)
    h = health.job_health(health.read_health(spark, f"{root}/tables/job_health"))
    return h.select(F.regexp_replace("job", f"^{tag}-", "").alias("job"), F.col("input_rows").cast("long").alias("input_rows"),
                    F.col("dropped_rows").cast("int").alias("dropped_rows"), F.col("failures").cast("int").alias("failures"))


# ---- A8 / K05: mergeable sketches ------------------------------------------------------

@register("k05_unique_users_from_sketches", with_("orders_raw") + """
SELECT date_trunc('day', "timestamp") AS day, COUNT(DISTINCT user_id) AS exact_users, TRUE AS within_stated_error
FROM orders_raw GROUP BY 1""")
def k05_sketches(spark, sf):
    """Daily distinct users from 5-minute sketches that a stream has stored, beside
    the exact count and whether the estimate keeps the stated error."""
    root = replay(spark, sf, lambda st, root: [sketches.start_user_sketches(
        st["orders"], f"{root}/tables/user_sketches", f"{root}/checkpoints", NOW_TRIGGER)], "sketches", 2, ("orders",))
    day = F.date_trunc("day", F.col("window_start")).alias("day")
    found = sketches.unique_users(sketches.read_sketches(spark, f"{root}/tables/user_sketches"), day)
    exact = fx.orders_raw(spark, sf).groupBy(F.date_trunc("day", F.col("timestamp")).alias("day")).agg(F.count_distinct("user_id").alias("exact_users"))
    error = F.abs(F.col("unique_users") - F.col("exact_users")) / F.col("exact_users")
    return exact.join(found, "day", "left").select("day", "exact_users", F.coalesce(error <= sketches.ERROR, F.lit(False)).alias("within_stated_error"))
