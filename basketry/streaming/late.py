"""Late rows of windowed jobs: kept in a side table, repaired later (ST5).

A windowed query drops rows whose window the watermark has closed.  The side
job sees the same feed without state and keeps every row that such a query may
have dropped: its window ends at or before the largest event time seen so far
(this batch included) less the delay.  That is no smaller than the watermark of
any query that reads the feed in the same order, however it cuts its batches, so
nothing is missed; a row kept for nothing only has its window computed again.

:func:`repair` computes the touched windows again, and only those, from the raw
rows, and publishes them as the newest rows of the window table.  Windows are
found by equality on their start, and the raw scan is bounded by the first and
the last of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry import config, schemas
from basketry.operators import windows
from basketry.streaming import versions
from basketry.streaming.pipelines import Trigger, _start, orders_stream, views_stream
from basketry.streaming.versions import Table, Version


def _window(ts: str, window: str) -> Column:
    return F.window(ts, window)


def _interval(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


class LateSink:
    """Rows that a query with this window and watermark may have dropped."""

    def __init__(self, path: str, window: str, watermark: str, **options):
        self.table, self.window, self.watermark = Table(path, "append", **options), window, watermark

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        run = versions.current_run(spark)
        v = versions.version(spark, self.table.path)
        if v.runs.get(run, -1) >= batch_id:
            return
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            top = df.agg(F.unix_micros(F.max("timestamp"))).first()[0]
            if top is None:
                return
            top = max(top, v.notes.get("top", top))
            closed = F.timestamp_micros(F.lit(top)) - _interval(self.watermark)
            late = df.withColumn("_w", _window("timestamp", self.window)).where(F.col("_w.end") <= closed)
            late = late.withColumn("window_start", F.col("_w.start")).drop("_w")
            if late.isEmpty():
                self.table.note(spark, top=top)
                return
            self.table.add(late, batch_id, run, notes={"top": top})
        finally:
            df.unpersist()


def start_late_orders(raw_orders: DataFrame, late_path: str, checkpoint: str, trigger: Trigger = Trigger(),
                      window: str = config.REVENUE_WINDOW, watermark: str = config.WATERMARK) -> StreamingQuery:
    return _start(orders_stream(raw_orders)[0], LateSink(late_path, window, watermark),
                  f"{checkpoint}/late_orders", "append", trigger)


def start_late_events(raw_views: DataFrame, raw_orders: DataFrame, late_path: str, checkpoint: str,
                      trigger: Trigger = Trigger(), window: str = config.FUNNEL_WINDOW,
                      watermark: str = config.WATERMARK) -> StreamingQuery:
    """Late views and orders of the funnel, which has one watermark for both."""
    ev = windows.funnel_events(views_stream(raw_views), orders_stream(raw_orders)[0])
    return _start(ev, LateSink(late_path, window, watermark), f"{checkpoint}/late_events", "append", trigger)


def pending(spark: SparkSession, late_path: str) -> tuple[DataFrame | None, int]:
    """(late rows since the last repair, the seq up to which they go)."""
    v = versions.version(spark, late_path)
    done = v.notes.get("repaired", 0)
    if v.schema is None or not (folders := [f for f in v.folders if f.seq > done]):
        return None, done
    # a fold may have put repaired rows beside new ones: repairing twice is harmless
    return versions.frame(spark, late_path, folders, versions.schema_of(v)), max(f.seq for f in v.folders)


def repair(spark: SparkSession, late_path: str, raw: DataFrame, compute: Callable[[DataFrame], DataFrame],
           table: Table, window: str) -> Version | None:
    """Compute the windows of the pending late rows again, from ``raw``.

    ``compute`` makes window rows from raw rows (a batch transform).  A repair
    that is run again, or dies between its two steps, publishes the same rows."""
    late, upto = pending(spark, late_path)
    if late is None:
        return None
    touched = late.select("window_start").distinct().persist(StorageLevel.MEMORY_AND_DISK)
    try:
        span = touched.agg(F.min("window_start").alias("a"), F.max("window_start").alias("b")).first()
        rows = raw.where((F.col("timestamp") >= F.lit(span.a)) & (F.col("timestamp") < F.lit(span.b) + _interval(window)))
        rows = rows.withColumn("window_start", _window("timestamp", window).getField("start"))
        rows = rows.join(touched, "window_start", "left_semi").drop("window_start")
        out = table.add(compute(rows), upto, f"repair of {late_path}")
        Table(late_path, "append").note(spark, repaired=upto)
        return out
    finally:
        touched.unpersist()


def repair_revenue(spark: SparkSession, late_path: str, orders: DataFrame, table_path: str,
                   window: str = config.REVENUE_WINDOW) -> Version | None:
    table = Table(table_path, "latest", schemas.TABLES["revenue_by_currency_5min"][1])
    return repair(spark, late_path, orders, lambda o: windows.revenue_by_currency(o, window), table, window)


def repair_funnel(spark: SparkSession, late_path: str, events: DataFrame, table_path: str,
                  window: str = config.FUNNEL_WINDOW) -> Version | None:
    """``events``: views and orders as ``windows.funnel_events`` gives them."""
    table = Table(table_path, "latest", schemas.TABLES["conversion_funnel_5min"][1])
    return repair(spark, late_path, events, lambda e: windows.conversion_funnel_from_events(e, window), table, window)
