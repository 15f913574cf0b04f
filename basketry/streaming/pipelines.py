"""Streaming queries Q01-Q05: decode -> watermark -> shared transform -> sink.

The transforms are the same functions the batch queries use
(``basketry.operators``); only the watermark, output mode, trigger,
checkpoint and sink are streaming concerns.  Inputs are streaming
DataFrames with a text ``value`` column (Kafka or JSON-lines files).

Checkpoints must live under the shared folder named by
``spark.checkpoint.dir`` (``basketry.session.run_dir``); the state store is
RocksDB (``basketry.session.DEFAULTS``) so state size is bounded by disk,
not executor heap.  ``spark.sql.shuffle.partitions`` is fixed by the first
checkpoint of a stateful query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery

from basketry import config, schemas
from basketry.operators import baskets, windows
from basketry.sources.events import decode_orders, decode_views, split_valid
from basketry.streaming.sinks import AppendSink, DeltaSink, JdbcUpsertSink, OrdersSink, ReplaceSink, UpsertSink
from basketry.streaming.versions import DeltaTable, Version


@dataclass
class Trigger:
    """``processing_time`` for a running job, ``available_now`` for replay."""
    processing_time: str | None = config.TRIGGER
    available_now: bool = False

    def apply(self, writer):
        if self.available_now:
            return writer.trigger(availableNow=True)
        if self.processing_time:
            return writer.trigger(processingTime=self.processing_time)
        return writer


def _start(df: DataFrame, sink, checkpoint: str, mode: str, trigger: Trigger,
           name: str | None = None) -> StreamingQuery:
    w = (df.writeStream.outputMode(mode).foreachBatch(sink)
           .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    return trigger.apply(w).start()


def orders_stream(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid orders, quarantined rows) from a raw JSON stream."""
    return split_valid(decode_orders(raw, keep_raw=True))


def views_stream(raw: DataFrame) -> DataFrame:
    return split_valid(decode_views(raw))[0]


def start_orders_ingest(raw_orders: DataFrame, table_path: str, checkpoint: str,
                        trigger: Trigger = Trigger(), watermark: str = config.WATERMARK,
                        quarantine_path: str | None = None, drop_late: bool = False,
                        sink=None, name: str | None = None) -> list[StreamingQuery]:
    """Q01: every decoded order is appended, however late (SNK1, T6).

    The query is stateless: retries are idempotent, and the sink settles
    duplicates inside a batch and across batches by order id, the earliest row
    winning (ST13; ``ingest.OrdersTable``).

    ``drop_late=True`` removes duplicates across batches while streaming
    (``dropDuplicatesWithinWatermark``, state bounded by the watermark); it
    loses rows that are later than the watermark, so it is not the default.
    Rows that fail to decode go to ``quarantine_path`` instead of the table.
    """
    valid, bad = orders_stream(raw_orders)
    if drop_late:
        valid = (valid.withWatermark("timestamp", watermark)
                      .dropDuplicatesWithinWatermark(["order_id"]))
    qs = [_start(valid, sink or OrdersSink(table_path, schemas.TABLES["orders_raw"][1][0]),
                 f"{checkpoint}/orders", "append", trigger, name)]
    if quarantine_path:
        qs.append(_start(bad, AppendSink(quarantine_path), f"{checkpoint}/quarantine",
                         "append", trigger))
    return qs


def start_views_quarantine(raw_views: DataFrame, quarantine_path: str, checkpoint: str,
                           trigger: Trigger = Trigger()) -> StreamingQuery:
    """View events that fail to decode, kept with their raw text."""
    bad = split_valid(decode_views(raw_views, keep_raw=True))[1]
    return _start(bad, AppendSink(quarantine_path), f"{checkpoint}/views_quarantine", "append", trigger)


def start_revenue(raw_orders: DataFrame, table_path: str, checkpoint: str,
                  trigger: Trigger = Trigger(), window: str = config.REVENUE_WINDOW,
                  watermark: str = config.WATERMARK, mode: str = "update",
                  sink=None, name: str | None = None) -> StreamingQuery:
    """Q02: update-mode window aggregate, keyed upsert on (window_start, currency).

    ``mode="complete"`` (ST8) re-emits the whole result each trigger into a
    replace sink; its state is never evicted, so keep it for small key spaces.
    """
    valid, _ = orders_stream(raw_orders)
    agg = windows.revenue_by_currency(valid.withWatermark("timestamp", watermark), window)
    if mode == "complete":
        return _start(agg, ReplaceSink(table_path), f"{checkpoint}/revenue_complete",
                      "complete", trigger)
    keys = schemas.TABLES["revenue_by_currency_5min"][1]
    return _start(agg, sink or UpsertSink(table_path, keys), f"{checkpoint}/revenue",
                  "update", trigger, name)


def start_funnel(raw_views: DataFrame, raw_orders: DataFrame, table_path: str, checkpoint: str,
                 trigger: Trigger = Trigger(), window: str = config.FUNNEL_WINDOW,
                 watermark: str = config.WATERMARK, sink=None, name: str | None = None) -> StreamingQuery:
    """Q03: union of both feeds, one watermark after the union (T7, ST2)."""
    ev = windows.funnel_events(views_stream(raw_views), orders_stream(raw_orders)[0])
    agg = windows.conversion_funnel_from_events(ev.withWatermark("timestamp", watermark), window)
    keys = schemas.TABLES["conversion_funnel_5min"][1]
    return _start(agg, sink or UpsertSink(table_path, keys), f"{checkpoint}/funnel",
                  "update", trigger, name)


def start_sessions(raw_views: DataFrame, raw_orders: DataFrame, table_path: str, checkpoint: str,
                   trigger: Trigger = Trigger(), window: str = config.SESSION_WINDOW,
                   watermark: str = config.WATERMARK, sink=None, name: str | None = None) -> StreamingQuery:
    """Q05: append mode -- each window is written once, after it closes (ST6)."""
    ev = windows.funnel_events(views_stream(raw_views), orders_stream(raw_orders)[0])
    agg = windows.user_sessions_from_events(ev.withWatermark("timestamp", watermark), window)
    sink = sink or AppendSink(table_path, schemas.TABLES["user_sessions_5min"][1], "window_end")
    return _start(agg, sink, f"{checkpoint}/sessions", "append", trigger, name)


def pair_deltas(closed: DataFrame) -> DataFrame:
    """foreachBatch body of ST9: closed (window, user, product) rows -> pair counts."""
    return baskets.basket_pair_counts(closed.select("window", "user_id", "product_id"),
                                      materialize=False)


def start_recommendations(raw_orders: DataFrame, table_path: str, checkpoint: str,
                          trigger: Trigger = Trigger(config.RECOMMENDATION_TRIGGER),
                          window: str = config.BASKET_WINDOW, slide: str = config.BASKET_SLIDE,
                          watermark: str = config.WATERMARK, name: str | None = None) -> StreamingQuery:
    """Q04 / ST9, rebuilt so it can run.

    Stage 1 (stateful, append): distinct (sliding window, user, product).  A
    window's rows are all emitted in the micro-batch where the watermark
    passes its end, so each basket arrives complete and exactly once.
    Stage 2 (foreachBatch): pairs of that batch's baskets, written as a
    per-batch delta; the table is the sum of deltas (``read_summed``), folded
    level by level.  Windows that the watermark has not closed are counted by
    :func:`flush_recommendations`.
    Baskets later than the watermark are dropped, as in every windowed query.
    """
    valid, _ = orders_stream(raw_orders)
    closed = (valid.where(F.col("product_id").isNotNull())
                   .withWatermark("timestamp", watermark)
                   .groupBy(F.window("timestamp", window, slide).alias("window"),
                            "user_id", "product_id")
                   .agg(F.count(F.lit(1)).alias("n")))
    sink = DeltaSink(table_path, schemas.TABLES["product_recommendations"][1], ["co_purchase_count"], pair_deltas)
    return _start(closed, sink, f"{checkpoint}/recommendations", "append", trigger, name)


def flush_recommendations(orders: DataFrame, table_path: str, window: str = config.BASKET_WINDOW,
                          slide: str = config.BASKET_SLIDE) -> Version:
    """The open windows at the end of a run, from the raw ``orders`` (batch): every
    window that ends after the last closed one.  Closed windows are not read again
    (the bound on the rows reaches the scan); a later batch replaces the flush."""
    table = DeltaTable(table_path, schemas.TABLES["product_recommendations"][1], ["co_purchase_count"])

    def count(end: int | None) -> DataFrame:
        rows = orders
        if end is not None:
            cut = F.timestamp_micros(F.lit(end))
            rows = rows.where(F.col("timestamp") >= cut - F.expr(f"INTERVAL {window}"))
        open_ = baskets.window_baskets(rows, window, slide)
        return baskets.basket_pair_counts(open_ if end is None else open_.where(F.col("window.end") > cut))

    return table.flush(orders.sparkSession, count)


#: Where each job starts reading a feed on its first run.
OFFSETS = {
    ("orders", "orders"): "latest",
    ("revenue", "orders"): "latest",
    ("funnel", "orders"): "earliest",
    ("funnel", "views"): "earliest",
    ("recommendations", "orders"): "latest",
    ("sessions", "orders"): "latest",
    ("sessions", "views"): "latest",
    ("quarantine", "views"): "earliest",
}


def start_all(raw_orders, raw_views, root: str, trigger: Trigger = Trigger(), with_disabled: bool = True,
              names: str | None = None, jdbc: dict | None = None, late: bool = False) -> list[StreamingQuery]:
    """ST12: the reference's job set in one session -- ingestion, revenue and
    funnel, plus (rebuilt) recommendations and sessions -- each with its own
    checkpoint and table under ``root``.

    ``raw_orders`` and ``raw_views`` are streaming DataFrames, or functions
    ``job name -> streaming DataFrame`` when the jobs' sources differ (their
    starting offsets, :data:`OFFSETS`).

    ``names`` names the queries ``<names>-<job>`` (for ``health.HealthListener``);
    ``jdbc`` (``url``, ``properties``) upserts orders, revenue, funnel and sessions
    into the database's tables of these names instead; ``late`` also keeps late rows
    for ``late.repair_revenue`` and ``late.repair_funnel``."""
    feed = lambda raw, job: raw(job) if callable(raw) else raw
    tables, checkpoints = f"{root}/tables", f"{root}/checkpoints"

    def of(job: str, table: str) -> dict:
        out = {"name": f"{names}-{job}"} if names else {}
        if jdbc:
            out["sink"] = JdbcUpsertSink(jdbc["url"], table, schemas.TABLES[table][1], jdbc.get("properties"))
        return out

    qs = start_orders_ingest(feed(raw_orders, "orders"), f"{tables}/orders_raw", checkpoints, trigger,
                             quarantine_path=f"{tables}/orders_quarantine", **of("orders", "orders_raw"))
    qs.append(start_views_quarantine(feed(raw_views, "quarantine"), f"{tables}/views_quarantine", checkpoints, trigger))
    qs.append(start_revenue(feed(raw_orders, "revenue"), f"{tables}/revenue_by_currency_5min", checkpoints, trigger,
                            **of("revenue", "revenue_by_currency_5min")))
    qs.append(start_funnel(feed(raw_views, "funnel"), feed(raw_orders, "funnel"), f"{tables}/conversion_funnel_5min",
                           checkpoints, trigger, **of("funnel", "conversion_funnel_5min")))
    if with_disabled:
        rec_trigger = trigger if trigger.available_now else Trigger(config.RECOMMENDATION_TRIGGER)
        qs.append(start_recommendations(feed(raw_orders, "recommendations"), f"{tables}/product_recommendations",
                                        checkpoints, rec_trigger, name=f"{names}-recommendations" if names else None))
        qs.append(start_sessions(feed(raw_views, "sessions"), feed(raw_orders, "sessions"), f"{tables}/user_sessions_5min",
                                 checkpoints, trigger, **of("sessions", "user_sessions_5min")))
    if late:
        from basketry.streaming.late import start_late_events, start_late_orders
        qs.append(start_late_orders(feed(raw_orders, "revenue"), f"{tables}/late_orders", checkpoints, trigger))
        qs.append(start_late_events(feed(raw_views, "funnel"), feed(raw_orders, "funnel"), f"{tables}/late_events",
                                    checkpoints, trigger))
    return qs


def await_all(spark, queries: list[StreamingQuery]) -> None:
    """Wait on *any* query (the reference waits on the first only, so a later
    query's failure went unseen); on a failure stop the rest and raise."""
    pending = list(queries)
    while pending:
        for q in [q for q in pending if not q.isActive]:
            pending.remove(q)
            if q.exception() is not None:
                for other in pending:
                    other.stop()
                raise RuntimeError(f"streaming query {q.name or q.id} failed: {q.exception()}")
        # forget what ended before, in this run or another; what ends from here on wakes the wait
        spark.streams.resetTerminated()
        if pending and all(q.isActive for q in pending):
            try:
                spark.streams.awaitAnyTermination()
            except StreamingQueryException:
                pass                         # whose it is, the loop finds out
