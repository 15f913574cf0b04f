"""Distinct users on streams: a mergeable sketch per window.

An exact distinct count keeps every id in the state.  The named approximate
variant keeps one HyperLogLog sketch per window (``hll_sketch_agg``, 2**LG_K
registers) and stores it with the window; any longer span is the union of its
windows' sketches.  Relative standard error: 1.04 / sqrt(2**LG_K), 0.65 percent;
``ERROR`` is three times that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry import config
from basketry.streaming.pipelines import Trigger, _start, orders_stream
from basketry.streaming.sinks import UpsertSink
from basketry.streaming.versions import Table

LG_K = 14
ERROR = 3 * 1.04 / (1 << LG_K) ** 0.5
KEYS = ["window_start", "currency"]


def user_sketches(orders: DataFrame, window: str = config.REVENUE_WINDOW) -> DataFrame:
    """(window_start, window_end, currency, users): a sketch of the users per window."""
    agg = orders.groupBy(F.window("timestamp", window).alias("w"), "currency").agg(F.hll_sketch_agg("user_id", LG_K).alias("users"))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "currency", "users")


def start_user_sketches(raw_orders: DataFrame, table_path: str, checkpoint: str, trigger: Trigger = Trigger(),
                        window: str = config.REVENUE_WINDOW, watermark: str = config.WATERMARK) -> StreamingQuery:
    valid, _ = orders_stream(raw_orders)
    return _start(user_sketches(valid.withWatermark("timestamp", watermark), window), UpsertSink(table_path, KEYS),
                  f"{checkpoint}/user_sketches", "update", trigger)


def read_sketches(spark: SparkSession, table_path: str) -> DataFrame | None:
    return Table(table_path, "latest", KEYS).read(spark)


def unique_users(sketches: DataFrame, *by) -> DataFrame:
    """Estimated distinct users of all windows, or of the windows of each ``by``."""
    one = F.hll_sketch_estimate(F.hll_union_agg("users")).alias("unique_users")
    return sketches.groupBy(*by).agg(one) if by else sketches.agg(one)
