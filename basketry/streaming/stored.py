"""Window tables as queries read them: closed windows of the stored table, and
the windows after a freshness cut rebuilt from the raw rows.

The cut lies ``delay`` before the start of the newest stored window, on a window
border: windows that end there were closed by the writer's watermark.  Rows of
the raw table are read from the cut on only, so the raw scan is bounded by how
far the table lags, not by the table's length.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import config
from basketry.streaming.versions import Table


def freshness_cut(stored: DataFrame, window: str, delay: str = config.WATERMARK) -> dt.datetime | None:
    """The end of the last window that is surely final; one row to the driver."""
    newest = F.max("window_start") - F.expr(f"INTERVAL {delay}")
    return stored.agg(newest.alias("t")).select(F.window("t", window).getField("start").alias("cut")).first()[0]


def windows_upto_now(spark: SparkSession, table: Table, raw: DataFrame, compute: Callable[[DataFrame], DataFrame],
                     window: str, delay: str = config.WATERMARK, cut: dt.datetime | None = None) -> DataFrame:
    """Stored windows up to the cut, and ``compute`` of the raw rows from it on."""
    stored = table.read(spark)
    if stored is not None and cut is None:
        cut = freshness_cut(stored, window, delay)
    if stored is None or cut is None:
        return compute(raw)
    tail = compute(raw.where(F.col("timestamp") >= F.lit(cut)))
    return stored.where(F.col("window_end") <= F.lit(cut)).unionByName(tail.select(*stored.columns))
