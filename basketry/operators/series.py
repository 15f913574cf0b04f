"""Time series and metric samples: share of total (W1), counter rate with
resets (W2), latest gauge (W3), series reducers (B8), and event rates per topic.

Counter rates are joined from segments of a second, so no series, and no day of
one, is ever sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# topic of each event type of the driver's events table
TOPIC_OF = {"purchase": "orders", "view": "product-view",
            "signup": "user-events", "click": "user-events", "error": "user-events"}

def share_of_total(df: DataFrame, value: str, alias: str = "share") -> DataFrame:
    """Value / total, the total being a scalar subquery (one global sum)."""
    total = df.select(F.sum(value).cast("double")).scalar()
    return df.withColumn(alias, F.try_divide(F.col(value).cast("double"), total))


def _topic():
    e = None
    for src, dst in TOPIC_OF.items():
        c = F.col("event_type") == src
        e = F.when(c, F.lit(dst)) if e is None else e.when(c, F.lit(dst))
    return e


def event_rate(events: DataFrame, by: str = "topic", size: str | None = None,
               window: str = "1 minute") -> DataFrame:
    """Events (or bytes of column ``size``) per second, per window and topic or
    event type: sums of the events themselves, partial per task."""
    key = _topic() if by == "topic" else F.col(by)
    e = events.select(F.window(F.col("ts").cast("timestamp"), window).alias("w"), key.alias(by),
                      (F.octet_length(size) if size else F.lit(1)).alias("n"))
    secs = (F.unix_seconds(F.col("w.end")) - F.unix_seconds(F.col("w.start"))).cast("double")
    return (e.groupBy("w", by).agg(F.sum("n").alias("n"))
             .select(F.col("w.start").alias("time"), by, (F.col("n") / secs).alias("rate")))


def latest_value(events: DataFrame, by: str = "event_type") -> DataFrame:
    """W3 over events: the newest ``value`` of each event type (ties: largest event_id)."""
    return (events.where(F.col("value").isNotNull()).groupBy(by)
            .agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"), F.max("ts").cast("timestamp").alias("ts")))


def _increase(before, after):
    """What a counter has gained between two samples: a drop is a reset to 0."""
    return F.when(after < before, after).otherwise(after - before)


def _join(a, b):
    """(first, last, inc) of two neighbouring segments as one; associative."""
    return F.struct(a["first"].alias("first"), b["last"].alias("last"),
                    (a["inc"] + b["inc"] + _increase(a["last"], b["first"])).alias("inc"))


def _joined(segments):
    """A sorted array of (at, first, last, inc) as one (first, last, inc)."""
    as_one = lambda x: F.struct(x["first"].alias("first"), x["last"].alias("last"), x["inc"].alias("inc"))
    return F.aggregate(F.slice(segments, 2, F.greatest(F.size(segments) - 1, F.lit(0))), as_one(segments[0]),
                       lambda a, x: _join(a, as_one(x)))


def segment_rate(samples: DataFrame, series: str, ts: str = "ts", value: str = "value",
                 tie: str | None = None, window: str = "1 minute", segment: str = "1 second") -> DataFrame:
    """Per-second rate of a counter per series and window.

    Samples become segments (first, last, increase), one per series and
    ``segment``; segments join in time order to one per window, and a window's
    first step comes from the last value of the series' window before it.  What is
    ordered in one task is a segment's samples, a window's segments, or the windows
    of a series and day, never a series or a day of samples."""
    at = F.struct(*([ts, tie] if tie else [ts]))
    s = samples.where(F.col(value).isNotNull()).withColumn("w", F.window(F.col(ts).cast("timestamp"), window))
    s = s.withColumn("_s", F.window(F.col(ts).cast("timestamp"), segment)).select(
        series, "w", F.col("_s.start").alias("_s"),
        F.struct(at.alias("at"), F.col(value).cast("double").alias("first"), F.col(value).cast("double").alias("last"),
                 F.lit(0.0).alias("inc")).alias("x"))
    seg = s.groupBy(series, "w", "_s").agg(_joined(F.sort_array(F.collect_list("x"))).alias("g"), F.count(F.lit(1)).alias("n"))
    seg = seg.select(series, "w", F.struct(F.col("_s").alias("at"), "g.first", "g.last", "g.inc").alias("x"), "n")
    win = seg.groupBy(series, "w").agg(_joined(F.sort_array(F.collect_list("x"))).alias("g"), F.sum("n").alias("n"))
    win = win.withColumn("day", F.to_date("w.start"))
    last = F.col("g.last")
    days = win.groupBy(series, "day").agg(F.max_by(last, F.col("w.start")).alias("_last"))
    carry = days.select(series, "day", F.lag("_last").over(Window.partitionBy(series).orderBy("day")).alias("_carry"))
    before = F.coalesce(F.lag(last).over(Window.partitionBy(series, "day").orderBy("w")), F.col("_carry"))
    out = win.join(carry, [series, "day"]).withColumn("_before", before)
    inc = F.col("g.inc") + F.coalesce(_increase(F.col("_before"), F.col("g.first")), F.lit(0.0))
    secs = (F.unix_seconds(F.col("w.end")) - F.unix_seconds(F.col("w.start"))).cast("double")
    # a window that holds the series' first sample alone has no step yet
    steps = F.col("_before").isNotNull() | (F.col("n") > 1)
    return out.where(steps).select(F.col("w.start").alias("time"), series, (inc / secs).alias("rate"))


def counter_rate(samples: DataFrame, name: str, label: str, window: str = "1 minute") -> DataFrame:
    """W2 over metric samples: rate of counter ``name`` per value of ``label``.

    increase = sum of consecutive deltas inside the window, where a drop
    (counter reset) counts the new value itself; rate = increase / window
    seconds.  No extrapolation to the window edges."""
    s = samples.where(F.col("name") == F.lit(name)).select("ts", F.col("labels")[label].alias(label), "value")
    return segment_rate(s, label, window=window).orderBy("time", label)


def latest_gauge(samples: DataFrame, name: str, label: str | None = None,
                 value: str | None = None) -> DataFrame:
    """Newest sample of a gauge per label value, optionally one label value."""
    s = samples.where(F.col("name") == F.lit(name))
    if label is None:
        return s.agg(F.max_by("value", "ts").alias("value"), F.max("ts").alias("ts"))
    s = s.select("ts", F.col("labels")[label].alias(label), "value")
    if value is not None:
        s = s.where(F.col(label) == F.lit(value))
    return s.groupBy(label).agg(F.max_by("value", "ts").alias("value"), F.max("ts").alias("ts"))


def reducers(series: DataFrame, time: str = "time", metric: str = "metric",
             value: str = "value") -> DataFrame:
    """Legend reducers per series."""
    nn = F.col(value).isNotNull()
    return series.groupBy(metric).agg(
        F.max_by(value, time).alias("last"),
        F.max_by(F.when(nn, F.col(value)), F.when(nn, F.col(time))).alias("last_not_null"),
        F.avg(value).alias("mean"),
        F.max(value).alias("max"),
        F.min(value).alias("min"),
        F.sum(value).alias("total"),
        F.stddev_samp(value).alias("std_dev"))
