"""Data-quality checks (K36-K41) and threshold bands.

Whole-table statistics are single global aggregates (partial per task, one
tiny final merge).  The outlier filter (K41, F7/J4) replaces the reference's
two scalar subqueries with one aggregate whose single row gives two literal
bounds, so the filter reaches the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.exprs import as_of_lit, band, lookback, safe_ratio, seconds_between


# Processing-lag bands (seconds): the panel with the sensible direction
# (>= 10 warning, >= 60 critical) is used for freshness too.
LAG_BANDS = [(10.0, "warning"), (60.0, "critical")]
# Request latency bands (ms)
LATENCY_BANDS = [(100.0, "warning"), (500.0, "critical")]
# Request rate bands (ops/s)
RATE_BANDS = [(5.0, "warning"), (10.0, "critical")]


def freshness(orders: DataFrame, as_of=None, empty_value: float | None = 999.0,
              alias: str = "data_freshness_seconds") -> DataFrame:
    """Seconds since the newest order; ``empty_value`` when there is none
    (999 in one panel, null in the processing-lag panels)."""
    lag = seconds_between(as_of_lit(as_of), F.max("timestamp"))
    if empty_value is not None:
        lag = F.coalesce(lag, F.lit(float(empty_value)))
    out = orders.agg(lag.alias(alias))
    return out.withColumn("status", band(alias, LAG_BANDS))


def null_timestamp_pct(orders: DataFrame) -> DataFrame:
    """Share of rows without an event time, in percent (null if empty)."""
    return orders.agg((safe_ratio(F.count_if(F.col("timestamp").isNull()), F.count(F.lit(1)))
                       * F.lit(100.0)).alias("null_timestamps_pct"))


def order_id_uniqueness_pct(orders: DataFrame) -> DataFrame:
    """Distinct ids / rows * 100 (100 = no duplicates; T18 naming)."""
    return orders.agg((safe_ratio(F.count_distinct("order_id"), F.count(F.lit(1)))
                       * F.lit(100.0)).alias("order_id_uniqueness_pct"))


def min_price(orders: DataFrame) -> DataFrame:
    """Smallest price, 0 for an empty table."""
    return orders.agg(F.coalesce(F.min("price"), F.lit(0.0)).alias("min_price"))


def quality_by_currency(orders: DataFrame, interval: str = "1 hour", as_of=None) -> DataFrame:
    """Count, mean, min, max, sample stddev per currency."""
    return (orders.where(lookback("timestamp", interval, as_of, inclusive=True))
                  .groupBy("currency").agg(
                      F.count(F.lit(1)).alias("order_count"),
                      F.avg("price").alias("avg_price"),
                      F.min("price").alias("min_price"),
                      F.max("price").alias("max_price"),
                      F.stddev_samp("price").alias("price_stddev"))
                  .orderBy(F.desc("order_count"), F.asc("currency")))


def outlier_bounds(orders: DataFrame, sigmas: float = 3.0) -> tuple:
    """(upper, lower) bounds: the upper over all rows, the lower over positive
    prices only (T17).  One global aggregate (one pass, partial per task);
    its single row -- two numbers -- comes back to the driver."""
    pos = F.when(F.col("price") > 0, F.col("price"))
    r = orders.agg(
        (F.avg("price") + F.lit(sigmas) * F.stddev_samp("price")).alias("hi"),
        (F.avg(pos) - F.lit(sigmas) * F.stddev_samp(pos)).alias("lo")).first()
    return r["hi"], r["lo"]


def price_outliers(orders: DataFrame, sigmas: float = 3.0, k: int | None = 20,
                   prices: DataFrame | None = None) -> DataFrame:
    """K41 (F7, J4): rows outside mean +- 3 sample stddev, newest first.

    ``prices`` may give the same prices from a cheaper view (no joins) for the
    bounds.  The bounds are literals in the second pass (one action when the
    DataFrame is built), so the predicate is pushed
    through the joins of a derived view into the parquet scan, where
    row-group min/max statistics skip the (mostly outlier-free) data.
    """
    hi, lo = outlier_bounds(orders if prices is None else prices, sigmas)
    conds = [F.col("price") > F.lit(hi)] if hi is not None else []
    if lo is not None:
        conds.append(F.col("price") < F.lit(lo))
    if not conds:
        cond = F.lit(False)
    else:
        cond = conds[0] if len(conds) == 1 else conds[0] | conds[1]
    out = (orders.where(cond)
                 .select("order_id", "user_id", "product_id", "price", "currency", "timestamp"))
    if k is None:
        return out
    return out.orderBy(F.desc("timestamp"), F.asc("order_id")).limit(k)


def banded(df: DataFrame, column: str, steps, alias: str = "status") -> DataFrame:
    """X22 as an operator: label a metric column by (lower bound, label) steps."""
    return df.withColumn(alias, band(column, steps))
