"""Batch analyses over the raw and windowed tables: the batch SQL jobs
(Q06-Q12, Q17-Q23), KPI tiles and series (K01-K35, K42-K44).

Inputs: ``orders`` has the orders_raw columns, ``revenue`` the
revenue_by_currency columns, ``funnel`` the conversion_funnel columns.
``as_of`` replaces the dashboards' ``NOW()`` (T20).  Every ``limit`` follows
an ``orderBy`` with a key tiebreak, so Spark plans it as a per-partition
top-k (TakeOrderedAndProject) and results are deterministic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.exprs import lookback, round_half_up, safe_ratio



# ---- over the windowed revenue table -------------------------------------------

def top_currencies(revenue: DataFrame) -> DataFrame:
    """Q06: totals per currency; avg_order_value is the unweighted mean of
    window means (T9); weighted_avg_order_value is revenue / orders."""
    return (revenue.groupBy("currency").agg(
                F.sum("total_revenue").alias("total_revenue"),
                F.sum("order_count").alias("total_orders"),
                F.avg("avg_order_value").alias("avg_order_value"))
            .orderBy(F.desc("total_revenue"), F.asc("currency")))


def weighted_order_value(revenue: DataFrame) -> DataFrame:
    """Companion of Q06 (T9): order-weighted mean order value per currency."""
    return revenue.groupBy("currency").agg(
        safe_ratio(F.sum("total_revenue"), F.sum("order_count")).alias("weighted_avg_order_value"))


def revenue_by_time(revenue: DataFrame, k: int = 20) -> DataFrame:
    """Q09: all currencies per window, latest k windows."""
    return (revenue.groupBy("window_start", "window_end").agg(
                F.sum("total_revenue").alias("total_revenue"),
                F.sum("order_count").alias("total_orders"))
            .orderBy(F.desc("window_start")).limit(k))


def recent_revenue_windows(revenue: DataFrame, k: int = 10) -> DataFrame:
    """Q20: latest windows with money rounded to cents."""
    return (revenue.select("window_start", "window_end", "currency",
                           round_half_up("total_revenue", 2).alias("total_revenue"),
                           "order_count",
                           round_half_up("avg_order_value", 2).alias("avg_order_value"))
            .orderBy(F.desc("window_start"), F.asc("currency")).limit(k))


def latest_revenue_windows(revenue: DataFrame, k: int = 20, lookback_interval: str | None = None,
                           as_of: dt.datetime | None = None) -> DataFrame:
    """K27 (L3): newest windows first, larger revenue first inside a window."""
    r = revenue
    if lookback_interval:
        r = r.where(lookback("window_start", lookback_interval, as_of, inclusive=True))
    return (r.select("window_start", "window_end", "currency", "total_revenue",
                     "order_count", "avg_order_value")
             .orderBy(F.desc("window_start"), F.desc("total_revenue"), F.asc("currency")).limit(k))


def window_series(revenue: DataFrame, value: str, interval: str | None, as_of=None,
                  inclusive: bool = False, label: str = "currency") -> DataFrame:
    """One metric of the windowed table as (time, label, value);
    ``interval=None`` keeps the whole table."""
    r = revenue if interval is None else revenue.where(
        lookback("window_start", interval, as_of, inclusive))
    return (r.select(F.col("window_start").alias("time"), F.col("currency").alias(label),
                           F.col(value).alias("value"))
                   .orderBy("time", label))


def active_windows(revenue: DataFrame, interval: str = "30 minutes", as_of=None) -> DataFrame:
    """Windows starting within the lookback."""
    return (revenue.where(lookback("window_start", interval, as_of, inclusive=True))
                   .agg(F.count(F.lit(1)).alias("active_windows")))


# ---- over the conversion funnel table ------------------------------------------

def _pct(num, den):
    # ROUND(SUM(o) * 100.0 / SUM(v), 2): decimal arithmetic as in the SQL
    # job, result cast to double (T4); null instead of an error on 0.
    return F.round(F.try_divide(num.cast("decimal(38,0)") * F.lit(100).cast("decimal(3,0)"),
                                den.cast("decimal(38,0)")), 2).cast("double")


def user_conversion(funnel: DataFrame, k: int = 20) -> DataFrame:
    """Q07: rows without views are removed *before* summing."""
    g = (funnel.where(F.col("view_count") > 0).groupBy("user_id").agg(
            F.sum("view_count").alias("total_views"),
            F.sum("order_count").alias("total_orders")))
    rate = F.when(F.col("total_views") > 0, _pct(F.col("total_orders"), F.col("total_views"))) \
            .otherwise(F.lit(0.0))
    return (g.select("user_id", "total_views", "total_orders", rate.alias("conversion_rate"))
             .orderBy(F.desc("total_orders"), F.asc("user_id")).limit(k))


def overall_conversion(funnel: DataFrame) -> DataFrame:
    """Q08: one row over windows that had views."""
    return (funnel.where(F.col("view_count") > 0).agg(
                F.sum("view_count").alias("total_views"),
                F.sum("order_count").alias("total_orders"))
            .select("total_views", "total_orders",
                    _pct(F.col("total_orders"), F.col("total_views")).alias("overall_conversion_rate")))


def user_conversion_having(funnel: DataFrame, k: int = 10) -> DataFrame:
    """Q17: HAVING form -- order-only windows still count."""
    g = funnel.groupBy("user_id").agg(F.sum("view_count").alias("views"),
                                      F.sum("order_count").alias("orders"))
    return (g.where(F.col("views") > 0)
             .select("user_id", "views", "orders",
                     _pct(F.col("orders"), F.col("views")).alias("conversion_rate"))
             .orderBy(F.desc("orders"), F.asc("user_id")).limit(k))


def funnel_top_users(funnel: DataFrame, k: int = 10) -> DataFrame:
    """Q18."""
    return (funnel.groupBy("user_id").agg(F.sum("view_count").alias("total_views"),
                                          F.sum("order_count").alias("total_orders"))
                  .orderBy(F.desc("total_orders"), F.asc("user_id")).limit(k))


def recent_funnel_windows(funnel: DataFrame, k: int = 10) -> DataFrame:
    """Q21."""
    return funnel.orderBy(F.desc("window_start"), F.asc("user_id")).limit(k)


def _recent(funnel: DataFrame, interval: str, as_of) -> DataFrame:
    return funnel.where(lookback("window_start", interval, as_of))


def mean_conversion_rate(funnel: DataFrame, interval: str = "1 hour", as_of=None) -> DataFrame:
    """K28."""
    return _recent(funnel, interval, as_of).agg(F.avg("conversion_rate").alias("avg_conversion_rate"))


def conversion_rate_per_window(funnel: DataFrame, interval: str = "24 hours", as_of=None) -> DataFrame:
    """K29."""
    return (_recent(funnel, interval, as_of).groupBy(F.col("window_start").alias("time"))
            .agg(F.avg("conversion_rate").alias("conversion_rate")).orderBy("time"))


def views_orders_per_window(funnel: DataFrame, interval: str = "24 hours", as_of=None) -> DataFrame:
    """K30."""
    return (_recent(funnel, interval, as_of).groupBy(F.col("window_start").alias("time"))
            .agg(F.sum("view_count").alias("views"), F.sum("order_count").alias("orders"))
            .orderBy("time"))


def top_converting_users(funnel: DataFrame, interval: str = "24 hours", k: int = 20,
                         as_of=None) -> DataFrame:
    """Mean of window rates, ordered by that output alias."""
    g = (_recent(funnel, interval, as_of).groupBy("user_id").agg(
            F.sum("view_count").alias("total_views"),
            F.sum("order_count").alias("total_orders"),
            F.avg("conversion_rate").alias("conversion_rate")))
    return (g.where(F.col("total_views") > 0)
             .orderBy(F.desc("conversion_rate"), F.asc("user_id")).limit(k))


def converted_split(funnel: DataFrame, interval: str = "24 hours", as_of=None) -> DataFrame:
    """K32 (U2): one scan, two labelled rows; 'Not Converted' may be negative."""
    t = _recent(funnel, interval, as_of).agg(
        F.sum("order_count").alias("c"),
        F.sum(F.col("view_count") - F.col("order_count")).alias("n"))
    return t.select(F.explode(F.array(
        F.struct(F.lit("Converted").alias("status"), F.col("c").alias("count")),
        F.struct(F.lit("Not Converted").alias("status"), F.col("n").alias("count")))).alias("r")
    ).select("r.status", "r.count")


def funnel_total(funnel: DataFrame, column: str, alias: str, interval: str = "24 hours",
                 as_of=None) -> DataFrame:
    """K33 (views) / K34 (orders)."""
    return _recent(funnel, interval, as_of).agg(F.sum(column).alias(alias))


def conversion_matrix(funnel: DataFrame, interval: str = "24 hours", as_of=None) -> DataFrame:
    """Long-form (time, user, rate) for windows with views."""
    return (_recent(funnel, interval, as_of).where(F.col("view_count") > 0)
            .select(F.col("window_start").alias("time"), "user_id", "conversion_rate")
            .orderBy("time", "user_id"))


# ---- over raw orders ------------------------------------------------------------

def revenue_by_currency_total(orders: DataFrame) -> DataFrame:
    """Q12 (map + reduceByKey in the reference): revenue per currency."""
    return (orders.groupBy("currency").agg(F.sum("price").alias("revenue"))
                  .orderBy(F.desc("revenue"), F.asc("currency")))


def recent_orders(orders: DataFrame, k: int = 10) -> DataFrame:
    """Q19 (L8)."""
    return (orders.select("order_id", "user_id", "product_id", "price", "currency", "timestamp")
                  .orderBy(F.desc("timestamp"), F.asc("order_id")).limit(k))


def distinct_values(orders: DataFrame, column: str = "currency") -> DataFrame:
    """Q23 (A17)."""
    return orders.select(column).distinct()


def orders_of(orders: DataFrame, column: str = "currency", value: str = "USD") -> DataFrame:
    """Q23 (F1): the rows of one currency."""
    return orders.where(F.col(column) == F.lit(value))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Q22 (U3): one row per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def tile(orders: DataFrame, alias: str, expr, where=None) -> DataFrame:
    """A single aggregate value."""
    df = orders.where(where) if where is not None else orders
    return df.agg(expr.alias(alias))


def total_orders(orders):
    return tile(orders, "total_orders", F.count(F.lit(1)))


def total_revenue(orders, currency="USD"):
    return tile(orders, "total_revenue", F.sum("price"), F.col("currency") == currency)


def avg_order_value(orders, currency=None):
    w = F.col("currency") == currency if currency else None
    return tile(orders, "avg_order_value", F.avg("price"), w)


def unique_users(orders):
    return tile(orders, "unique_users", F.count_distinct("user_id"))


def products_sold(orders):
    return tile(orders, "total_products", F.count_distinct("product_id"))


def orders_per_user(orders):
    return orders.agg(safe_ratio(F.count(F.lit(1)), F.count_distinct("user_id")).alias("orders_per_user"))


def revenue_per_user(orders):
    return orders.agg(safe_ratio(F.sum("price"), F.count_distinct("user_id")).alias("revenue_per_user"))


def product_counts(orders: DataFrame, k: int = 10) -> DataFrame:
    """K09 (k=1), K12 input: orders per product, top k."""
    return (orders.groupBy("product_id").agg(F.count(F.lit(1)).alias("value"))
                  .orderBy(F.desc("value"), F.asc("product_id")).limit(k))


def product_stats(orders: DataFrame) -> DataFrame:
    """Per product: orders, revenue, mean price, distinct buyers.

    Distinct buyers in two stages (product, user) then product, so a hot
    product is spread over reducers before its final combine.
    """
    per = orders.groupBy("product_id", "user_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("price").alias("_s"), F.count("price").alias("_np"))
    return per.groupBy("product_id").agg(
        F.sum("_n").alias("order_count"),
        F.sum("_s").alias("total_revenue"),
        F.try_divide(F.sum("_s"), F.sum("_np")).alias("avg_price"),
        F.count(F.when(F.col("user_id").isNotNull(), 1)).alias("unique_buyers"))


def top_products(orders: DataFrame, k: int = 20) -> DataFrame:
    """By orders, with distinct buyers."""
    return product_stats(orders).orderBy(F.desc("order_count"), F.asc("product_id")).limit(k)


def top_products_by_revenue(orders: DataFrame, k: int = 20) -> DataFrame:
    """K19."""
    g = orders.groupBy("product_id").agg(F.count(F.lit(1)).alias("order_count"),
                                         F.sum("price").alias("total_revenue"),
                                         F.avg("price").alias("avg_price"))
    return g.orderBy(F.desc("total_revenue"), F.asc("product_id")).limit(k)


def currency_summary(orders: DataFrame) -> DataFrame:
    """Count, sum, mean, min, max per currency."""
    return (orders.groupBy("currency").agg(
                F.count(F.lit(1)).alias("orders"),
                F.sum("price").alias("revenue"),
                F.avg("price").alias("avg_order_value"),
                F.min("price").alias("min_price"),
                F.max("price").alias("max_price"))
            .orderBy(F.desc("revenue"), F.asc("currency")))


def orders_by_currency(orders: DataFrame) -> DataFrame:
    """K17."""
    return (orders.groupBy("currency").agg(F.count(F.lit(1)).alias("value"))
                  .orderBy(F.desc("value"), F.asc("currency")))


def per_minute(orders: DataFrame, value, alias: str = "value", interval: str | None = "1 hour",
               inclusive: bool = True, as_of=None, by: str | None = None,
               metric: str | None = None, by_alias: str | None = None) -> DataFrame:
    """DATE_TRUNC('minute') series over a lookback."""
    keys = [F.date_trunc("minute", "timestamp").alias("time")]
    if by:
        keys.append(F.col(by).alias(by_alias or by))
    src = orders if interval is None else orders.where(
        lookback("timestamp", interval, as_of, inclusive))
    g = src.groupBy(*keys).agg(value.alias(alias))
    cols = ["time"] + ([by_alias or by] if by else [])
    if metric:
        g = g.select("time", F.lit(metric).alias("metric"), alias)
    return g.orderBy(*cols)


def count_since(orders: DataFrame, interval: str = "1 minute", as_of=None,
                alias: str = "orders_last_minute") -> DataFrame:
    """K42."""
    return (orders.where(lookback("timestamp", interval, as_of, inclusive=True))
                  .agg(F.count(F.lit(1)).alias(alias)))


def processing_rate(orders: DataFrame, interval: str = "5 minutes", as_of=None) -> DataFrame:
    """Rows / (max - min seconds) inside the lookback; null for a zero span."""
    from basketry.functions.exprs import seconds_between
    return (orders.where(lookback("timestamp", interval, as_of, inclusive=True))
                  .agg(safe_ratio(F.count(F.lit(1)),
                                  seconds_between(F.max("timestamp"), F.min("timestamp")))
                       .alias("avg_rate")))


def dedupe_orders(orders: DataFrame, key: str = "order_id") -> DataFrame:
    """ST13 batch form: one row per order id, the earliest event (ties broken
    by the remaining columns) -- deterministic, unlike ``dropDuplicates``.
    ``min_by`` aggregates partially, so a hot id is combined map-side."""
    rest = [c for c in orders.columns if c != key]
    order = F.struct(*[F.col(c) for c in (["timestamp"] + [c for c in rest if c != "timestamp"])
                       if c in orders.columns])
    g = orders.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_r"))
    return g.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])
