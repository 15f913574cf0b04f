"""Per-user statistics, spend segments, order-count buckets.

Skew: a single user may own a large share of all orders.  Plain per-user
sums are safe (the partial aggregate collapses each map partition's rows of
that user to one row before the shuffle).  Distinct-product counts are done
in two explicit stages -- first on (user, product), which spreads a heavy
user over many reducers, then on user over the pre-combined rows -- instead
of a single-stage distinct aggregate keyed on the user alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.exprs import bucket_rank, order_bucket, segment


def user_spend(orders: DataFrame, user: str = "user_id") -> DataFrame:
    """A13/A14 without distinct: orders, spend, mean, min, max per user."""
    return orders.groupBy(user).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("price").alias("total_spent"),
        F.avg("price").alias("avg_order_value"),
        F.min("price").alias("min_order"),
        F.max("price").alias("max_order"),
    )


def user_stats(orders: DataFrame, user: str = "user_id", item: str = "product_id") -> DataFrame:
    """The reference's UserStats accumulator (spend, count, distinct
    products) as two skew-safe aggregation stages."""
    per_item = orders.groupBy(user, item).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("price").alias("_s"),
        F.count("price").alias("_np"),
        F.min("price").alias("_min"),
        F.max("price").alias("_max"),
    )
    return per_item.groupBy(user).agg(
        F.sum("_n").alias("total_orders"),
        F.sum("_s").alias("total_spent"),
        F.try_divide(F.sum("_s"), F.sum("_np")).alias("avg_order_value"),
        F.min("_min").alias("min_order"),
        F.max("_max").alias("max_order"),
        F.count(F.when(F.col(item).isNotNull(), 1)).alias("unique_products"),
    )


def user_segments(orders: DataFrame, k: int | None = 30, ladder=None) -> DataFrame:
    """Q10: per-user spend with the VIP/Premium/Regular/New ladder, top k."""
    s = user_spend(orders).withColumn("segment", segment("total_spent", ladder))
    if k is None:
        return s
    return s.orderBy(F.desc("total_spent"), F.asc("user_id")).limit(k)


def segment_summary(orders: DataFrame, ladder=None) -> DataFrame:
    """Users, revenue, mean user value and orders per segment."""
    users = orders.groupBy("user_id").agg(
        F.sum("price").alias("total_spent"),
        F.count(F.lit(1)).alias("order_count"),
    ).withColumn("segment", segment("total_spent", ladder))
    return (users.groupBy("segment").agg(
                F.count(F.lit(1)).alias("user_count"),
                F.sum("total_spent").alias("segment_revenue"),
                F.avg("total_spent").alias("avg_user_value"),
                F.sum("order_count").alias("total_orders"))
            .orderBy(F.desc("segment_revenue"), F.asc("segment")))


def order_count_buckets(orders: DataFrame) -> DataFrame:
    """Users per order-count bucket, in ladder order.

    ``order_count`` is the number of users in the bucket, as the panel names it.
    """
    per_user = orders.groupBy("user_id").agg(F.count(F.lit(1)).alias("user_orders"))
    b = per_user.select(order_bucket("user_orders").alias("order_count_bucket"))
    return (b.groupBy("order_count_bucket").agg(F.count(F.lit(1)).alias("order_count"))
             .orderBy(bucket_rank("order_count_bucket")))


def vip_users(orders: DataFrame, threshold: float = 1000.0, k: int = 10) -> DataFrame:
    """Users above ``threshold`` spend, top k, with distinct products.

    The reference looks each top user's stats up again (J3); here the stat
    columns ride along through the filter and the top-k.
    """
    s = user_stats(orders).where(F.col("total_spent") > F.lit(threshold))
    return (s.select("user_id", "total_spent", F.col("total_orders").alias("order_count"),
                     "unique_products")
             .orderBy(F.desc("total_spent"), F.asc("user_id")).limit(k))


def top_users_by_revenue(orders: DataFrame, k: int = 20, with_products: bool = True) -> DataFrame:
    """K11 (with distinct products) and K18 (without)."""
    if with_products:
        s = user_stats(orders).select(
            "user_id", F.col("total_orders").alias("order_count"), "total_spent",
            "avg_order_value", "unique_products")
    else:
        s = user_spend(orders).select("user_id", "total_orders", "total_spent", "avg_order_value")
    return s.orderBy(F.desc("total_spent"), F.asc("user_id")).limit(k)
