"""Views over the driver's parquet tables (SRC5, FIXTURES.md section 2).

All views are lazy projections of ``spark.read.parquet``: Catalyst prunes the
columns each query needs and pushes its filters into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import config
from basketry.functions.exprs import pick, prefixed_id


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _event_time(c: str = "ts"):
    # events.ts is TIMESTAMP_NTZ; watermarks need TIMESTAMP (T25).  The
    # session zone is UTC, so the wall clock is kept.
    return F.col(c).cast("timestamp")


def _product(props: str = "props"):
    return F.concat(F.lit("p"), F.get_json_object(F.col(props), "$.k"))


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event orders: purchases of ``events`` in the ``orders_raw`` shape."""
    ev = table(spark, sf_dir, "events")
    return ev.where(F.col("event_type") == "purchase").select(
        prefixed_id("o", "event_id").alias("order_id"),
        prefixed_id("u", "user_id").alias("user_id"),
        _product().alias("product_id"),
        F.col("value").alias("price"),
        pick(config.CURRENCIES, "event_id").alias("currency"),
        _event_time().alias("timestamp"),
    )


def product_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.where(F.col("event_type") == "view").select(
        prefixed_id("u", "user_id").alias("user_id"),
        _product().alias("product_id"),
        pick(config.CATEGORIES, "event_id").alias("category"),
        _event_time().alias("timestamp"),
    )


_USER_EVENT_MAP = {"signup": "SIGNUP", "click": "LOGIN", "error": "LOGOUT"}


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    kind = None
    for src, dst in _USER_EVENT_MAP.items():
        cond = F.col("event_type") == src
        kind = F.when(cond, F.lit(dst)) if kind is None else kind.when(cond, F.lit(dst))
    return ev.where(F.col("event_type").isin(*_USER_EVENT_MAP)).select(
        kind.alias("event_type"),
        prefixed_id("u", "user_id").alias("user_id"),
        pick(config.COUNTRIES, "event_id").alias("country"),
        pick(config.DEVICES, "event_id").alias("device"),
        _event_time().alias("timestamp"),
    )


def line_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders x customer x nation x region in the orders_raw shape.

    Join order: the dimension chain customer-nation-region is resolved first
    (nation/region are tiny; Spark broadcasts them only when their measured
    size is under ``spark.sql.autoBroadcastJoinThreshold``), then orders pick
    up the region by customer, and lineitem joins last on the order key.  The
    two large joins are shuffle joins on their keys; AQE splits skewed keys.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    re = table(spark, sf_dir, "region").select("r_regionkey")
    cust_region = (cu.join(na, cu.c_nationkey == na.n_nationkey)
                     .join(re, na.n_regionkey == re.r_regionkey)
                     .select("c_custkey", "r_regionkey"))
    order_region = (od.join(cust_region, od.o_custkey == cust_region.c_custkey)
                      .select("o_orderkey", "o_custkey", "r_regionkey"))
    j = li.join(order_region, li.l_orderkey == order_region.o_orderkey)
    return j.select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("order_id"),
        prefixed_id("u", "o_custkey").alias("user_id"),
        prefixed_id("p", "l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("price"),
        pick(config.CURRENCIES, "r_regionkey").alias("currency"),
        _event_time("l_shipdate").alias("timestamp"),
    )


def _line_cols(*more):
    return [F.concat(F.lit("o"), F.col("l_orderkey").cast("string"), F.lit("-"),
                     F.col("l_linenumber").cast("string")).alias("order_id"), *more,
            prefixed_id("p", "l_partkey").alias("product_id"),
            F.col("l_extendedprice").alias("price"),
            _event_time("l_shipdate").alias("timestamp")]


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_orders`` without user and currency: lineitem alone.  The view's
    joins are foreign-key lookups, so the rows are the same."""
    return table(spark, sf_dir, "lineitem").select(*_line_cols())


def line_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``line_orders`` without currency: lineitem and orders."""
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(*_line_cols(prefixed_id("u", "o_custkey").alias("user_id")))


def funnel_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views and purchases as one (user_id, timestamp, event_type) frame from a
    single scan of ``events``; the same rows as ``windows.funnel_events(
    product_views, orders_raw)``, without reading the table twice."""
    ev = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "view", F.lit("view")).otherwise(F.lit("order"))
    return ev.where(F.col("event_type").isin("view", "purchase")).select(
        prefixed_id("u", "user_id").alias("user_id"),
        _event_time().alias("timestamp"),
        kind.alias("event_type"),
    )


VIEWS = {
    "orders_raw": orders_raw,
    "product_views": product_views,
    "user_events": user_events,
    "line_orders": line_orders,
}


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """SRC6: expose the fixture views to ``spark.sql``."""
    for name, fn in VIEWS.items():
        fn(spark, sf_dir).createOrReplaceTempView(name)
