"""Windowed tables in batch form: Q02, Q03 (+ J1), Q04 (B2), Q05."""

from __future__ import annotations

from basketry import config
from basketry.operators import baskets, windows
from basketry.plans.registry import register
from basketry.plans.sqlviews import (
    bucket,
    funnel_table,
    revenue_table,
    sessions_table,
    with_,
)
from basketry.sources import fixtures as fx


def _revenue_sql(width: str) -> str:
    return with_("orders_raw", revenue_table("rev", width=width)) + """
SELECT window_start, window_end, currency, ROUND(total_revenue, 6) AS total_revenue,
       order_count, ROUND(avg_order_value, 6) AS avg_order_value
FROM rev"""


def _funnel_sql(width: str) -> str:
    return with_("orders_raw", "product_views", funnel_table("fun", width=width)) + """
SELECT window_start, window_end, user_id, view_count, order_count,
       ROUND(conversion_rate, 6) AS conversion_rate
FROM fun"""


def _sessions_sql(width: str) -> str:
    return with_("orders_raw", "product_views", sessions_table("ses", width=width)) + \
        "SELECT * FROM ses"


for _width, _tag in (("5 minutes", "5min"), ("1 day", "1day")):
    def _rev(spark, sf, w=_width):
        return windows.revenue_by_currency(fx.orders_raw(spark, sf), w)

    def _fun(spark, sf, w=_width):
        return windows.conversion_funnel_from_events(fx.funnel_events(spark, sf), w)

    def _fun_join(spark, sf, w=_width):
        return windows.conversion_funnel_join(fx.product_views(spark, sf), fx.orders_raw(spark, sf), w)

    def _ses(spark, sf, w=_width):
        return windows.user_sessions_from_events(fx.funnel_events(spark, sf), w)

    register(f"q02_revenue_by_currency_{_tag}", _revenue_sql(_width))(_rev)
    register(f"q03_conversion_funnel_{_tag}", _funnel_sql(_width))(_fun)
    register(f"j1_conversion_funnel_full_outer_{_tag}", _funnel_sql(_width))(_fun_join)
    register(f"q05_user_sessions_{_tag}", _sessions_sql(_width))(_ses)

# the line-order table spans years: daily revenue per region currency
register("q02_revenue_by_currency_1day_line", with_("line_orders", revenue_table(
    "rev", src="line_orders", width="1 day")) + """
SELECT window_start, window_end, currency, ROUND(total_revenue, 6) AS total_revenue,
       order_count, ROUND(avg_order_value, 6) AS avg_order_value FROM rev""")(
    lambda spark, sf: windows.revenue_by_currency(fx.line_orders(spark, sf), "1 day"))


def _baskets_sql(src: str = "orders_raw") -> str:
    b = bucket('"timestamp"', "30 minutes")
    return with_(src) + f""", b AS (
  SELECT DISTINCT window_start, user_id, product_id FROM (
    SELECT {b} AS window_start, user_id, product_id FROM {src}
    UNION ALL
    SELECT {b} - INTERVAL '30 minutes', user_id, product_id FROM {src}) x
  WHERE product_id IS NOT NULL AND window_start IS NOT NULL)
SELECT a.product_id, b2.product_id AS recommended_product_id,
       CAST(COUNT(*) AS DOUBLE) AS score, COUNT(*) AS co_purchase_count,
       {config.AS_OF_SQL} AS last_updated
FROM b a JOIN b b2 ON a.window_start = b2.window_start AND a.user_id = b2.user_id
                  AND a.product_id < b2.product_id
GROUP BY 1, 2"""


@register("q04_product_recommendations", _baskets_sql())
def q04(spark, sf):
    """B2: co-purchases per (1 h window sliding 30 min, user), all pairs."""
    return baskets.recommendations(fx.orders_raw(spark, sf), updated_at=config.AS_OF)


@register("q04_product_recommendations_salted", _baskets_sql())
def q04_salted(spark, sf):
    """B2 with every basket forced through the skew (salted) path."""
    return baskets.recommendations(fx.orders_raw(spark, sf), updated_at=config.AS_OF,
                                   block_items=2)
