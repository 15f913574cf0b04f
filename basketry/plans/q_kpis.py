"""KPI tiles and series (K01-K35, K42-K44), at the panels' lookbacks and,
where the fixture makes those nearly empty, also at 30 days (SURVEY 7.4.6).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry import config
from basketry.operators import kpis, segments, series
from basketry.plans.q_batch import funnel, revenue5
from basketry.plans.registry import register
from basketry.plans.sqlviews import funnel_table, revenue_table, with_
from basketry.sources import fixtures as fx

NOW = config.AS_OF_SQL
O = with_("orders_raw")
OL = with_("line_orders")


def _o(s, d):
    return fx.orders_raw(s, d)


# ---- K01-K08 tiles -----------------------------------------------------------------

register("k01_total_orders", O + "SELECT COUNT(*) AS total_orders FROM orders_raw")(
    lambda s, d: kpis.total_orders(_o(s, d)))
register("k02_total_revenue_usd", O + """
SELECT ROUND(SUM(price), 6) AS total_revenue FROM orders_raw WHERE currency = 'USD'""")(
    lambda s, d: kpis.total_revenue(_o(s, d), "USD"))
register("k03_avg_order_value_usd", O + """
SELECT ROUND(AVG(price), 6) AS avg_order_value FROM orders_raw WHERE currency = 'USD'""")(
    lambda s, d: kpis.avg_order_value(_o(s, d), "USD"))
register("k04_avg_order_value", O + """
SELECT ROUND(AVG(price), 6) AS avg_order_value FROM orders_raw""")(
    lambda s, d: kpis.avg_order_value(_o(s, d)))
register("k05_unique_users", O + """
SELECT COUNT(DISTINCT user_id) AS unique_users FROM orders_raw""")(
    lambda s, d: kpis.unique_users(_o(s, d)))
register("k06_products_sold", O + """
SELECT COUNT(DISTINCT product_id) AS total_products FROM orders_raw""")(
    lambda s, d: kpis.products_sold(_o(s, d)))
register("k07_orders_per_user", O + """
SELECT ROUND(CAST(COUNT(*) AS DOUBLE) / NULLIF(COUNT(DISTINCT user_id), 0), 6) AS orders_per_user
FROM orders_raw""")(lambda s, d: kpis.orders_per_user(_o(s, d)))
register("k08_revenue_per_user", O + """
SELECT ROUND(SUM(price) / NULLIF(COUNT(DISTINCT user_id), 0), 6) AS revenue_per_user
FROM orders_raw""")(lambda s, d: kpis.revenue_per_user(_o(s, d)))

# ---- K09-K19 rankings and summaries -------------------------------------------------

register("k09_top_product", O + """
SELECT product_id, COUNT(*) AS value FROM orders_raw GROUP BY product_id
ORDER BY value DESC, product_id LIMIT 1""")(lambda s, d: kpis.product_counts(_o(s, d), 1))

for _sfx, _L, _src in (("", fx.orders_raw, "orders_raw"), ("_line", fx.line_users, "line_orders")):
    register(f"k10_top_products_top20{_sfx}", with_(_src) + f"""
SELECT product_id, COUNT(*) AS order_count, ROUND(SUM(price), 6) AS total_revenue,
       ROUND(AVG(price), 6) AS avg_price, COUNT(DISTINCT user_id) AS unique_buyers
FROM {_src} GROUP BY product_id ORDER BY order_count DESC, product_id LIMIT 20""")(
        lambda s, d, L=_L: kpis.top_products(L(s, d), 20))
    register(f"k11_top_users_top20{_sfx}", with_(_src) + f"""
SELECT user_id, COUNT(*) AS order_count, ROUND(SUM(price), 6) AS total_spent,
       ROUND(AVG(price), 6) AS avg_order_value, COUNT(DISTINCT product_id) AS unique_products
FROM {_src} GROUP BY user_id ORDER BY SUM(price) DESC, user_id LIMIT 20""")(
        lambda s, d, L=_L: segments.top_users_by_revenue(L(s, d), 20))
    register(f"k13_order_count_buckets{_sfx}", with_(_src) + f"""
SELECT COUNT(*) AS order_count, order_count_bucket FROM (
  SELECT user_id, COUNT(*) AS user_orders,
         CASE WHEN COUNT(*) = 1 THEN '1 order' WHEN COUNT(*) BETWEEN 2 AND 5 THEN '2-5 orders'
              WHEN COUNT(*) BETWEEN 6 AND 10 THEN '6-10 orders' ELSE '10+ orders' END AS order_count_bucket
  FROM {_src} GROUP BY user_id) user_segments
GROUP BY order_count_bucket""")(lambda s, d, L=_L: segments.order_count_buckets(L(s, d)))

register("k12_top_products_share", O + """
, top AS (SELECT product_id, COUNT(*) AS value FROM orders_raw GROUP BY product_id
          ORDER BY value DESC, product_id LIMIT 10)
SELECT product_id, value, ROUND(CAST(value AS DOUBLE) / SUM(value) OVER (), 6) AS share FROM top""")(
    lambda s, d: series.share_of_total(kpis.product_counts(_o(s, d), 10), "value"))

register("k15_revenue_summary_by_currency", O + """
SELECT currency, COUNT(*) AS orders, ROUND(SUM(price), 6) AS revenue, ROUND(AVG(price), 6) AS avg_order_value,
       MIN(price) AS min_price, MAX(price) AS max_price FROM orders_raw GROUP BY currency""")(
    lambda s, d: kpis.currency_summary(_o(s, d)))

register("k15_revenue_summary_by_currency_line", OL + """
SELECT currency, COUNT(*) AS orders, ROUND(SUM(price), 2) AS revenue, ROUND(AVG(price), 6) AS avg_order_value,
       MIN(price) AS min_price, MAX(price) AS max_price FROM line_orders GROUP BY currency""",
         cents=("revenue",))(lambda s, d: kpis.currency_summary(fx.line_orders(s, d)))

register("k16_revenue_share_by_currency", O + """
SELECT currency, ROUND(SUM(price), 6) AS revenue,
       ROUND(SUM(price) / SUM(SUM(price)) OVER (), 6) AS share
FROM orders_raw GROUP BY currency""")(
    lambda s, d: series.share_of_total(kpis.revenue_by_currency_total(_o(s, d)), "revenue"))

register("k17_orders_by_currency", O + """
SELECT currency, COUNT(*) AS value FROM orders_raw GROUP BY currency""")(
    lambda s, d: kpis.orders_by_currency(_o(s, d)))

register("k18_top_customers_top20", O + """
SELECT user_id, COUNT(*) AS total_orders, ROUND(SUM(price), 6) AS total_spent,
       ROUND(AVG(price), 6) AS avg_order_value
FROM orders_raw GROUP BY user_id ORDER BY SUM(price) DESC, user_id LIMIT 20""")(
    lambda s, d: segments.top_users_by_revenue(_o(s, d), 20, with_products=False))

register("k19_top_products_by_revenue_top20", O + """
SELECT product_id, COUNT(*) AS order_count, ROUND(SUM(price), 6) AS total_revenue,
       ROUND(AVG(price), 6) AS avg_price
FROM orders_raw GROUP BY product_id ORDER BY SUM(price) DESC, product_id LIMIT 20""")(
    lambda s, d: kpis.top_products_by_revenue(_o(s, d), 20))


# ---- K14, K20-K23 per-minute series over raw orders ------------------------------

def _minute_sql(value_sql, alias, interval, op, by=None, metric=None, by_alias=None):
    by_sel = f", {by} AS {by_alias or by}" if by else ""
    by_grp = ", 2" if by else ""
    met = f", '{metric}' AS metric" if metric else ""
    return O + f"""
SELECT date_trunc('minute', "timestamp") AS time{by_sel}{met}, {value_sql} AS {alias}
FROM orders_raw WHERE "timestamp" {op} {NOW} - INTERVAL '{interval}'
GROUP BY 1{by_grp}"""


for _iv, _t in (("1 hour", "1h"), ("30 days", "30d")):
    register(f"k14_active_users_per_minute_{_t}",
             _minute_sql("COUNT(DISTINCT user_id)", "value", _iv, ">=", metric="active_users"))(
        lambda s, d, iv=_iv: kpis.per_minute(_o(s, d), F.count_distinct("user_id"), "value", iv,
                                             True, metric="active_users"))
    register(f"k20_orders_per_minute_{_t}",
             _minute_sql("COUNT(*)", "orders_per_minute", _iv, ">"))(
        lambda s, d, iv=_iv: kpis.per_minute(_o(s, d), F.count(F.lit(1)), "orders_per_minute", iv,
                                             False))
    register(f"k20_orders_processed_per_minute_{_t}",
             _minute_sql("COUNT(*)", "value", _iv, ">=", metric="orders_processed"))(
        lambda s, d, iv=_iv: kpis.per_minute(_o(s, d), F.count(F.lit(1)), "value", iv, True,
                                             metric="orders_processed"))
    register(f"k21_revenue_per_minute_by_currency_{_t}",
             _minute_sql("ROUND(SUM(price), 6)", "value", _iv, ">", by="currency"))(
        lambda s, d, iv=_iv: kpis.per_minute(_o(s, d), F.sum("price"), "value", iv, False,
                                             by="currency"))
    register(f"k22_orders_per_minute_by_currency_{_t}",
             _minute_sql("COUNT(*)", "value", _iv, ">=", by="currency", by_alias="metric"))(
        lambda s, d, iv=_iv: kpis.per_minute(_o(s, d), F.count(F.lit(1)), "value", iv, True,
                                             by="currency", by_alias="metric"))
    register(f"k23_avg_price_per_minute_{_t}",
             _minute_sql("ROUND(AVG(price), 6)", "value", _iv, ">=", metric="avg_price"))(
        lambda s, d, iv=_iv: kpis.per_minute(_o(s, d), F.avg("price"), "value", iv, True,
                                             metric="avg_price"))


# ---- K24-K27, K43 over the windowed revenue table ----------------------------------

REV = with_("orders_raw", revenue_table("revenue"))


def _series_sql(col, interval, op, label="currency"):
    return REV + f"""
SELECT window_start AS time, currency AS {label}, {col} AS value FROM revenue
WHERE window_start {op} {NOW} - INTERVAL '{interval}'"""


for _iv, _op, _lab, _t in (("2 hours", ">", "currency", "2h"), ("1 hour", ">=", "metric", "1h"),
                           ("30 days", ">", "currency", "30d")):
    inc = _op == ">="
    register(f"k24_revenue_window_series_{_t}", _series_sql("ROUND(total_revenue, 6)", _iv, _op, _lab))(
        lambda s, d, iv=_iv, i=inc, lb=_lab: kpis.window_series(revenue5(s, d, iv), "total_revenue", iv,
                                                                inclusive=i, label=lb))
    register(f"k25_order_count_window_series_{_t}", _series_sql("order_count", _iv, _op, _lab))(
        lambda s, d, iv=_iv, i=inc, lb=_lab: kpis.window_series(revenue5(s, d, iv), "order_count", iv,
                                                                inclusive=i, label=lb))
    register(f"k26_aov_window_series_{_t}", _series_sql("ROUND(avg_order_value, 6)", _iv, _op, _lab))(
        lambda s, d, iv=_iv, i=inc, lb=_lab: kpis.window_series(revenue5(s, d, iv), "avg_order_value", iv,
                                                                inclusive=i, label=lb))

register("k27_latest_revenue_windows_top20", REV + """
SELECT window_start, window_end, currency, ROUND(total_revenue, 6) AS total_revenue, order_count,
       ROUND(avg_order_value, 6) AS avg_order_value
FROM revenue ORDER BY window_start DESC, total_revenue DESC, currency LIMIT 20""")(
    lambda s, d: kpis.latest_revenue_windows(revenue5(s, d), 20))

for _iv, _t in (("1 hour", "1h"), ("30 days", "30d")):
    register(f"k27_latest_revenue_windows_top50_{_t}", REV + f"""
SELECT window_start, window_end, currency, ROUND(total_revenue, 6) AS total_revenue, order_count,
       ROUND(avg_order_value, 6) AS avg_order_value
FROM revenue WHERE window_start >= {NOW} - INTERVAL '{_iv}'
ORDER BY window_start DESC, total_revenue DESC, currency LIMIT 50""")(
        lambda s, d, iv=_iv: kpis.latest_revenue_windows(revenue5(s, d, iv), 50, iv))

for _iv, _t in (("30 minutes", "30m"), ("30 days", "30d")):
    register(f"k43_active_windows_{_t}", REV + f"""
SELECT COUNT(*) AS active_windows FROM revenue WHERE window_start >= {NOW} - INTERVAL '{_iv}'""")(
        lambda s, d, iv=_iv: kpis.active_windows(revenue5(s, d, iv), iv))


# ---- K28-K35 over the funnel table ---------------------------------------------------

def _fun(width):
    return with_("orders_raw", "product_views", funnel_table("conversion", width=width))


def _where(iv):
    return f"WHERE window_start > {NOW} - INTERVAL '{iv}'"


for _w, _iv, _t in (("5 minutes", None, "5min"), ("1 day", "30 days", "1day_30d")):
    iv28 = _iv or "1 hour"
    iv24 = _iv or "24 hours"
    F_ = _fun(_w)
    register(f"k28_mean_conversion_rate_{_t}", F_ + f"""
SELECT ROUND(AVG(conversion_rate), 6) AS avg_conversion_rate FROM conversion {_where(iv28)}""")(
        lambda s, d, w=_w, iv=iv28: kpis.mean_conversion_rate(funnel(s, d, w, iv), iv))
    register(f"k29_conversion_rate_per_window_{_t}", F_ + f"""
SELECT window_start AS time, ROUND(AVG(conversion_rate), 6) AS conversion_rate FROM conversion
{_where(iv24)} GROUP BY window_start""")(
        lambda s, d, w=_w, iv=iv24: kpis.conversion_rate_per_window(funnel(s, d, w, iv), iv))
    register(f"k30_views_orders_per_window_{_t}", F_ + f"""
SELECT window_start AS time, CAST(SUM(view_count) AS BIGINT) AS views,
       CAST(SUM(order_count) AS BIGINT) AS orders
FROM conversion {_where(iv24)} GROUP BY window_start""")(
        lambda s, d, w=_w, iv=iv24: kpis.views_orders_per_window(funnel(s, d, w, iv), iv))
    register(f"k31_top_converting_users_top20_{_t}", F_ + f"""
SELECT user_id, CAST(SUM(view_count) AS BIGINT) AS total_views, CAST(SUM(order_count) AS BIGINT) AS total_orders,
       ROUND(AVG(conversion_rate), 6) AS conversion_rate
FROM conversion {_where(iv24)} GROUP BY user_id HAVING SUM(view_count) > 0
ORDER BY AVG(conversion_rate) DESC, user_id LIMIT 20""")(
        lambda s, d, w=_w, iv=iv24: kpis.top_converting_users(funnel(s, d, w, iv), iv, 20))
    register(f"k32_converted_split_{_t}", F_ + f"""
SELECT 'Converted' AS status, CAST(SUM(order_count) AS BIGINT) AS count FROM conversion {_where(iv24)}
UNION ALL
SELECT 'Not Converted' AS status, CAST(SUM(view_count - order_count) AS BIGINT) AS count
FROM conversion {_where(iv24)}""")(
        lambda s, d, w=_w, iv=iv24: kpis.converted_split(funnel(s, d, w, iv), iv))
    register(f"k33_total_views_{_t}", F_ + f"""
SELECT CAST(SUM(view_count) AS BIGINT) AS total_views FROM conversion {_where(iv24)}""")(
        lambda s, d, w=_w, iv=iv24: kpis.funnel_total(funnel(s, d, w, iv), "view_count", "total_views", iv))
    register(f"k34_total_conversions_{_t}", F_ + f"""
SELECT CAST(SUM(order_count) AS BIGINT) AS total_conversions FROM conversion {_where(iv24)}""")(
        lambda s, d, w=_w, iv=iv24: kpis.funnel_total(funnel(s, d, w, iv), "order_count",
                                                      "total_conversions", iv))
    register(f"k35_conversion_matrix_{_t}", F_ + f"""
SELECT window_start AS time, user_id, ROUND(conversion_rate, 6) AS conversion_rate FROM conversion
{_where(iv24)} AND view_count > 0""")(
        lambda s, d, w=_w, iv=iv24: kpis.conversion_matrix(funnel(s, d, w, iv), iv))


# ---- K42, K44 ------------------------------------------------------------------------

for _iv, _t in (("1 minute", "1m"), ("24 hours", "24h")):
    register(f"k42_orders_since_{_t}", O + f"""
SELECT COUNT(*) AS orders_last_minute FROM orders_raw WHERE "timestamp" >= {NOW} - INTERVAL '{_iv}'""")(
        lambda s, d, iv=_iv: kpis.count_since(_o(s, d), iv))

for _iv, _t in (("5 minutes", "5m"), ("24 hours", "24h")):
    register(f"k44_avg_processing_rate_{_t}", O + f"""
SELECT ROUND(CAST(COUNT(*) AS DOUBLE) /
             NULLIF((epoch_us(MAX("timestamp")) - epoch_us(MIN("timestamp"))) / 1000000.0, 0), 6) AS avg_rate
FROM orders_raw WHERE "timestamp" >= {NOW} - INTERVAL '{_iv}'""")(
        lambda s, d, iv=_iv: kpis.processing_rate(_o(s, d), iv))

