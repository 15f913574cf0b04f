"""Batch SQL and RDD jobs of the reference: Q06-Q23 (and B1, B3-B7)."""

from __future__ import annotations

from contextvars import ContextVar

from basketry.functions.exprs import lookback
from basketry.operators import baskets, kpis, segments, stats, windows
from basketry.plans.registry import register
from basketry.plans.sqlviews import funnel_table, revenue_table, with_
from basketry.sources import fixtures as fx


def _since(df, interval):
    """Rows that a window starting within the lookback can hold.  A window holds
    no row before its start, so this bound on the rows reaches the Parquet scan
    while the window filter itself stays with the reader of the table."""
    return df if interval is None else df.where(lookback("timestamp", interval, inclusive=True))


#: Where the 5-minute tables come from: rebuilt from raw rows, unless
#: ``q_stored`` reads what the streaming sinks have stored.
WINDOW_TABLES = ContextVar("WINDOW_TABLES", default=None)


def _windows(kind, raw, compute, spark, sf, width):
    stored = WINDOW_TABLES.get()
    return compute(raw) if stored is None or width != "5 minutes" else stored(kind, spark, sf, raw, compute)


def revenue5(spark, sf, since=None):
    return _windows("revenue", _since(fx.orders_raw(spark, sf), since),
                    lambda o: windows.revenue_by_currency(o, "5 minutes"), spark, sf, "5 minutes")


def funnel(spark, sf, width="5 minutes", since=None):
    return _windows("funnel", _since(fx.funnel_events(spark, sf), since),
                    lambda e: windows.conversion_funnel_from_events(e, width), spark, sf, width)


REV = with_("orders_raw", revenue_table("revenue"))


def FUN(width="5 minutes"):
    return with_("orders_raw", "product_views", funnel_table("conversion", width=width))


# ---- Q06-Q09 over the windowed tables -------------------------------------------

register("q06_top_currencies", REV + """
SELECT currency, ROUND(SUM(total_revenue), 6) AS total_revenue,
       CAST(SUM(order_count) AS BIGINT) AS total_orders,
       ROUND(AVG(avg_order_value), 6) AS avg_order_value
FROM revenue GROUP BY currency""")(lambda s, d: kpis.top_currencies(revenue5(s, d)))

register("q06_weighted_order_value", REV + """
SELECT currency, ROUND(SUM(total_revenue) / NULLIF(SUM(order_count), 0), 6) AS weighted_avg_order_value
FROM revenue GROUP BY currency""")(lambda s, d: kpis.weighted_order_value(revenue5(s, d)))


def _q07_sql(width):
    return FUN(width) + """
SELECT user_id, CAST(SUM(view_count) AS BIGINT) AS total_views,
       CAST(SUM(order_count) AS BIGINT) AS total_orders,
       CASE WHEN SUM(view_count) > 0
            THEN CAST(ROUND(CAST(SUM(order_count) * 100.0 / SUM(view_count) AS DECIMAL(38, 9)), 2) AS DOUBLE)
            ELSE 0.0 END AS conversion_rate
FROM conversion WHERE view_count > 0
GROUP BY user_id ORDER BY total_orders DESC, user_id LIMIT 20"""


def _q08_sql(width):
    return FUN(width) + """
SELECT CAST(SUM(view_count) AS BIGINT) AS total_views, CAST(SUM(order_count) AS BIGINT) AS total_orders,
       CAST(ROUND(CAST(SUM(order_count) * 100.0 / SUM(view_count) AS DECIMAL(38, 9)), 2) AS DOUBLE)
         AS overall_conversion_rate
FROM conversion WHERE view_count > 0"""


for _w, _t in (("5 minutes", "5min"), ("1 day", "1day")):
    register(f"q07_user_conversion_top20_{_t}", _q07_sql(_w))(
        lambda s, d, w=_w: kpis.user_conversion(funnel(s, d, w), 20))
    register(f"q08_overall_conversion_{_t}", _q08_sql(_w))(
        lambda s, d, w=_w: kpis.overall_conversion(funnel(s, d, w)))

register("q09_revenue_by_time_window_top20", REV + """
SELECT window_start, window_end, ROUND(SUM(total_revenue), 6) AS total_revenue,
       CAST(SUM(order_count) AS BIGINT) AS total_orders
FROM revenue GROUP BY window_start, window_end ORDER BY window_start DESC LIMIT 20""")(
    lambda s, d: kpis.revenue_by_time(revenue5(s, d), 20))


# ---- Q10-Q16 over raw orders: event orders and line orders ------------------------

def _q10_sql(src):
    return with_(src) + f"""
SELECT user_id, COUNT(*) AS total_orders, ROUND(SUM(price), 6) AS total_spent,
       ROUND(AVG(price), 6) AS avg_order_value, MIN(price) AS min_order, MAX(price) AS max_order,
       CASE WHEN SUM(price) > 1000 THEN 'VIP' WHEN SUM(price) > 500 THEN 'Premium'
            WHEN SUM(price) > 100 THEN 'Regular' ELSE 'New' END AS segment
FROM {src} GROUP BY user_id ORDER BY SUM(price) DESC, user_id LIMIT 30"""


def _q11_sql(src, money=6):
    return with_(src) + f""", user_segments AS (
  SELECT user_id, SUM(price) AS total_spent, COUNT(*) AS order_count,
         CASE WHEN SUM(price) > 1000 THEN 'VIP' WHEN SUM(price) > 500 THEN 'Premium'
              WHEN SUM(price) > 100 THEN 'Regular' ELSE 'New' END AS segment
  FROM {src} GROUP BY user_id)
SELECT segment, COUNT(*) AS user_count, ROUND(SUM(total_spent), {money}) AS segment_revenue,
       ROUND(AVG(total_spent), 6) AS avg_user_value, CAST(SUM(order_count) AS BIGINT) AS total_orders
FROM user_segments GROUP BY segment"""


def _q12_sql(src, money=6):
    return with_(src) + f"""
SELECT currency, ROUND(SUM(price), {money}) AS revenue FROM {src} GROUP BY currency"""


def _q13_sql(src):
    return with_(src) + f"""
SELECT user_id, ROUND(SUM(price), 6) AS total_spent, COUNT(*) AS order_count,
       COUNT(DISTINCT product_id) AS unique_products
FROM {src} GROUP BY user_id HAVING SUM(price) > 1000
ORDER BY SUM(price) DESC, user_id LIMIT 10"""


def _q14_sql(src):
    # brute force over pairs of order lines, as the RDD job enumerates them
    return with_(src) + f""", lines AS (
  SELECT user_id, product_id, ROW_NUMBER() OVER () AS rid FROM {src} WHERE product_id IS NOT NULL)
SELECT LEAST(a.product_id, b.product_id) AS product1, GREATEST(a.product_id, b.product_id) AS product2,
       COUNT(*) AS co_occurrence_count
FROM lines a JOIN lines b ON a.user_id = b.user_id AND a.rid < b.rid
GROUP BY 1, 2 ORDER BY co_occurrence_count DESC, product1, product2 LIMIT 10"""


def _q15_sql(src):
    return with_(src) + f""", s AS (
  SELECT price, ROW_NUMBER() OVER (ORDER BY price) - 1 AS rn, COUNT(*) OVER () AS n
  FROM {src} WHERE price IS NOT NULL)
SELECT COUNT(*) AS "count", ROUND(AVG(price), 6) AS mean, MIN(price) AS "min", MAX(price) AS "max",
       ROUND(STDDEV_POP(price), 6) AS stddev,
       (SELECT price FROM s WHERE rn = n // 4) AS p25,
       (SELECT price FROM s WHERE rn = n // 2) AS p50,
       (SELECT price FROM s WHERE rn = (3 * n) // 4) AS p75
FROM {src}"""


def _q16_sql(src):
    return with_(src) + f"""
SELECT CAST(hour("timestamp") AS INTEGER) AS hour, COUNT(*) AS order_count
FROM {src} WHERE "timestamp" IS NOT NULL GROUP BY 1 ORDER BY 1"""


_SOURCES = {"": fx.orders_raw, "_line": fx.line_orders}
_USERS = {"": fx.orders_raw, "_line": fx.line_users}     # no currency asked
_PRICES = {"": fx.orders_raw, "_line": fx.line_items}    # neither user nor currency asked
_SRC_SQL = {"": "orders_raw", "_line": "line_orders"}

for _sfx, _load in _SOURCES.items():
    _src = _SRC_SQL[_sfx]
    _m = 2 if _sfx else 6   # line-order totals: compare at cents
    register(f"q10_user_segments_top30{_sfx}", _q10_sql(_src))(
        lambda s, d, L=_USERS[_sfx]: segments.user_segments(L(s, d), 30))
    register(f"q11_segment_summary{_sfx}", _q11_sql(_src, _m),
             cents=("segment_revenue",) if _sfx else ())(
        lambda s, d, L=_USERS[_sfx]: segments.segment_summary(L(s, d)))
    register(f"q12_revenue_by_currency{_sfx}", _q12_sql(_src, _m),
             cents=("revenue",) if _sfx else ())(
        lambda s, d, L=_load: kpis.revenue_by_currency_total(L(s, d)))
    register(f"q13_vip_users_top10{_sfx}", _q13_sql(_src))(
        lambda s, d, L=_USERS[_sfx]: segments.vip_users(L(s, d)))
    register(f"q14_product_cooccurrence_top10{_sfx}", _q14_sql(_src))(
        lambda s, d, L=_USERS[_sfx]: baskets.top_basket_pairs(L(s, d), 10))
    register(f"q15_price_distribution{_sfx}", _q15_sql(_src))(
        lambda s, d, L=_PRICES[_sfx]: stats.price_distribution(L(s, d)))
    register(f"q16_orders_by_hour{_sfx}", _q16_sql(_src))(
        lambda s, d, L=_PRICES[_sfx]: stats.orders_by_hour(L(s, d)))

register("q14_product_cooccurrence_top10_salted", _q14_sql("orders_raw"))(
    lambda s, d: baskets.top_pairs(baskets.basket_pairs(fx.orders_raw(s, d), block_items=4), 10))


# ---- Q17-Q23 ---------------------------------------------------------------------

def _q17_sql(width):
    return FUN(width) + """
SELECT user_id, CAST(SUM(view_count) AS BIGINT) AS views, CAST(SUM(order_count) AS BIGINT) AS orders,
       CAST(ROUND(CAST(SUM(order_count) * 100.0 / NULLIF(SUM(view_count), 0) AS DECIMAL(38, 9)), 2) AS DOUBLE)
         AS conversion_rate
FROM conversion GROUP BY user_id HAVING SUM(view_count) > 0
ORDER BY orders DESC, user_id LIMIT 10"""


def _q18_sql(width):
    return FUN(width) + """
SELECT user_id, CAST(SUM(view_count) AS BIGINT) AS total_views, CAST(SUM(order_count) AS BIGINT) AS total_orders
FROM conversion GROUP BY user_id ORDER BY total_orders DESC, user_id LIMIT 10"""


for _w, _t in (("5 minutes", "5min"), ("1 day", "1day")):
    register(f"q17_user_conversion_having_top10_{_t}", _q17_sql(_w))(
        lambda s, d, w=_w: kpis.user_conversion_having(funnel(s, d, w), 10))
    register(f"q18_funnel_top_users_top10_{_t}", _q18_sql(_w))(
        lambda s, d, w=_w: kpis.funnel_top_users(funnel(s, d, w), 10))

register("q19_recent_orders", with_("orders_raw") + """
SELECT order_id, user_id, product_id, price, currency, "timestamp"
FROM orders_raw ORDER BY "timestamp" DESC, order_id LIMIT 10""")(
    lambda s, d: kpis.recent_orders(fx.orders_raw(s, d), 10))

register("q20_recent_revenue_windows", REV + """
SELECT window_start, window_end, currency,
       CAST(ROUND(CAST(total_revenue AS DECIMAL(38, 9)), 2) AS DOUBLE) AS total_revenue, order_count,
       CAST(ROUND(CAST(avg_order_value AS DECIMAL(38, 9)), 2) AS DOUBLE) AS avg_order_value
FROM revenue ORDER BY window_start DESC, currency LIMIT 10""")(
    lambda s, d: kpis.recent_revenue_windows(revenue5(s, d), 10))

register("q21_recent_funnel_windows", FUN() + """
SELECT window_start, window_end, user_id, view_count, order_count, ROUND(conversion_rate, 6) AS conversion_rate
FROM conversion ORDER BY window_start DESC, user_id LIMIT 10""")(
    lambda s, d: kpis.recent_funnel_windows(funnel(s, d), 10))

register("q22_table_row_counts", with_("orders_raw", "product_views", revenue_table(),
                                       funnel_table()) + """
SELECT 'orders_raw' AS table_name, COUNT(*) AS row_count FROM orders_raw
UNION ALL SELECT 'revenue_by_currency_5min', COUNT(*) FROM revenue_by_currency_5min
UNION ALL SELECT 'conversion_funnel_5min', COUNT(*) FROM conversion_funnel_5min""")(
    lambda s, d: kpis.row_counts({"orders_raw": fx.orders_raw(s, d),
                                  "revenue_by_currency_5min": revenue5(s, d),
                                  "conversion_funnel_5min": funnel(s, d)}))

register("q23_distinct_currencies", with_("orders_raw") + """
SELECT DISTINCT currency FROM orders_raw""")(
    lambda s, d: kpis.distinct_values(fx.orders_raw(s, d), "currency"))

register("q23_orders_of_currency_usd", with_("orders_raw") + """
SELECT * FROM orders_raw WHERE currency = 'USD'""")(
    lambda s, d: kpis.orders_of(fx.orders_raw(s, d), "currency", "USD"))


# ---- Q01 batch form and the decode operators (P1-P6, SNK8, ST13, T23) -------------

def _decoded_orders(s, d):
    from basketry.sources.events import decode_orders, encode_orders, split_valid
    return split_valid(decode_orders(encode_orders(fx.orders_raw(s, d))))[0]


register("q01_orders_decode_dedupe", with_("orders_raw") + "SELECT * FROM orders_raw")(
    lambda s, d: kpis.dedupe_orders(_decoded_orders(s, d)))

register("q01_orders_dedupe_line", with_("line_orders") + """
SELECT order_id, user_id, product_id, price, currency, "timestamp" FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id
                               ORDER BY "timestamp", user_id, product_id, price, currency) AS rn
  FROM line_orders) x WHERE rn = 1""")(lambda s, d: kpis.dedupe_orders(fx.line_orders(s, d)))


def _decoded_views(s, d):
    from basketry.sources.events import decode_views, encode_views, split_valid
    return split_valid(decode_views(encode_views(fx.product_views(s, d))))[0]


def _decoded_user_events(s, d):
    from basketry.sources.events import decode_user_events, encode_user_events, split_valid
    return split_valid(decode_user_events(encode_user_events(fx.user_events(s, d))))[0]


register("p2_product_views_decode", with_("product_views") + "SELECT * FROM product_views")(
    _decoded_views)
register("p2_user_events_decode", with_("user_events") + "SELECT * FROM user_events")(
    _decoded_user_events)
