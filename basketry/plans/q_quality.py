"""Data-quality panels K36-K41 (event orders, and line orders where the
check has something to find there: duplicate order ids)."""

from __future__ import annotations

from basketry import config
from basketry.operators import quality
from basketry.plans.registry import register
from basketry.plans.sqlviews import with_
from basketry.sources import fixtures as fx

NOW = config.AS_OF_SQL
O = with_("orders_raw")


def _band(col):
    return (f"CASE WHEN {col} IS NULL THEN NULL WHEN {col} >= 60.0 THEN 'critical' "
            f"WHEN {col} >= 10.0 THEN 'warning' ELSE 'ok' END")


_LAG = f"(epoch_us({NOW}) - epoch_us(MAX(\"timestamp\"))) / 1000000.0"

register("k36_data_freshness", O + f"""
SELECT ROUND(COALESCE({_LAG}, 999.0), 6) AS data_freshness_seconds,
       {_band(f'COALESCE({_LAG}, 999.0)')} AS status
FROM orders_raw""")(lambda s, d: quality.freshness(fx.orders_raw(s, d)))

register("k36_processing_lag", O + f"""
SELECT ROUND({_LAG}, 6) AS processing_lag_seconds, {_band(_LAG)} AS status
FROM orders_raw""")(lambda s, d: quality.freshness(fx.orders_raw(s, d), empty_value=None,
                                                   alias="processing_lag_seconds"))

register("k37_null_timestamp_pct", O + """
SELECT ROUND(CAST(COUNT(*) FILTER (WHERE "timestamp" IS NULL) AS DOUBLE) / NULLIF(COUNT(*), 0) * 100, 6)
         AS null_timestamps_pct
FROM orders_raw""")(lambda s, d: quality.null_timestamp_pct(fx.orders_raw(s, d)))

for _sfx, _L, _src in (("", fx.orders_raw, "orders_raw"), ("_line", fx.line_orders, "line_orders")):
    register(f"k38_order_id_uniqueness_pct{_sfx}", with_(_src) + f"""
SELECT ROUND(CAST(COUNT(DISTINCT order_id) AS DOUBLE) / NULLIF(COUNT(*), 0) * 100, 6)
         AS order_id_uniqueness_pct
FROM {_src}""")(
        lambda s, d, L=fx.line_items if _sfx else fx.orders_raw: quality.order_id_uniqueness_pct(L(s, d)))
    register(f"k41_price_outliers_top20{_sfx}", with_(_src) + f"""
SELECT order_id, user_id, product_id, price, currency, "timestamp" FROM {_src}
WHERE price > (SELECT AVG(price) + 3 * STDDEV(price) FROM {_src})
   OR price < (SELECT AVG(price) - 3 * STDDEV(price) FROM {_src} WHERE price > 0)
ORDER BY "timestamp" DESC, order_id LIMIT 20""")(
        lambda s, d, L=_L, P=fx.line_items if _sfx else fx.orders_raw: quality.price_outliers(L(s, d), prices=P(s, d)))

# uniform line prices have no 3-sigma outliers: the same question at 1.5 sigma has rows
register("k41_price_outliers_top20_line_1_5sigma", with_("line_orders") + """
SELECT order_id, user_id, product_id, price, currency, "timestamp" FROM line_orders
WHERE price > (SELECT AVG(price) + 1.5 * STDDEV(price) FROM line_orders)
   OR price < (SELECT AVG(price) - 1.5 * STDDEV(price) FROM line_orders WHERE price > 0)
ORDER BY "timestamp" DESC, order_id LIMIT 20""")(
    lambda s, d: quality.price_outliers(fx.line_orders(s, d), 1.5, prices=fx.line_items(s, d)))

register("k41_price_outliers_all", O + """
SELECT order_id, user_id, product_id, price, currency, "timestamp" FROM orders_raw
WHERE price > (SELECT AVG(price) + 3 * STDDEV(price) FROM orders_raw)
   OR price < (SELECT AVG(price) - 3 * STDDEV(price) FROM orders_raw WHERE price > 0)""")(
    lambda s, d: quality.price_outliers(fx.orders_raw(s, d), k=None))

register("k39_min_price", O + """
SELECT COALESCE(MIN(price), 0.0) AS min_price FROM orders_raw""")(
    lambda s, d: quality.min_price(fx.orders_raw(s, d)))

for _iv, _t in (("1 hour", "1h"), ("30 days", "30d")):
    register(f"k40_quality_by_currency_{_t}", O + f"""
SELECT currency, COUNT(*) AS order_count, ROUND(AVG(price), 6) AS avg_price, MIN(price) AS min_price,
       MAX(price) AS max_price, ROUND(STDDEV(price), 6) AS price_stddev
FROM orders_raw WHERE "timestamp" >= {NOW} - INTERVAL '{_iv}' GROUP BY currency""")(
        lambda s, d, iv=_iv: quality.quality_by_currency(fx.orders_raw(s, d), iv))
