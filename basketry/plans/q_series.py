"""Rates and latest values of ``events`` (W3, K45-K47, K49), series reducers
(B8) and bands (X22)."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.operators import kpis, quality, series
from basketry.plans.q_batch import revenue5
from basketry.plans.registry import register
from basketry.plans.sqlviews import revenue_table, with_
from basketry.sources import fixtures as fx

_TOPIC = ("CASE event_type WHEN 'purchase' THEN 'orders' WHEN 'view' THEN 'product-view' "
          "WHEN 'signup' THEN 'user-events' WHEN 'click' THEN 'user-events' "
          "WHEN 'error' THEN 'user-events' END")


def _rate_sql(key: str, label: str, value: str = "COUNT(*)") -> str:
    return f"""SELECT date_trunc('minute', ts) AS time, {key} AS {label}, {value} / CAST(60.0 AS DOUBLE) AS rate
FROM events GROUP BY 1, 2"""


def _rounded(sql: str, label: str) -> str:
    return f"SELECT time, {label}, ROUND(rate, 6) AS rate FROM ({sql}) z"


def _events(s, d):
    return fx.table(s, d, "events")


register("k45_messages_in_rate_by_topic", _rounded(_rate_sql(_TOPIC, "topic"), "topic"))(
    lambda s, d: series.event_rate(_events(s, d)))
register("k46_bytes_in_rate_by_topic", _rounded(_rate_sql(_TOPIC, "topic", "SUM(strlen(props))"), "topic"))(
    lambda s, d: series.event_rate(_events(s, d), size="props"))
register("k49_request_rate_by_type", f"""SELECT time, event_type, ROUND(rate, 6) AS rate,
       CASE WHEN rate >= 10.0 THEN 'critical' WHEN rate >= 5.0 THEN 'warning' ELSE 'ok' END AS status
FROM ({_rate_sql('event_type', 'event_type')}) z""")(
    lambda s, d: quality.banded(series.event_rate(_events(s, d), "event_type"), "rate", quality.RATE_BANDS))
register("k47_latest_value_by_event_type", """SELECT event_type, ROUND(value, 6) AS value, ts,
       CASE WHEN value >= 500.0 THEN 'critical' WHEN value >= 100.0 THEN 'warning' ELSE 'ok' END AS status
FROM (SELECT event_type, arg_max(value, (ts, event_id)) AS value, MAX(ts) AS ts
      FROM events WHERE value IS NOT NULL GROUP BY event_type) z""")(
    lambda s, d: quality.banded(series.latest_value(_events(s, d)), "value", quality.LATENCY_BANDS))

register("b8_revenue_series_reducers", with_("orders_raw", revenue_table("revenue")) + """
, ser AS (SELECT window_start AS time, currency AS metric, total_revenue AS value FROM revenue)
SELECT metric, ROUND(arg_max(value, time), 6) AS last,
       ROUND(arg_max(value, time) FILTER (WHERE value IS NOT NULL), 6) AS last_not_null,
       ROUND(AVG(value), 6) AS mean, ROUND(MAX(value), 6) AS max, ROUND(MIN(value), 6) AS min,
       ROUND(SUM(value), 6) AS total, ROUND(STDDEV_SAMP(value), 6) AS std_dev
FROM ser GROUP BY metric""")(
    lambda s, d: series.reducers(kpis.window_series(revenue5(s, d), "total_revenue", None,
                                                    label="metric")))

register("b8_orders_per_minute_reducers", with_("orders_raw") + """
, ser AS (SELECT date_trunc('minute', "timestamp") AS time, 'orders_processed' AS metric,
                 COUNT(*) AS value FROM orders_raw GROUP BY 1)
SELECT metric, arg_max(value, time) AS last,
       arg_max(value, time) FILTER (WHERE value IS NOT NULL) AS last_not_null,
       ROUND(AVG(value), 6) AS mean, MAX(value) AS max, MIN(value) AS min,
       CAST(SUM(value) AS BIGINT) AS total, ROUND(STDDEV_SAMP(value), 6) AS std_dev
FROM ser GROUP BY metric""")(
    lambda s, d: series.reducers(kpis.per_minute(fx.orders_raw(s, d), F.count(F.lit(1)), "value",
                                                 None, metric="orders_processed")))

# ---- W2: counter rate with resets over the real values -------------------------------

register("w2_value_counter_rate_by_type", """WITH d AS (
  SELECT ts, event_type, value, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS before
  FROM events WHERE value IS NOT NULL)
SELECT date_trunc('minute', ts) AS time, event_type,
       ROUND(SUM(CASE WHEN value < before THEN value ELSE value - before END) / 60.0, 6) AS rate
FROM d WHERE before IS NOT NULL GROUP BY 1, 2""")(
    lambda s, d: series.segment_rate(_events(s, d), "event_type", tie="event_id"))
