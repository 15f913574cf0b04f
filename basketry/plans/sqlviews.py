"""DuckDB SQL for the fixture views and derived tables, used by the oracle.

The oracle is an independent formulation of every registered query in plain
SQL over the driver's tables; these CTE fragments define the same views the
Spark side builds in ``basketry.sources.fixtures``.
"""

from __future__ import annotations

from basketry import config


def _pick(values, idx: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"[{items}][({idx}) % {len(values)} + 1]"


ORDERS_RAW = f"""orders_raw AS (
  SELECT 'o' || CAST(event_id AS VARCHAR) AS order_id,
         'u' || CAST(user_id AS VARCHAR) AS user_id,
         'p' || json_extract_string(props, '$.k') AS product_id,
         value AS price,
         {_pick(config.CURRENCIES, 'event_id')} AS currency,
         ts AS "timestamp"
  FROM events WHERE event_type = 'purchase')"""

PRODUCT_VIEWS = f"""product_views AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS user_id,
         'p' || json_extract_string(props, '$.k') AS product_id,
         {_pick(config.CATEGORIES, 'event_id')} AS category,
         ts AS "timestamp"
  FROM events WHERE event_type = 'view')"""

USER_EVENTS = f"""user_events AS (
  SELECT CASE event_type WHEN 'signup' THEN 'SIGNUP' WHEN 'click' THEN 'LOGIN'
              ELSE 'LOGOUT' END AS event_type,
         'u' || CAST(user_id AS VARCHAR) AS user_id,
         {_pick(config.COUNTRIES, 'event_id')} AS country,
         {_pick(config.DEVICES, 'event_id')} AS device,
         ts AS "timestamp"
  FROM events WHERE event_type IN ('signup', 'click', 'error'))"""

LINE_ORDERS = f"""line_orders AS (
  SELECT 'o' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS order_id,
         'u' || CAST(o.o_custkey AS VARCHAR) AS user_id,
         'p' || CAST(l.l_partkey AS VARCHAR) AS product_id,
         l.l_extendedprice AS price,
         {_pick(config.CURRENCIES, 'r.r_regionkey')} AS currency,
         l.l_shipdate AS "timestamp"
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

VIEW_SQL = {
    "orders_raw": ORDERS_RAW,
    "product_views": PRODUCT_VIEWS,
    "user_events": USER_EVENTS,
    "line_orders": LINE_ORDERS,
}


def bucket(ts: str, width: str) -> str:
    """Tumbling window start, aligned to the epoch like Spark's ``window``."""
    return f"time_bucket(INTERVAL '{width}', {ts}, TIMESTAMP '1970-01-01 00:00:00')"


def revenue_table(name: str = "revenue_by_currency_5min", src: str = "orders_raw",
                  width: str = "5 minutes") -> str:
    b = bucket('"timestamp"', width)
    return f"""{name} AS (
  SELECT {b} AS window_start,
         {b} + INTERVAL '{width}' AS window_end,
         currency,
         SUM(price) AS total_revenue,
         COUNT(*) AS order_count,
         AVG(price) AS avg_order_value
  FROM {src} GROUP BY 1, 2, 3)"""


def _funnel_events(views: str = "product_views", orders: str = "orders_raw") -> str:
    return (f"SELECT user_id, \"timestamp\", 'view' AS event_type FROM {views} "
            f"UNION ALL SELECT user_id, \"timestamp\", 'order' AS event_type FROM {orders}")


def funnel_table(name: str = "conversion_funnel_5min", width: str = "5 minutes") -> str:
    b = bucket('"timestamp"', width)
    return f"""{name} AS (
  SELECT window_start, window_end, user_id, view_count, order_count,
         CASE WHEN view_count > 0 THEN CAST(order_count AS DOUBLE) / view_count
              ELSE 0.0 END AS conversion_rate
  FROM (SELECT {b} AS window_start, {b} + INTERVAL '{width}' AS window_end, user_id,
               CAST(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS view_count,
               CAST(SUM(CASE WHEN event_type = 'order' THEN 1 ELSE 0 END) AS BIGINT) AS order_count
        FROM ({_funnel_events()}) e GROUP BY 1, 2, 3) g)"""


def sessions_table(name: str = "user_sessions_5min", width: str = "5 minutes") -> str:
    b = bucket('"timestamp"', width)
    return f"""{name} AS (
  SELECT {b} AS window_start, {b} + INTERVAL '{width}' AS window_end, user_id,
         CAST(epoch_us(MAX("timestamp")) // 1000000 - epoch_us(MIN("timestamp")) // 1000000 AS BIGINT)
           AS session_duration_seconds,
         CAST(COUNT(*) AS BIGINT) AS events_count,
         CAST(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS views_count,
         CAST(SUM(CASE WHEN event_type = 'order' THEN 1 ELSE 0 END) AS BIGINT) AS orders_count,
         SUM(CASE WHEN event_type = 'order' THEN 1 ELSE 0 END) > 0 AS has_conversion
  FROM ({_funnel_events()}) e GROUP BY 1, 2, 3)"""


def with_(*ctes: str) -> str:
    """WITH clause from view names (fixtures) or ready CTE fragments."""
    parts = [VIEW_SQL.get(c, c) for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n"
