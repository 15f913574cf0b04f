"""A question asked in Spark SQL over the registered views (SRC6).

The spend ladder of ``config.SEGMENTS`` becomes a SQL expression, so text and
DataFrame forms share one list of thresholds.
"""

from __future__ import annotations

from basketry import config
from basketry.plans.registry import register
from basketry.plans.sqlviews import with_
from basketry.sources import fixtures as fx


def ladder(total: str) -> str:
    """The spend segment of a total, from the configured thresholds."""
    steps = " ".join(f"WHEN {total} > {low} THEN '{label}'" for label, low in config.SEGMENTS)
    return f"CASE {steps} ELSE '{config.SEGMENT_DEFAULT}' END"


#: Users per spend segment and the share that viewed before their first purchase.
_BUYERS = """
buyers AS (SELECT user_id, SUM(price) AS spent, MIN({ts}) AS first_order, COUNT(DISTINCT currency) AS currencies
           FROM orders_raw GROUP BY user_id),
lookers AS (SELECT user_id, MIN({ts}) AS first_view FROM product_views GROUP BY user_id)
SELECT {ladder} AS segment, COUNT(*) AS users,
       SUM(CASE WHEN l.first_view < b.first_order THEN 1 ELSE 0 END) AS viewed_first,
       SUM(CASE WHEN l.user_id IS NULL THEN 1 ELSE 0 END) AS never_viewed,
       MAX(b.currencies) AS most_currencies
FROM buyers b LEFT JOIN lookers l ON l.user_id = b.user_id
GROUP BY {ladder}"""

_ORACLE = with_("orders_raw", "product_views") + "," + _BUYERS.format(ts='"timestamp"', ladder=ladder("b.spent")) \
    .replace("SUM(CASE", "CAST(SUM(CASE").replace("END) AS viewed", "END) AS BIGINT) AS viewed").replace("END) AS never", "END) AS BIGINT) AS never")


@register("sql_segments_viewing_first", _ORACLE)
def segments_viewing_first(spark, sf):
    fx.register_views(spark, sf)
    return spark.sql("WITH" + _BUYERS.format(ts="timestamp", ladder=ladder("b.spent")))
