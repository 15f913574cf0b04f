"""Q06-Q09, Q17, Q18, Q20, Q21, K24-K35 and K43 over stored window tables.

The streaming jobs Q02 and Q03 have written their tables over the first three
quarters of the feed's time; each query reads the closed windows from there and
rebuilds only the windows after the freshness cut from the raw rows
(``streaming.stored``).  Same questions, same SQL as over rebuilt windows.
"""

from __future__ import annotations

from basketry import schemas
from basketry.plans import q_batch, q_kpis  # noqa: F401  (they register the questions)
from basketry.plans.q_batch import WINDOW_TABLES
from basketry.plans.registry import REGISTRY, register
from basketry.streaming import pipelines as pl
from basketry.streaming.replay import replay
from basketry.streaming.stored import windows_upto_now
from basketry.streaming.versions import Table

PIECES, STORED = 4, 3
TABLE = {"revenue": "revenue_by_currency_5min", "funnel": "conversion_funnel_5min"}
NOW = pl.Trigger(processing_time=None, available_now=True)

QUESTIONS = ["q06_top_currencies", "q06_weighted_order_value", "q07_user_conversion_top20_5min",
             "q08_overall_conversion_5min", "q09_revenue_by_time_window_top20",
             *(n for n in REGISTRY if n.startswith(("q17_", "q18_", "q20_", "q21_")) and "1day" not in n),
             "k24_revenue_window_series_30d", "k25_order_count_window_series_30d", "k26_aov_window_series_30d",
             "k27_latest_revenue_windows_top20", "k27_latest_revenue_windows_top50_30d", "k43_active_windows_30d",
             *(n for n in REGISTRY if n[:3] in {f"k{i}" for i in range(28, 36)} and n.endswith("_5min"))]

#: (application, tables) -> folder of the tables built there.
_built: dict[tuple[str, str], str] = {}


def stored_root(spark, sf: str) -> str:
    """The folder of both tables; the jobs run once per application and input."""
    key = (spark.sparkContext.applicationId, sf.rstrip("/"))
    if key not in _built:
        def start(st, root):
            return [pl.start_revenue(st["orders"], f"{root}/tables/{TABLE['revenue']}", f"{root}/checkpoints", NOW),
                    pl.start_funnel(st["views"], st["orders"], f"{root}/tables/{TABLE['funnel']}", f"{root}/checkpoints", NOW)]
        _built[key] = replay(spark, sf, start, "stored", PIECES, order=list(range(STORED)))
    return _built[key]


def read_windows(kind, spark, sf, raw, compute):
    name = TABLE[kind]
    table = Table(f"{stored_root(spark, sf)}/tables/{name}", "latest", schemas.TABLES[name][1])
    return windows_upto_now(spark, table, raw, compute, "5 minutes")


def _over_stored(fn):
    def run(spark, sf):
        token = WINDOW_TABLES.set(read_windows)
        try:
            return fn(spark, sf)
        finally:
            WINDOW_TABLES.reset(token)
    return run


for _name in QUESTIONS:
    _e = REGISTRY[_name]
    register(f"{_name}_stored", _e.sql)(_over_stored(_e.fn))
