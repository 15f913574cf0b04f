"""Stored window tables plus tail, late rows repaired, job health, sketches."""

from __future__ import annotations

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators import windows
from basketry.plans import q_batch, q_stored
from basketry.session import run_dir
from basketry.sources import fixtures as fx
from basketry.sources.events import decode_orders, decode_views, read_json_lines, read_json_lines_stream, split_valid
from basketry.streaming import health, late, sinks, sketches, versions
from basketry.streaming import pipelines as pl
from basketry.streaming.replay import replay, state_partitions
from basketry.streaming.stored import freshness_cut, windows_upto_now

NOW = pl.Trigger(processing_time=None, available_now=True)
REVENUE = ["window_start", "currency"]


def _order(oid, h, m, price=1.0, cur="USD", user="u1"):
    t = (dt.datetime(2024, 1, 1, h, m) - dt.datetime(1970, 1, 1)).total_seconds()
    return json.dumps({"eventType": "ORDER", "orderId": oid, "userId": user, "productId": "p1",
                       "price": price, "currency": cur, "timestamp": t})


def _view(user, h, m):
    t = (dt.datetime(2024, 1, 1, h, m) - dt.datetime(1970, 1, 1)).total_seconds()
    return json.dumps({"eventType": "VIEW", "userId": user, "productId": "p9", "category": "toys", "timestamp": t})


def _feed(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def _stream(spark, path):
    return read_json_lines_stream(spark, path).select("value")


def _done(*queries):
    for q in queries:
        q.awaitTermination()
        assert q.exception() is None


def _rows(df):
    return sorted(map(tuple, df.collect()))


# ---- stored windows plus tail -----------------------------------------------------

def test_raw_rows_are_read_from_the_cut_on(spark, sf_small):
    root = q_stored.stored_root(spark, sf_small)
    table = versions.Table(f"{root}/tables/revenue_by_currency_5min", "latest", REVENUE)
    cut = freshness_cut(table.read(spark), "5 minutes")
    raw = fx.orders_raw(spark, sf_small)
    compute = lambda o: windows.revenue_by_currency(o, "5 minutes")
    both = windows_upto_now(spark, table, raw, compute, "5 minutes")
    lo, hi = raw.agg(F.min("timestamp"), F.max("timestamp")).first()
    assert lo + (hi - lo) / 2 < cut < hi and cut.minute % 5 == cut.second == 0
    plan = both._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "events.parquet" in x)
    assert f"GreaterThanOrEqual(ts,{cut:%Y-}" in scan, scan
    want = [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in _rows(compute(raw))]
    assert [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in _rows(both)] == want
    # a stale row of the stored part shows that it is read, and not rebuilt
    assert table.read(spark).where(F.col("window_end") <= F.lit(cut)).count() > 100


def test_without_a_stored_table_all_windows_are_rebuilt(spark, sf_small):
    table = versions.Table(run_dir(spark, "test-none"), "latest", REVENUE)
    raw = fx.orders_raw(spark, sf_small)
    compute = lambda o: windows.revenue_by_currency(o, "5 minutes")
    assert windows_upto_now(spark, table, raw, compute, "5 minutes").count() == compute(raw).count()
    assert q_batch.WINDOW_TABLES.get() is None


def test_what_state_tasks_report_grows_no_faster_than_the_feed(spark, sf_small):
    assert [state_partitions(n, 200) for n in (0, 10**6, 25 * 10**6, 10**8, 10**12)] == [16, 16, 50, 100, 200]
    assert state_partitions(10**6, 8) == 8
    s = spark.newSession()
    s.conf.set("spark.sql.shuffle.partitions", "200")
    s.conf.set("spark.sql.session.timeZone", "UTC")
    root = replay(s, sf_small, lambda st, root: [pl.start_revenue(st["orders"], f"{root}/t", f"{root}/ckpt", NOW)], "test-state", 2, ("orders",), order=[0])
    parts = [f for f in os.listdir(f"{root.removeprefix('file:')}/ckpt/revenue/state/0") if f.isdigit()]
    assert len(parts) == 16      # 200 tasks sent 200 partitions' metrics each


# ---- late rows ---------------------------------------------------------------------

BATCHES = [[_order("a", 10, 0), _order("b", 10, 30)],
           [_order("c", 11, 0)],
           [_order("d", 10, 1, 5.0), _order("e", 10, 2, 7.0, "EUR"), _order("f", 11, 1)],      # two too late
           [_order("g", 13, 0), _order("h", 10, 31)],                                         # one too late
           [_order("i", 13, 1), _order("j", 9, 0)]]                                           # a window never seen


def test_late_rows_are_kept_and_repaired(spark):
    root = run_dir(spark, "test-late")
    for i, lines in enumerate(BATCHES):
        _feed(spark, f"{root}/feed/piece={i}", lines)
        st = _stream(spark, f"{root}/feed")
        _done(*pl.start_orders_ingest(st, f"{root}/orders", f"{root}/ckpt", NOW),
              pl.start_revenue(st, f"{root}/revenue", f"{root}/ckpt", NOW),
              late.start_late_orders(st, f"{root}/late", f"{root}/ckpt", NOW))
        if i == 2:
            assert late.repair_revenue(spark, f"{root}/late", sinks.read_orders(spark, f"{root}/orders"), f"{root}/revenue")
    want = _rows(windows.revenue_by_currency(sinks.read_orders(spark, f"{root}/orders")))
    before = _rows(sinks.read_latest(spark, f"{root}/revenue", REVENUE))
    assert before != want                        # the stream has dropped rows since the first repair
    kept = {r.order_id for r in sinks.read_appended(spark, f"{root}/late").collect()}
    assert {"d", "e", "h", "j"} <= kept <= {"a", "d", "e", "h", "j"}
    late.repair_revenue(spark, f"{root}/late", sinks.read_orders(spark, f"{root}/orders"), f"{root}/revenue")
    assert _rows(sinks.read_latest(spark, f"{root}/revenue", REVENUE)) == want
    n = versions.version(spark, f"{root}/revenue").number
    assert late.repair_revenue(spark, f"{root}/late", sinks.read_orders(spark, f"{root}/orders"), f"{root}/revenue") is None
    assert versions.version(spark, f"{root}/revenue").number == n


def test_a_repair_reads_the_touched_windows_only(spark):
    root = run_dir(spark, "test-late-scan")
    rows = spark.range(0, 5000).select(F.concat(F.lit("o"), "id").alias("order_id"), F.lit("u").alias("user_id"), F.lit("p").alias("product_id"),
                                       F.lit(1.0).alias("price"), F.lit("USD").alias("currency"),
                                       (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(mins="id")).alias("timestamp"))
    rows.write.parquet(f"{root}/raw")
    t = versions.Table(f"{root}/late", "append")
    t.add(spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 5),), (dt.datetime(2024, 1, 2, 3, 25),)], "window_start timestamp"), 0, "x")
    seen = []

    def compute(o):
        seen.append(o._jdf.queryExecution().executedPlan().toString())
        return windows.revenue_by_currency(o)

    table = versions.Table(f"{root}/revenue", "latest", REVENUE)
    late.repair(spark, f"{root}/late", spark.read.parquet(f"{root}/raw"), compute, table, "5 minutes")
    got = _rows(table.read(spark).select("window_start", "order_count"))
    assert got == [(dt.datetime(2024, 1, 2, 3, 5), 5), (dt.datetime(2024, 1, 2, 3, 25), 5)]
    assert "GreaterThanOrEqual(timestamp,2024-01-02" in seen[0] and "LessThan(timestamp,2024-01-02" in seen[0]


def test_late_funnel_events_are_repaired(spark):
    root = run_dir(spark, "test-late-funnel")
    views = [[_view("u1", 10, 0)], [_view("u2", 12, 0)], [_view("u1", 10, 3)], []]
    orders = [[_order("a", 10, 1)], [_order("b", 12, 1)], [_order("c", 10, 2)], [_order("d", 12, 2)]]
    for i, (v, o) in enumerate(zip(views, orders, strict=True)):
        _feed(spark, f"{root}/orders/piece={i}", o)
        _feed(spark, f"{root}/views/piece={i}", v)
        vs, os_ = _stream(spark, f"{root}/views"), _stream(spark, f"{root}/orders")
        _done(pl.start_funnel(vs, os_, f"{root}/funnel", f"{root}/ckpt", NOW),
              late.start_late_events(vs, os_, f"{root}/late", f"{root}/ckpt", NOW))
    events = windows.funnel_events(split_valid(decode_views(read_json_lines(spark, f"{root}/views")))[0],
                                   split_valid(decode_orders(read_json_lines(spark, f"{root}/orders")))[0])
    want = _rows(windows.conversion_funnel_from_events(events))
    keys = schemas.TABLES["conversion_funnel_5min"][1]
    assert _rows(sinks.read_latest(spark, f"{root}/funnel", keys)) != want
    late.repair_funnel(spark, f"{root}/late", events, f"{root}/funnel")
    assert _rows(sinks.read_latest(spark, f"{root}/funnel", keys)) == want


def test_a_retried_late_batch_changes_nothing(spark):
    root = run_dir(spark, "test-late-retry")
    sink = late.LateSink(f"{root}/t", "5 minutes", "10 minutes")
    make = lambda *hm: spark.createDataFrame([(dt.datetime(2024, 1, 1, h, m),) for h, m in hm], "timestamp timestamp")
    sink(make((10, 0), (11, 0)), 0)
    sink(make((10, 0), (11, 0)), 0)
    sink(make((10, 50), (10, 44)), 1)
    sink(make((10, 50), (10, 44)), 1)
    assert sorted(r.timestamp.strftime("%H:%M") for r in sinks.read_appended(spark, f"{root}/t").collect()) == ["10:00", "10:44"]


# ---- job health ----------------------------------------------------------------------

def test_listener_fills_the_table_while_jobs_run(spark):
    root = run_dir(spark, "test-health")
    listener = health.HealthListener(spark, f"{root}/tables/job_health", every=2)
    spark.streams.addListener(listener)
    try:
        for i in range(2):
            _feed(spark, f"{root}/orders/p={i}", [_order(f"a{i}", 10 + i, 0), _order(f"b{i}", 10 + i, 1)])
            _feed(spark, f"{root}/views/p={i}", [_view("u1", 10 + i, 2)])
            pl.await_all(spark, pl.start_all(_stream(spark, f"{root}/orders"), _stream(spark, f"{root}/views"), root, NOW, names="jobs"))
        _feed(spark, f"{root}/orders/p=9", [_order("z", 12, 0)])

        def broken(df, batch):
            raise ValueError("broken sink")

        q = pl.start_revenue(_stream(spark, f"{root}/orders"), f"{root}/x", f"{root}/ckpt-broken", NOW, sink=broken, name="jobs-broken")
        with pytest.raises(Exception):
            q.awaitTermination()
        for _ in range(100):
            if listener.settled():
                break
            time.sleep(0.1)
        listener.flush()
    finally:
        spark.streams.removeListener(listener)
    got = {r.job: (r.input_rows, r.failures) for r in health.job_health(health.read_health(spark, f"{root}/tables/job_health")).collect()}
    assert got.pop("jobs-broken")[1] == 1
    assert got == {"jobs-orders": (4, 0), "jobs-revenue": (4, 0), "jobs-funnel": (6, 0), "jobs-recommendations": (4, 0), "jobs-sessions": (6, 0)}
    assert versions.version(spark, f"{root}/tables/job_health").runs[listener.run] >= 3


# ---- sketches ------------------------------------------------------------------------

def test_united_sketches_keep_the_stated_error(spark):
    rows = spark.range(0, 60_000).select(F.concat(F.lit("u"), (F.col("id") * 7919 % 25_000)).alias("user_id"), F.lit("USD").alias("currency"),
                                         (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(secs=F.col("id") % 7200)).alias("timestamp"))
    s = sketches.user_sketches(rows)
    assert s.count() == 24
    est = sketches.unique_users(s).first()[0]
    whole = rows.agg(F.hll_sketch_estimate(F.hll_sketch_agg("user_id", sketches.LG_K))).first()[0]
    assert abs(est - 25_000) / 25_000 <= sketches.ERROR and abs(est - whole) <= 0.002 * whole
    hours = sketches.unique_users(s, F.date_trunc("hour", F.col("window_start")).alias("hour")).collect()
    exact = dict(map(tuple, rows.groupBy(F.date_trunc("hour", "timestamp")).agg(F.count_distinct("user_id")).collect()))
    assert all(abs(r.unique_users - exact[r.hour]) / exact[r.hour] <= sketches.ERROR for r in hours) and len(hours) == 2
