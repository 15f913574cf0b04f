"""Streaming semantics: late data (T26), dedupe (T6, ST13), idempotent and
upsert sinks (SNK1, SNK2), restart from checkpoint (ST11)."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from basketry.session import run_dir
from basketry.operators import baskets
from basketry.streaming import pipelines as pl
from basketry.streaming import sinks, versions
from basketry.streaming.replay import replayed_orders
from basketry.streaming.health import progress_frame
from basketry.sources.events import read_json_lines_stream

NOW = pl.Trigger(processing_time=None, available_now=True)


def _epoch(h, m, s=0):
    return (dt.datetime(2024, 1, 1, h, m, s) - dt.datetime(1970, 1, 1)).total_seconds()


def _order(oid, h, m, price=1.0, cur="USD"):
    return json.dumps({"eventType": "ORDER", "orderId": oid, "userId": "u1", "productId": "p1",
                       "price": price, "currency": cur, "timestamp": _epoch(h, m)})


def _run_batches(spark, batches, start):
    """Publish each batch as a new file, then run the query until idle."""
    root = run_dir(spark, "test-stream")
    queries = []
    for i, lines in enumerate(batches):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
            .write.mode("overwrite").text(f"{root}/feed/piece={i:04d}")
        stream = read_json_lines_stream(spark, f"{root}/feed").select("value")
        for q in start(stream, root):
            q.awaitTermination()
            assert q.exception() is None
            queries.append(q)
    return root, queries


def test_late_rows_follow_previous_batch_watermark(spark):
    batches = [
        [_order("a", 10, 0), _order("b", 10, 30)],
        [_order("c", 10, 30)],
        [_order("d", 10, 10), _order("e", 10, 19), _order("f", 10, 22), _order("g", 10, 25)],
        [_order("h", 11, 0)],
    ]
    root, qs = _run_batches(spark, batches, lambda st, root: [pl.start_revenue(
        st, f"{root}/revenue", f"{root}/ckpt", NOW)])
    t = sinks.read_latest(spark, f"{root}/revenue", ["window_start", "currency"])
    got = {r.window_start.strftime("%H:%M"): r.order_count for r in t.collect()}
    assert got == {"10:00": 1, "10:30": 2, "10:20": 1, "10:25": 1, "11:00": 1}
    prog = progress_frame(spark, qs)
    assert prog.agg(F.sum("rows_dropped_by_watermark")).first()[0] == 2


def test_disorder_in_first_batch_drops_nothing(spark):
    batches = [[_order("a", 11, 0), _order("b", 10, 0), _order("c", 9, 0)]]
    root, _ = _run_batches(spark, batches, lambda st, root: [pl.start_revenue(
        st, f"{root}/revenue", f"{root}/ckpt", NOW)])
    t = sinks.read_latest(spark, f"{root}/revenue", ["window_start", "currency"])
    assert t.count() == 3


def test_duplicate_orders_within_and_across_batches(spark):
    batches = [[_order("o1", 10, 0), _order("o1", 10, 0), _order("o2", 10, 1)],
               [_order("o1", 10, 0), _order("o3", 10, 2)],
               ["{broken"]]
    root, _ = _run_batches(spark, batches, lambda st, root: pl.start_orders_ingest(
        st, f"{root}/orders", f"{root}/ckpt", NOW, quarantine_path=f"{root}/quarantine"))
    ids = sorted(r.order_id for r in sinks.read_orders(spark, f"{root}/orders").collect())
    assert ids == ["o1", "o2", "o3"]
    q = sinks.read_appended(spark, f"{root}/quarantine").collect()
    assert [r.json for r in q] == ["{broken"]


def test_append_sink_is_idempotent_per_batch(spark):
    root = run_dir(spark, "test-sink")
    sink = sinks.AppendSink(f"{root}/t", ["k"])
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    sink(df, 7)
    sink(df, 7)            # re-delivered batch after a failure
    sink(spark.createDataFrame([], "k string, v int"), 8)   # empty batch: skipped
    got = sorted(map(tuple, sinks.read_appended(spark, f"{root}/t").collect()))
    assert got == [("a", 1), ("b", 2)]


def test_upsert_keeps_latest_per_key(spark):
    root = run_dir(spark, "test-upsert")
    sink = sinks.UpsertSink(f"{root}/t", ["k"])
    sink(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), 0)
    sink(spark.createDataFrame([("a", 5)], "k string, v int"), 1)
    got = sorted(map(tuple, sinks.read_latest(spark, f"{root}/t", ["k"]).collect()))
    assert got == [("a", 5), ("b", 1)]


def test_sessions_append_only_closed_windows(spark):
    view = json.dumps({"eventType": "VIEW", "userId": "u1", "productId": "p1", "category": "toys",
                       "timestamp": _epoch(10, 1)})
    batches_o = [[_order("a", 10, 2)], [_order("b", 10, 30)]]
    root = run_dir(spark, "test-sessions")
    for i, lines in enumerate(batches_o):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
            .write.mode("overwrite").text(f"{root}/orders/piece={i:04d}")
        if i == 0:
            spark.createDataFrame([(view,)], "value string").coalesce(1) \
                .write.mode("overwrite").text(f"{root}/views/piece=0000")
        q = pl.start_sessions(read_json_lines_stream(spark, f"{root}/views").select("value"),
                              read_json_lines_stream(spark, f"{root}/orders").select("value"),
                              f"{root}/sessions", f"{root}/ckpt", NOW)
        q.awaitTermination()
    rows = sinks.read_appended(spark, f"{root}/sessions").collect()
    # only [10:00, 10:05) is closed by the watermark 10:20; 10:30 stays open
    assert [(r.window_start.strftime("%H:%M"), r.events_count, r.views_count, r.orders_count,
             r.session_duration_seconds, r.has_conversion) for r in rows] == \
        [("10:00", 2, 1, 1, 60, True)]


def test_complete_mode_replaces_table(spark):
    batches = [[_order("a", 10, 0), _order("b", 10, 1, cur="EUR")], [_order("c", 10, 2)]]
    root, _ = _run_batches(spark, batches, lambda st, root: [pl.start_revenue(
        st, f"{root}/revenue", f"{root}/ckpt", NOW, mode="complete")])
    got = {(r.currency, r.order_count) for r in sinks.read_replaced(spark, f"{root}/revenue").collect()}
    assert got == {("USD", 2), ("EUR", 1)}


def test_start_all_runs_every_job(spark):
    root = run_dir(spark, "test-all")
    view = json.dumps({"eventType": "VIEW", "userId": "u1", "productId": "p9", "category": "toys",
                       "timestamp": _epoch(10, 1)})
    orders = [_order("a", 10, 0), _order("b", 10, 3), _order("c", 11, 30)]
    spark.createDataFrame([(x,) for x in orders], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{root}/feed/orders")
    spark.createDataFrame([(view,)], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{root}/feed/views")
    qs = pl.start_all(read_json_lines_stream(spark, f"{root}/feed/orders").select("value"),
                      read_json_lines_stream(spark, f"{root}/feed/views").select("value"),
                      f"{root}/out", NOW)
    pl.await_all(spark, qs)
    assert len(qs) == 7 and all(q.exception() is None for q in qs)
    t = f"{root}/out/tables"
    assert sinks.read_orders(spark, f"{t}/orders_raw").count() == 3
    assert sinks.read_latest(spark, f"{t}/revenue_by_currency_5min",
                             ["window_start", "currency"]).count() == 2
    assert sinks.read_latest(spark, f"{t}/conversion_funnel_5min",
                             ["window_start", "user_id"]).count() == 2


def test_create_tables_from_schema_registry(spark):
    """The tables of all jobs by name: empty at first, then what the sinks wrote."""
    from basketry import schemas
    root = run_dir(spark, "test-ddl")
    names = [n for n in schemas.TABLES if n != "metric_samples"]
    for v in names:                                                # temp views shadow tables
        spark.catalog.dropTempView(v)
    sinks.create_tables(spark, root, names)
    sinks.create_tables(spark, root, ["revenue_by_currency_5min"])       # again
    for n in names:
        t = spark.table(n)
        assert t.schema.simpleString() == schemas.TABLES[n][0].simpleString() and t.count() == 0
    orders = [_order("a", 10, 0), _order("b", 10, 3), _order("b", 10, 2), _order("c", 11, 30)]
    spark.createDataFrame([(x,) for x in orders], "value string").coalesce(1).write.text(f"{root}/feed")
    raw = read_json_lines_stream(spark, f"{root}/feed").select("value")
    for q in [*pl.start_orders_ingest(raw, f"{root}/orders_raw", f"{root}/ckpt", NOW),
              pl.start_revenue(raw, f"{root}/revenue_by_currency_5min", f"{root}/ckpt", NOW),
              pl.start_recommendations(raw, f"{root}/product_recommendations", f"{root}/ckpt", NOW)]:
        q.awaitTermination()
        assert q.exception() is None
    sinks.refresh_tables(spark, root, names)
    assert sorted((r.order_id, r.timestamp.minute) for r in spark.table("orders_raw").collect()) == [("a", 0), ("b", 2), ("c", 30)]
    assert spark.sql("SELECT sum(order_count) FROM revenue_by_currency_5min").first()[0] == 4
    assert spark.table("product_recommendations").schema.simpleString() == schemas.PRODUCT_RECOMMENDATIONS.simpleString()
    sinks.drop_tables(spark, names)
    assert not spark.catalog.tableExists("orders_raw")


def test_crash_after_write_then_restart_has_no_duplicates(spark):
    """ST11/T6: the sink publishes batch 1, then the job dies before the batch is
    committed; the restart re-runs batch 1, which its run has published."""
    root = run_dir(spark, "test-crash")
    table, ckpt = f"{root}/orders", f"{root}/ckpt"
    crashed = {"done": False}

    class CrashOnce(sinks.AppendSink):
        def __call__(self, df, batch_id):
            super().__call__(df, batch_id)
            if batch_id == 1 and not crashed["done"]:
                crashed["done"] = True
                raise RuntimeError("simulated driver crash after the write")

    def start(stream, sink):
        valid, _ = pl.orders_stream(stream)
        w = (valid.writeStream.outputMode("append").foreachBatch(sink)
                  .option("checkpointLocation", ckpt).trigger(availableNow=True))
        return w.start()

    for i, lines in enumerate([[_order("o1", 10, 0), _order("o2", 10, 1)],
                               [_order("o3", 10, 2), _order("o4", 10, 3)]]):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
            .write.mode("overwrite").text(f"{root}/feed/piece={i:04d}")
        q = start(read_json_lines_stream(spark, f"{root}/feed").select("value"),
                  CrashOnce(table, ["order_id"]))
        try:
            q.awaitTermination()
        except Exception:
            pass
        if i == 1:
            assert q.exception() is not None          # the simulated crash happened
            q = start(read_json_lines_stream(spark, f"{root}/feed").select("value"),
                      CrashOnce(table, ["order_id"]))
            q.awaitTermination()
            assert q.exception() is None
    ids = sorted(r.order_id for r in sinks.read_appended(spark, table).collect())
    assert ids == ["o1", "o2", "o3", "o4"]


def test_folds_bound_the_folders_that_are_read(spark):
    root = run_dir(spark, "test-fold")
    sink = sinks.UpsertSink(f"{root}/t", ["k"], fan=2)
    want = {}
    for b, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2)], [("c", 3)], [("b", 4)], [("a", 9)]]):
        sink(spark.createDataFrame(rows, "k string, v int"), b)
        want |= dict(rows)
        t = sinks.read_latest(spark, f"{root}/t", ["k"])
        assert dict(map(tuple, t.collect())) == want and len(t.inputFiles()) <= 16
    v = versions.version(spark, f"{root}/t")
    assert [f.level for f in v.folders] == [2, 0] and v.folders[0].seq < v.folders[1].seq
    # a retry of a folded batch changes nothing
    sink(spark.createDataFrame([("c", 7)], "k string, v int"), 2)
    assert versions.version(spark, f"{root}/t").number == v.number
    # an older version is still there, as a whole
    old = sink.table.read(spark, number=1)
    assert dict(map(tuple, old.collect())) == {"a": 1, "b": 1}


def test_three_hundred_batches_of_deltas(spark):
    """Every level holds fewer than FAN folders; the sums are exact throughout."""
    root = run_dir(spark, "test-deltas")
    table = versions.DeltaTable(f"{root}/t", ["k"], ["n"], retain=0)
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long").coalesce(1).persist()
    most = 0
    for b in range(300):
        v = table.add(rows, b, "run")
        most = max(most, len(v.folders))
    assert most <= table.fan * 3 and sum(table.fan ** f.level for f in v.folders) == 300
    assert dict(map(tuple, table.read(spark).collect())) == {"a": 300, "b": 600}
    names = {f.name for f in v.folders}
    p, fs = versions._fs(spark, f"{root}/t/data")
    assert {f.getPath().getName() for f in fs.listStatus(p)} == names         # the rest has expired
    assert len(versions._numbers(spark, f"{root}/t")) <= 3


def test_a_fresh_checkpoint_over_an_old_table(spark):
    """Batch ids start again at 0; the new run's rows are the newer ones all the same."""
    root, _ = _run_batches(spark, [[_order(f"a{i}", 10, 0)] for i in range(3)], lambda st, root: [pl.start_revenue(
        st, f"{root}/revenue", f"{root}/ckpt", NOW)])
    q = pl.start_revenue(read_json_lines_stream(spark, f"{root}/feed").select("value"), f"{root}/revenue", f"{root}/ckpt2", NOW)
    q.awaitTermination()
    spark.createDataFrame([(_order("b", 10, 1, price=5.0),)], "value string").write.text(f"{root}/feed/piece=0009")
    q = pl.start_revenue(read_json_lines_stream(spark, f"{root}/feed").select("value"), f"{root}/revenue", f"{root}/ckpt2", NOW)
    q.awaitTermination()
    v = versions.version(spark, f"{root}/revenue")
    assert len(v.runs) == 2
    r = sinks.read_latest(spark, f"{root}/revenue", ["window_start", "currency"]).collect()
    assert [(x.order_count, x.total_revenue) for x in r] == [(4, 8.0)]
    add = versions.DeltaTable(f"{root}/sum", ["k"], ["n"], restart="replace")
    one = spark.createDataFrame([("a", 1)], "k string, n long")
    for run, batch in (("x", 0), ("x", 1), ("y", 0), ("y", 0)):
        add.add(one, batch, run)
    assert add.read(spark).first().n == 1


def test_writers_race_for_a_version(spark):
    root = run_dir(spark, "test-race")
    t = versions.Table(f"{root}/t", "append")
    one = spark.createDataFrame([("a",)], "k string")
    t.add(one, 0, "x")
    calls = []

    def make(v):
        if not calls:                       # another writer publishes in between
            calls.append(1)
            t.add(one, 0, "y")
        return v.next(notes=v.notes | {"m": 1})

    v = versions.change(spark, t.path, make)
    assert v.number == 3 and set(v.runs) == {"x", "y"} and t.read(spark).count() == 2


def test_expired_folders_are_deleted(spark):
    root = run_dir(spark, "test-expire")
    sink = sinks.ReplaceSink(f"{root}/t")
    for b in range(3):
        sink(spark.createDataFrame([(b,)], "v int"), b)
    p, fs = versions._fs(spark, f"{root}/t/data")
    assert len(fs.listStatus(p)) == 3 and sinks.read_replaced(spark, f"{root}/t").first().v == 2
    sink.table.expire(spark)                # a day has not passed
    assert len(fs.listStatus(p)) == 3
    sink.table.expire(spark, retain=0)
    assert len(fs.listStatus(p)) == 1 and sinks.read_replaced(spark, f"{root}/t").first().v == 2


def test_open_windows_are_flushed_and_closed_later(spark):
    """The flush counts open windows from the raw rows; a later run that closes
    them does not count them twice."""
    def order(oid, user, product, h, m):
        return json.dumps({"eventType": "ORDER", "orderId": oid, "userId": user, "productId": product,
                           "price": 1.0, "currency": "USD", "timestamp": _epoch(h, m)})
    pieces = [[order("1", "u", "p1", 9, 5), order("2", "u", "p2", 9, 10), order("3", "u", "p1", 11, 5)],
              [order("4", "u", "p3", 11, 20), order("5", "v", "p1", 11, 40)],
              [order("6", "w", "p1", 15, 0), order("7", "w", "p2", 15, 1)]]
    root = run_dir(spark, "test-flush")
    keys, sums = ["product_id", "recommended_product_id"], ["co_purchase_count"]
    for i, lines in enumerate(pieces):
        spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{root}/feeds/orders/piece={i}")
        q = pl.start_recommendations(read_json_lines_stream(spark, f"{root}/feeds/orders").select("value"), f"{root}/pairs", f"{root}/ckpt", NOW)
        q.awaitTermination()
        assert q.exception() is None
        for _ in range(2):                  # a second flush takes the first one's place
            pl.flush_recommendations(replayed_orders(spark, root), f"{root}/pairs")
            got = {(r.product_id, r.recommended_product_id): r.co_purchase_count for r in sinks.read_summed(spark, f"{root}/pairs", keys, sums).collect()}
            want = {(r.product_id, r.recommended_product_id): r.co_purchase_count for r in baskets.recommendations(replayed_orders(spark, root)).collect()}
            assert got == want


def test_crash_after_a_published_fold(spark):
    """A running update stream dies right after the fold of batch 2 is published;
    the restart retries that batch and ends with the exact table."""
    class Crash(sinks.UpsertSink):
        left = 1

        def __call__(self, df, batch_id):
            super().__call__(df, batch_id)
            if batch_id == 2 and Crash.left:
                Crash.left -= 1
                raise RuntimeError("simulated crash")

    root = run_dir(spark, "test-crash-compact")
    table = f"{root}/revenue"
    batches = [[_order("a", 10, 0)], [_order("b", 10, 1)], [_order("c", 10, 2)], [_order("d", 10, 3), _order("e", 10, 31)]]
    from basketry.operators import windows

    def start():
        valid, _ = pl.orders_stream(read_json_lines_stream(spark, f"{root}/feed").select("value"))
        agg = windows.revenue_by_currency(valid.withWatermark("timestamp", "10 minutes"), "5 minutes")
        return pl._start(agg, Crash(table, ["window_start", "currency"], fan=2), f"{root}/ckpt", "update", NOW)

    for i, lines in enumerate(batches):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/feed/piece={i:04d}")
        q = start()
        try:
            q.awaitTermination()
        except Exception:
            pass
        if q.exception() is not None:
            q = start()
            q.awaitTermination()
            assert q.exception() is None
    assert Crash.left == 0
    got = {r.window_start.strftime("%H:%M"): r.order_count for r in sinks.read_latest(spark, table, ["window_start", "currency"]).collect()}
    assert got == {"10:00": 4, "10:30": 1}


def test_late_orders_stay_in_the_raw_table(spark):
    batches = [[_order("a", 10, 0)], [_order("b", 13, 0)], [_order("late", 11, 0), _order("a", 10, 0)], [_order("c", 13, 5)]]
    root, _ = _run_batches(spark, batches, lambda st, root: pl.start_orders_ingest(
        st, f"{root}/orders", f"{root}/ckpt", NOW))
    assert sorted(r.order_id for r in sinks.read_orders(spark, f"{root}/orders").collect()) == ["a", "b", "c", "late"]


def test_malformed_views_are_kept(spark):
    root, _ = _run_batches(spark, [["{not json", json.dumps({"eventType": "VIEW"})]], lambda st, root: [
        pl.start_views_quarantine(st, f"{root}/bad", f"{root}/ckpt", NOW)])
    assert sinks.read_appended(spark, f"{root}/bad").count() == 2


def test_jobs_start_at_their_own_offsets():
    assert pl.OFFSETS["funnel", "orders"] == pl.OFFSETS["funnel", "views"] == "earliest"
    assert {v for (job, _), v in pl.OFFSETS.items() if job not in ("funnel", "quarantine")} == {"latest"}


def test_a_damaged_table_raises(spark):
    import pytest
    root = run_dir(spark, "test-damaged")
    sinks.AppendSink(f"{root}/t")(spark.createDataFrame([("x",)], "v string"), 0)
    versions._delete(spark, f"{root}/t/data/{versions.version(spark, f'{root}/t').folders[0].name}")
    with pytest.raises(Exception):
        sinks.read_appended(spark, f"{root}/t").collect()
    assert sinks.read_appended(spark, f"{root}/none") is None


# ---- raw orders: duplicates settled at ingest (ST13) ------------------------------

def _raw(spark, rows):
    return spark.createDataFrame([(o, u, "p", 1.0, "USD", dt.datetime(2024, 1, 1, h, m)) for o, u, h, m in rows],
                                 "order_id string, user_id string, product_id string, price double, currency string, timestamp timestamp")


def test_the_earliest_copy_wins_in_a_batch_and_across_batches(spark):
    root = run_dir(spark, "test-earliest")
    sink = sinks.OrdersSink(f"{root}/t")
    sink(_raw(spark, [("o1", "a", 12, 0), ("o1", "b", 9, 0), ("o2", "a", 10, 0)]), 0)     # the later copy first
    sink(_raw(spark, [("o2", "z", 11, 0), ("o3", "a", 10, 0)]), 1)                        # a later copy: dropped
    sink(_raw(spark, [("o1", "c", 8, 0), ("o3", "a", 10, 0)]), 2)                         # an earlier copy: replaces
    got = sorted((r.order_id, r.user_id, r.timestamp.hour) for r in sinks.read_orders(spark, f"{root}/t").collect())
    assert got == [("o1", "c", 8), ("o2", "a", 10), ("o3", "a", 10)]
    plan = sinks.read_orders(spark, f"{root}/t")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan
    v = versions.version(spark, f"{root}/t")
    assert len(v.extra["dead"]) == 1 and [f.info["rows"] for f in v.folders] == [2, 1, 1]


def test_random_repeats_across_many_batches_and_folds(spark):
    import random
    rnd = random.Random(5)
    root = run_dir(spark, "test-repeats")
    sink = sinks.OrdersSink(f"{root}/t", fan=3, retain=0)
    everything = []
    for b in range(13):
        rows = [(f"o{rnd.randint(0, 120)}", f"u{rnd.randint(0, 9)}", rnd.randint(0, 23), rnd.randint(0, 59)) for _ in range(30)]
        everything += rows
        sink(_raw(spark, rows), b)
        if b % 4 == 0:
            sink(_raw(spark, rows[:9]), b)                                                 # retried
    from basketry.operators.kpis import dedupe_orders
    want = sorted(map(tuple, dedupe_orders(_raw(spark, everything)).collect()))
    assert sorted(map(tuple, sinks.read_orders(spark, f"{root}/t").collect())) == want
    v = versions.version(spark, f"{root}/t")
    assert len(v.folders) <= 6 and len(v.extra["filters"]) == len(v.folders)
    names = {f.name for f in v.folders} | {x for o in v.extra.values() for x in o}
    p, fs = versions._fs(spark, f"{root}/t/data")
    assert {f.getPath().getName() for f in fs.listStatus(p)} == names


def test_filters_find_every_id_and_few_others(spark):
    from basketry.streaming import ingest
    root = run_dir(spark, "test-filter")
    t = ingest.OrdersTable(f"{root}/t")
    t.ingest(_raw(spark, [(f"o{i}", "u", 1, 1) for i in range(3000)]), 0)
    t.ingest(_raw(spark, [(f"x{i}", "u", 1, 1) for i in range(50)]), 1)
    v = versions.version(spark, t.path)
    ask = spark.range(3000).selectExpr("concat('o', id) AS order_id")
    other = spark.range(20_000).selectExpr("concat('n', id) AS order_id")
    assert t.possible(spark, v, ask).where(F.col("folder") == v.folders[0].name).count() == 3000
    assert t.possible(spark, v, other).count() < 200
    assert v.folders[0].info["buckets"] == 2 and v.folders[1].info["buckets"] == 1
