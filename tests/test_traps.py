"""Hand-made frames, one per correctness trap (FIXTURES.md section 3)."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from basketry.sources import fixtures as fx
from basketry.operators import baskets, kpis, quality, segments, series, stats, windows
from basketry.sources.events import decode_orders, encode_orders, split_valid

T0 = dt.datetime(2024, 1, 15, 11, 0, 0)


def orders_df(spark, rows):
    """rows: (order_id, user_id, product_id, price, currency, timestamp)"""
    return spark.createDataFrame(rows, "order_id string, user_id string, product_id string, "
                                       "price double, currency string, timestamp timestamp")


def views_df(spark, rows):
    return spark.createDataFrame(rows, "user_id string, product_id string, category string, "
                                       "timestamp timestamp")


# ---- decode (T1, T2, P2, P4) -------------------------------------------------------

def test_json_good_bad(spark):
    lines = [
        json.dumps({"eventType": "ORDER", "orderId": "o1", "userId": "u1", "productId": "p1",
                    "price": 10.5, "currency": "USD", "timestamp": 1705316400.25}),
        "{not json",
        json.dumps({"eventType": "ORDER", "orderId": "o2", "userId": "u1", "productId": "p2",
                    "price": "cheap", "currency": "EUR", "timestamp": 1705316400}),
        json.dumps({"eventType": "ORDER", "orderId": "o3", "userId": "u2", "productId": "p3",
                    "price": 20.0, "currency": "GBP", "timestamp": "2024-01-15T11:00:00Z"}),
        json.dumps({"eventType": "ORDER", "orderId": "o4", "userId": "u2", "productId": "p4",
                    "price": 30.0, "currency": "JPY"}),
    ]
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    valid, bad = split_valid(decode_orders(raw, keep_raw=True))
    got = {r.order_id: r for r in valid.collect()}
    assert set(got) == {"o1", "o2", "o3"}
    assert got["o1"].timestamp == dt.datetime(2024, 1, 15, 11, 0, 0, 250000)
    assert got["o2"].price is None                      # one bad field: partial row
    assert got["o3"].timestamp == dt.datetime(2024, 1, 15, 11, 0, 0)   # ISO accepted
    bad_rows = bad.collect()
    assert len(bad_rows) == 2                           # broken JSON, missing time
    assert {r.json for r in bad_rows} == {lines[1], lines[4]}


def test_encode_decode_roundtrip(spark):
    o = orders_df(spark, [("o1", "u1", "p1", 12.34, "USD", T0),
                          ("o2", "u2", "p2", 0.01, "INR", T0 + dt.timedelta(microseconds=7))])
    back = split_valid(decode_orders(encode_orders(o)))[0]
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, o.collect()))


# ---- timeline: one user's events through the windows --------------------------------

def test_timeline(spark):
    o = orders_df(spark, [("o1", "u123", "p1", 149.99, "EUR", T0 + dt.timedelta(seconds=5))])
    v = views_df(spark, [("u123", "p1", "books", T0 + dt.timedelta(seconds=1))])
    rev = windows.revenue_by_currency(o).collect()
    assert len(rev) == 1 and rev[0].window_start == T0
    assert rev[0].window_end == T0 + dt.timedelta(minutes=5)
    assert (rev[0].total_revenue, rev[0].order_count, rev[0].avg_order_value) == (149.99, 1, 149.99)
    f = windows.conversion_funnel(v, o).collect()
    assert [(r.view_count, r.order_count, r.conversion_rate) for r in f] == [(1, 1, 1.0)]


def test_funnel_zero_and_join_form(spark):
    o = orders_df(spark, [("o1", "ua", "p1", 5.0, "USD", T0), ("o2", "ub", "p1", 5.0, "USD", T0)])
    v = views_df(spark, [("ub", "p1", "toys", T0), ("uc", "p1", "toys", T0)])
    union = {r.user_id: (r.view_count, r.order_count, r.conversion_rate)
             for r in windows.conversion_funnel(v, o).collect()}
    assert union == {"ua": (0, 1, 0.0), "ub": (1, 1, 1.0), "uc": (1, 0, 0.0)}
    join = {r.user_id: (r.view_count, r.order_count, r.conversion_rate)
            for r in windows.conversion_funnel_join(v, o).collect()}
    assert join == union


def test_conversion_where_vs_having(spark):
    # u1: one order-only window, one window with 2 views and 1 order
    o = orders_df(spark, [("o1", "u1", "p1", 1.0, "USD", T0),
                          ("o2", "u1", "p1", 1.0, "USD", T0 + dt.timedelta(minutes=10))])
    v = views_df(spark, [("u1", "p1", "toys", T0 + dt.timedelta(minutes=11)),
                         ("u1", "p2", "toys", T0 + dt.timedelta(minutes=12))])
    fun = windows.conversion_funnel(v, o)
    where = kpis.user_conversion(fun).collect()[0]
    having = kpis.user_conversion_having(fun).collect()[0]
    assert (where.total_views, where.total_orders, where.conversion_rate) == (2, 1, 50.0)
    assert (having.views, having.orders, having.conversion_rate) == (2, 2, 100.0)


# ---- segments and buckets (X1, T16) ----------------------------------------------------

def test_segment_edges(spark):
    spends = {"a": 100.0, "b": 100.01, "c": 500.0, "d": 500.01, "e": 1000.0, "f": 1000.01}
    o = orders_df(spark, [(f"o{u}", u, "p", x, "USD", T0) for u, x in spends.items()])
    got = {r.user_id: r.segment for r in segments.user_segments(o, k=None).collect()}
    assert got == {"a": "New", "b": "Regular", "c": "Regular", "d": "Premium",
                   "e": "Premium", "f": "VIP"}
    summ = {r.segment: r.user_count for r in segments.segment_summary(o).collect()}
    assert summ == {"New": 1, "Regular": 2, "Premium": 2, "VIP": 1}


def test_bucket_edges(spark):
    counts = {"a": 1, "b": 2, "c": 5, "d": 6, "e": 10, "f": 11}
    rows = [(f"o{u}{i}", u, "p", 1.0, "USD", T0) for u, n in counts.items() for i in range(n)]
    got = [(r.order_count_bucket, r.order_count)
           for r in segments.order_count_buckets(orders_df(spark, rows)).collect()]
    assert got == [("1 order", 1), ("2-5 orders", 2), ("6-10 orders", 2), ("10+ orders", 1)]


# ---- exact order statistics (T11, A20) ---------------------------------------------------

@pytest.mark.parametrize("n", list(range(1, 13)))
def test_percentile_indices(spark, n):
    prices = [float(10 + 3 * i) for i in range(n)] + [10.0, 13.0][: n // 6]
    df = spark.createDataFrame([(p,) for p in prices], "price double")
    got = {r.name: r.value for r in stats.values_at_ranks(df, "price", stats.QUARTILES, 3).collect()}
    s = sorted(prices)
    m = len(s)
    assert got == {"p25": s[m // 4], "p50": s[m // 2], "p75": s[3 * m // 4]}


def test_no_sorted_range_above_the_bound(spark, monkeypatch):
    """A column of distinct values, three slices: every rank's range is refined
    below the bound, in the number of rounds that the cuts give."""
    n, bound, cuts = 20_000, 50, 8
    df = spark.range(n).select((F.col("id") * 7919 % n + 0.25).alias("price"))
    fr = {f"q{k}": (k, 10) for k in range(10)} | {"last": (n - 1, n)}
    ranges, rounds = [], []
    tagged, refined = stats._tagged, stats._refined
    monkeypatch.setattr(stats, "_tagged", lambda d, c, r: ranges.append(r) or tagged(d, c, r))
    monkeypatch.setattr(stats, "_refined", lambda *a: rounds.append(1) or refined(*a))
    got = {r.name: r.value for r in stats.values_at_ranks(df, "price", fr, 3, bound, cuts).collect()}
    assert got == {k: n * a // b + 0.25 for k, (a, b) in fr.items()}
    assert max(r.distinct for r in ranges[-1]) <= bound and 3 <= len(rounds) <= 5
    days = spark.createDataFrame([(dt.datetime(2024, 1, 1) + dt.timedelta(hours=i),) for i in range(300)], "t timestamp")
    assert stats.values_at_ranks(days, "t", {"m": (1, 2)}, 2, 10, 4).first().value == dt.datetime(2024, 1, 1) + dt.timedelta(hours=150)
    none = spark.createDataFrame([(None,)] * 3, "price double")
    assert stats.values_at_ranks(none, "price", fr, 3, 1, 2).count() == 0


def test_price_distribution_hot_value(spark):
    # one price holds a third of all rows
    prices = [5.0] * 40 + [float(i) for i in range(80)]
    df = spark.createDataFrame([(p,) for p in prices], "price double")
    r = stats.price_distribution(df).collect()[0]
    s = sorted(prices)
    assert (r.p25, r.p50, r.p75) == (s[len(s) // 4], s[len(s) // 2], s[3 * len(s) // 4])
    assert r["count"] == 120


def test_empty_distribution(spark):
    df = spark.createDataFrame([], "price double")
    r = stats.price_distribution(df).collect()[0]
    assert r["count"] == 0 and r.p50 is None


# ---- baskets (B1, B2, T13) --------------------------------------------------------------

def test_basket_dupes(spark):
    rows = [(f"o{i}", "u1", "p1", 1.0, "USD", T0) for i in range(2)] + \
           [(f"o{i + 2}", "u1", "p2", 1.0, "USD", T0) for i in range(3)]
    o = orders_df(spark, rows)
    got = {(r.product1, r.product2): r.co_occurrence_count
           for r in baskets.basket_pairs(o).collect()}
    assert got == {("p1", "p1"): 1, ("p2", "p2"): 3, ("p1", "p2"): 6}
    rec = baskets.recommendations(o).collect()
    # T0 = 11:00 lies in the windows starting 10:30 and 11:00
    assert [(r.product_id, r.recommended_product_id, r.co_purchase_count) for r in rec] == \
        [("p1", "p2", 2)]


def test_basket_slide(spark):
    def at(h, m):
        return dt.datetime(2024, 1, 15, h, m)
    pairs = [(at(10, 5), at(10, 25)), (at(10, 25), at(10, 45)), (at(10, 5), at(10, 45)),
             (at(10, 25), at(11, 5))]
    for i, (ta, tb) in enumerate(pairs):
        o = orders_df(spark, [("a", "u", "pa", 1.0, "USD", ta), ("b", "u", "pb", 1.0, "USD", tb)])
        rec = baskets.recommendations(o).collect()
        n = rec[0].co_purchase_count if rec else 0
        assert n == [2, 1, 1, 0][i]


def test_salted_equals_plain(spark):
    import random
    rnd = random.Random(7)
    rows = [(f"o{i}", f"u{rnd.randint(0, 4) if i % 3 else 0}", f"p{rnd.randint(0, 30)}", 1.0,
             "USD", T0 + dt.timedelta(minutes=rnd.randint(0, 200))) for i in range(400)]
    o = orders_df(spark, rows)
    plain = sorted(map(tuple, baskets.basket_pairs(o).collect()))
    salted = sorted(map(tuple, baskets.basket_pairs(o, block_items=3).collect()))
    assert plain == salted
    rp = sorted(map(tuple, baskets.basket_pair_counts(baskets.window_baskets(o)).collect()))
    rs = sorted(map(tuple, baskets.basket_pair_counts(baskets.window_baskets(o), block_items=2).collect()))
    assert rp == rs
    # property: total pair weight = sum over users of n_u (n_u - 1) / 2
    per_user = {}
    for r in rows:
        per_user[r[1]] = per_user.get(r[1], 0) + 1
    assert sum(x[2] for x in plain) == sum(n * (n - 1) // 2 for n in per_user.values())


# ---- sessions (T15) ----------------------------------------------------------------------

def test_session_floor(spark):
    o = orders_df(spark, [("o1", "u", "p", 1.0, "USD", dt.datetime(2024, 1, 1, 10, 0, 0, 900000))])
    v = views_df(spark, [("u", "p", "toys", dt.datetime(2024, 1, 1, 10, 0, 2, 100000))])
    r = windows.user_sessions(v, o).collect()[0]
    assert r.session_duration_seconds == 2 and r.has_conversion and r.events_count == 2


# ---- quality (K36-K41, T17) --------------------------------------------------------------

def test_quality_nulls_and_empty(spark):
    o = orders_df(spark, [("o1", "u", "p", None, "USD", None), ("o2", "u", "p", 3.0, "USD", T0)])
    assert quality.null_timestamp_pct(o).first()[0] == 50.0
    e = orders_df(spark, [])
    assert quality.freshness(e).first().data_freshness_seconds == 999.0
    assert quality.freshness(e, empty_value=None, alias="lag").first().lag is None
    assert quality.min_price(e).first().min_price == 0.0
    assert quality.null_timestamp_pct(e).first()[0] is None
    assert quality.order_id_uniqueness_pct(e).first()[0] is None


def test_outlier_bounds(spark):
    prices = [-50.0, 0.0] + [10.0 + (i % 5) for i in range(50)]
    o = orders_df(spark, [(f"o{i}", "u", "p", p, "USD", T0) for i, p in enumerate(prices)])
    got = {r.price for r in quality.price_outliers(o, k=None).collect()}
    import statistics
    hi = statistics.mean(prices) + 3 * statistics.stdev(prices)
    pos = [p for p in prices if p > 0]
    lo = statistics.mean(pos) - 3 * statistics.stdev(pos)
    assert got == {p for p in prices if p > hi or p < lo}
    # 0.0 is only an outlier because the lower bound ignores non-positive rows
    assert got == {-50.0, 0.0}


def test_uniqueness_pct(spark):
    o = orders_df(spark, [("o1", "u", "p", 1.0, "USD", T0)] * 3 + [("o2", "u", "p", 1.0, "USD", T0)])
    assert quality.order_id_uniqueness_pct(o).first()[0] == 50.0


# ---- counter rate with resets (W2) and gauges (W3) --------------------------------------

def test_counter_reset(spark):
    base = dt.datetime(2024, 1, 1, 0, 0)
    vals = [10.0, 20.0, 30.0, 5.0, 15.0]
    rows = [(base + dt.timedelta(seconds=15 * i), "c", {"topic": "a"}, v) for i, v in enumerate(vals)]
    rows += [(base + dt.timedelta(seconds=15 * i), "c", {"topic": "b"}, float(i)) for i in range(4)]
    s = spark.createDataFrame(rows, "ts timestamp, name string, labels map<string,string>, value double")
    got = {(r.time, r.topic): r.rate for r in series.counter_rate(s, "c", "topic").collect()}
    # window [00:00, 00:01): deltas 10, 10, then reset -> 5; next window: 15 - 5
    assert got[(base, "a")] == pytest.approx(25.0 / 60)
    assert got[(base + dt.timedelta(minutes=1), "a")] == pytest.approx(10.0 / 60)
    assert got[(base, "b")] == pytest.approx(3.0 / 60)
    g = series.latest_gauge(s, "c", "topic", "a").collect()
    assert g[0].value == 15.0


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, value long")
    got = {r.k: r.share for r in series.share_of_total(df, "value").collect()}
    assert got == {"a": 0.25, "b": 0.75}


# ---- ties (L2) ----------------------------------------------------------------------------

def test_ties_are_broken_by_key(spark):
    rows = [(f"o{i}", f"u{i}", "p", 10.0, "USD", T0) for i in range(5)]
    got = [r.user_id for r in segments.top_users_by_revenue(orders_df(spark, rows), k=3).collect()]
    assert got == ["u0", "u1", "u2"]


def test_hour_of_day_utc(spark):
    o = orders_df(spark, [("o1", "u", "p", 1.0, "USD", dt.datetime(2024, 1, 1, 23, 59))])
    assert [(r.hour, r.order_count) for r in stats.orders_by_hour(o).collect()] == [(23, 1)]
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_converted_split_negative(spark):
    fun = spark.createDataFrame(
        [(dt.datetime(2024, 1, 30, 23, 0), dt.datetime(2024, 1, 30, 23, 5), "u", 0, 3, 0.0)],
        "window_start timestamp, window_end timestamp, user_id string, view_count long, "
        "order_count long, conversion_rate double")
    got = {r.status: r["count"] for r in kpis.converted_split(fun).collect()}
    assert got == {"Converted": 3, "Not Converted": -3}


def test_decode_keeps_microseconds(spark):
    for x in (1.000001, 1705316400.123456, 0.5):
        raw = spark.createDataFrame([(json.dumps({"orderId": "o", "timestamp": x}),)], "value string")
        r = decode_orders(raw).first()
        want = spark.sql(f"SELECT CAST(CAST({x!r} AS DOUBLE) AS TIMESTAMP) AS t").first().t
        assert r.timestamp == want


def test_no_python_udfs_in_plans(spark, sf_small):
    import __spark_entry__ as ent
    from basketry.plans.registry import load_all
    for name, fn in ((n, e.fn) for n, e in load_all().items()):
        if name.startswith("st_"):
            continue
        plan = fn(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_filters_reach_the_scan(spark, sf_small):
    import __spark_entry__ as ent
    df = ent.queries()["k02_total_revenue_usd"](spark, sf_small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,purchase)" in plan
    # only the three columns the query touches are read (no ts, user_id, props)
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in plan


def test_lookback_inclusive_vs_strict(spark):
    now = dt.datetime(2024, 1, 31)
    o = orders_df(spark, [("o1", "u", "p", 1.0, "USD", now - dt.timedelta(hours=1))])
    strict = kpis.per_minute(o, F.count(F.lit(1)), "n", "1 hour", inclusive=False).count()
    incl = kpis.per_minute(o, F.count(F.lit(1)), "n", "1 hour", inclusive=True).count()
    assert (strict, incl) == (0, 1)


def test_gap_sessions_extension(spark):
    # events 10:00, 10:03 (same session), 10:20 (new session after a 5 min gap)
    o = orders_df(spark, [("o1", "u", "p", 1.0, "USD", dt.datetime(2024, 1, 1, 10, 3))])
    v = views_df(spark, [("u", "p", "toys", dt.datetime(2024, 1, 1, 10, 0)),
                         ("u", "p", "toys", dt.datetime(2024, 1, 1, 10, 20))])
    got = sorted((r.window_start.strftime("%H:%M"), r.window_end.strftime("%H:%M"), r.events_count,
                  r.has_conversion) for r in windows.gap_sessions(v, o).collect())
    assert got == [("10:00", "10:08", 2, True), ("10:20", "10:25", 1, False)]


def test_approx_quartiles_close_to_exact(spark):
    prices = [float(i) for i in range(1, 1001)]
    df = spark.createDataFrame([(p,) for p in prices], "price double")
    r = stats.approx_quartiles(df).first()
    assert abs(r.p25 - 250) <= 2 and abs(r.p50 - 500) <= 2 and abs(r.p75 - 750) <= 2


def test_distinct_counts_spread_hot_key_first(spark):
    # a hot user: the first exchange is on (user, product), before the one on user
    o = orders_df(spark, [(f"o{i}", "hot" if i % 3 else f"u{i}", f"p{i % 50}", 1.0, "USD", T0)
                          for i in range(300)])
    plan = segments.user_stats(o)._jdf.queryExecution().executedPlan().toString()
    first = plan.rfind("Exchange hashpartitioning(")
    assert "product_id" in plan[first:first + 80]
    got = {r.user_id: r.unique_products for r in segments.user_stats(o).collect()}
    assert got["hot"] == 50


def test_epoch_helpers(spark):
    from basketry.functions import epoch_millis, epoch_seconds
    o = orders_df(spark, [("o", "u", "p", 1.0, "USD", dt.datetime(1970, 1, 1, 0, 0, 1, 500000))])
    r = o.select(epoch_millis("timestamp").alias("ms"), epoch_seconds("timestamp").alias("s")).first()
    assert (r.ms, r.s) == (1500, 1.5)


def test_window_lookbacks_reach_the_scan(spark, sf_small):
    """Every lookback over a window table bounds ``ts`` in the Parquet scan."""
    import re

    from basketry.plans.registry import load_all
    names = [n for n in load_all() if re.match(r"k(2[4-6]|2[89]|3[0-5]|43)_|k27_latest_revenue_windows_top50", n)]
    assert len(names) > 20
    for n in names:
        plan = load_all()[n].fn(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PushedFilters: .*GreaterThan(OrEqual)?\(ts,", plan), n


def test_line_views_have_the_same_rows(spark, sf_small):
    full = fx.line_orders(spark, sf_small)
    for part in (fx.line_items(spark, sf_small), fx.line_users(spark, sf_small)):
        assert part.exceptAll(full.select(*part.columns)).count() == 0 and part.count() == full.count()
