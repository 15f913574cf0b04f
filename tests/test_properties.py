"""Property checks against brute force on random (and skewed) inputs."""

from __future__ import annotations

import datetime as dt
import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketry.operators import baskets, segments, stats, windows

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
T0 = dt.datetime(2024, 1, 1)

prices = st.lists(st.one_of(st.integers(0, 40).map(lambda i: i / 4),
                            st.just(7.5)),           # a hot value shows up often
                  min_size=1, max_size=80)


@SETTINGS
@given(prices, st.integers(2, 9))
def test_ranks_match_sorted_list(spark, xs, slices):
    df = spark.createDataFrame([(x,) for x in xs], "price double")
    fr = {"a": (1, 4), "b": (1, 2), "c": (3, 4), "d": (0, 1), "e": (9, 10)}
    got = {r.name: r.value for r in stats.values_at_ranks(df, "price", fr, slices).collect()}
    s = sorted(xs)
    assert got == {k: s[len(s) * a // b] for k, (a, b) in fr.items()}


@SETTINGS
@given(prices, st.integers(1, 3), st.integers(1, 6), st.integers(2, 5))
def test_refined_ranks_match_sorted_list(spark, xs, slices, bound, cuts):
    """Ranges are cut until no more than ``bound`` distinct values are sorted."""
    df = spark.createDataFrame([(x,) for x in xs], "price double")
    fr = {"a": (1, 4), "b": (1, 2), "c": (3, 4), "d": (0, 1), "e": (9, 10)}
    got = {r.name: r.value for r in stats.values_at_ranks(df, "price", fr, slices, bound, cuts).collect()}
    s = sorted(xs)
    assert got == {k: s[len(s) * a // b] for k, (a, b) in fr.items()}


lines = st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3", "u4"]),
                           st.sampled_from([f"p{i}" for i in range(6)]),
                           st.integers(0, 300)),
                 min_size=0, max_size=60)


def _orders(spark, rows):
    return spark.createDataFrame(
        [(f"o{i}", u, p, 1.0, "USD", T0 + dt.timedelta(minutes=m)) for i, (u, p, m) in enumerate(rows)],
        "order_id string, user_id string, product_id string, price double, currency string, "
        "timestamp timestamp")


@SETTINGS
@given(lines, st.integers(0, 3))
def test_basket_pairs_brute_force(spark, rows, heavy):
    by_user = {}
    for u, p, _ in rows:
        by_user.setdefault(u, []).append(p)
    want = {}
    for ps in by_user.values():
        for a, b in itertools.combinations(ps, 2):
            k = (min(a, b), max(a, b))
            want[k] = want.get(k, 0) + 1
    got = {(r.product1, r.product2): r.co_occurrence_count
           for r in baskets.basket_pairs(_orders(spark, rows), block_items=max(1, heavy)).collect()}
    assert got == want


@SETTINGS
@given(lines, st.integers(1, 12), st.integers(1, 4), st.integers(1, 4))
def test_top_pairs_equal_the_first_of_all_pairs(spark, rows, k, block, most):
    o = _orders(spark, rows + rows[:7])      # repeats make counts above 1 and pairs of one item
    want = [tuple(r) for r in baskets.top_pairs(baskets.basket_pairs(o), k).collect()]
    got = [tuple(r) for r in baskets.top_basket_pairs(o, k, block_items=block, max_blocks=most).collect()]
    assert got == want


@settings(SETTINGS, max_examples=4)
@given(lines, st.integers(1, 8), st.integers(1, 4), st.integers(1, 5))
def test_top_pairs_of_baskets_in_pieces(spark, rows, k, block, piece):
    hot = [("u9", "p0", 0)] * 9 + [("u9", "p1", 0)] * 5     # norms that leave blocks out
    o = _orders(spark, rows + hot)
    want = [tuple(r) for r in baskets.top_pairs(baskets.basket_pairs(o), k).collect()]
    got = [tuple(r) for r in baskets.top_basket_pairs(o, k, block_items=block, basket_items=piece, task_pairs=9).collect()]
    assert got == want


def test_top_pairs_send_a_row_once_however_many_items(spark, monkeypatch):
    o = _orders(spark, [(f"u{u}", f"p{5 * u + i}", 0) for u in range(40) for i in range(5)])
    sent, real = [], type(o).repartition
    monkeypatch.setattr(type(o), "repartition", lambda df, *a: (sent.append(df.count()), real(df, *a))[1])
    got = baskets.top_basket_pairs(o, 3, block_items=5).collect()
    assert [tuple(r) for r in got] == [("p0", "p1", 1), ("p0", "p2", 1), ("p0", "p3", 1)]
    assert sum(sent) <= 200      # 200 rows of (user, item); blocks of items got 32 copies of each


@SETTINGS
@given(lines)
def test_window_properties(spark, rows):
    o = _orders(spark, rows)
    rev = windows.revenue_by_currency(o)
    assert (rev.agg(F.sum("order_count")).first()[0] or 0) == len(rows)
    seg = segments.segment_summary(o)
    assert (seg.agg(F.sum("user_count")).first()[0] or 0) == len({u for u, _, _ in rows})
    # every row falls into exactly two sliding windows
    two = o.select(F.window("timestamp", "1 hour", "30 minutes")).count()
    assert two == 2 * len(rows)
    # recommendation counts equal brute force over (window, user) baskets
    want = {}
    baskets_ = {}
    for u, p, m in rows:
        t = T0 + dt.timedelta(minutes=m)
        start = t.replace(minute=(t.minute // 30) * 30, second=0, microsecond=0)
        for w in (start, start - dt.timedelta(minutes=30)):
            baskets_.setdefault((w, u), set()).add(p)
    for ps in baskets_.values():
        for a, b in itertools.combinations(sorted(ps), 2):
            want[(a, b)] = want.get((a, b), 0) + 1
    got = {(r.product_id, r.recommended_product_id): r.co_purchase_count
           for r in baskets.recommendations(o).collect()}
    assert got == want


samples = st.lists(st.tuples(st.integers(0, 3 * 24 * 60 * 4 - 1),      # 15 s slots over 3 days
                             st.sampled_from(["a", "b"]),
                             st.integers(0, 50)),
                   min_size=1, max_size=40, unique_by=lambda t: (t[0], t[1]))


@SETTINGS
@given(samples)
def test_counter_rate_brute_force(spark, rows):
    from basketry.operators import series
    data = [(T0 + dt.timedelta(seconds=15 * k), "c", {"topic": t}, float(v)) for k, t, v in rows]
    df = spark.createDataFrame(data, "ts timestamp, name string, labels map<string,string>, value double")
    got = {(r.time, r.topic): r.rate for r in series.counter_rate(df, "c", "topic").collect()}
    want = {}
    for topic in ("a", "b"):
        pts = sorted((ts, v) for ts, _, lab, v in data if lab["topic"] == topic)
        for (t0, v0), (t1, v1) in zip(pts, pts[1:]):
            inc = v1 if v1 < v0 else v1 - v0
            w = t1.replace(second=0, microsecond=0)
            want[(w, topic)] = want.get((w, topic), 0.0) + inc
    want = {k: v / 60.0 for k, v in want.items()}
    assert got.keys() == want.keys()
    for k in want:
        assert abs(got[k] - want[k]) < 1e-9


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 20).map(float)), min_size=1, max_size=60))
def test_distribution_with_nulls(spark, xs):
    import statistics
    df = spark.createDataFrame([(x,) for x in xs], "price double")
    r = stats.price_distribution(df).first()
    vals = sorted(x for x in xs if x is not None)
    assert r["count"] == len(xs)
    if not vals:
        assert r.p50 is None and r.mean is None
        return
    n = len(vals)
    assert (r.p25, r.p50, r.p75) == (vals[n // 4], vals[n // 2], vals[3 * n // 4])
    assert abs(r.mean - statistics.mean(vals)) < 1e-9
    assert abs(r.stddev - statistics.pstdev(vals)) < 1e-9
    assert (r["min"], r["max"]) == (vals[0], vals[-1])
