"""JDBC round trip on embedded in-memory Derby (in-process, no port)."""

from __future__ import annotations

import datetime as dt
import json
import uuid

import pytest

from basketry import schemas
from basketry.sources import jdbc
from basketry.streaming.sinks import JdbcUpsertSink

DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
TYPES = "k VARCHAR(20), v DOUBLE"


def test_partitioned_scan_and_upsert(spark):
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex[:8]};create=true"
    jdbc.execute(spark, url, ["CREATE TABLE orders_raw (k VARCHAR(20) PRIMARY KEY, v DOUBLE, n INT)"],
                 DRIVER)
    rows = spark.createDataFrame([(f"o{i}", float(i), i) for i in range(100)], "k string, v double, n int")
    jdbc.write_table(rows, url, "orders_raw", "append", properties=DRIVER)
    scan = jdbc.read_table(spark, url, "orders_raw", properties=DRIVER, partition_column="n",
                           lower_bound=0, upper_bound=100, num_partitions=4)
    assert scan.rdd.getNumPartitions() == 4
    assert scan.count() == 100 and scan.agg({"v": "sum"}).first()[0] == sum(range(100))
    # filters reach the database
    plan = scan.where("n > 90")._jdf.queryExecution().executedPlan().toString().lower()
    assert "*greaterthan(n,90)" in plan

    jdbc.execute(spark, url, ["CREATE TABLE rev (k VARCHAR(20) PRIMARY KEY, v DOUBLE)"], DRIVER)
    sink = JdbcUpsertSink(url, "rev", ["k"], DRIVER, TYPES)
    sink(spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double"), 0)
    sink(spark.createDataFrame([("a", 5.0)], "k string, v double"), 1)
    sink(spark.createDataFrame([("a", 5.0)], "k string, v double"), 1)   # retried batch
    got = sorted(map(tuple, jdbc.read_table(spark, url, "rev", properties=DRIVER).collect()))
    assert jdbc.read_table(spark, url, "(SELECT COUNT(*) AS c FROM sys.systables WHERE "
                           "tablename LIKE 'REV_STAGE%') q", properties=DRIVER).first()[0] == 0
    assert got == [("a", 5.0), ("b", 2.0)]


def _sizes(df):
    return df.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()


def _filled(spark, ddl, rows, schema, key="k"):
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex[:8]};create=true"
    jdbc.execute(spark, url, [f"CREATE TABLE things ({ddl})"], DRIVER)
    jdbc.write_table(spark.createDataFrame(rows, schema), url, "things", "append", properties=DRIVER)
    return url


def test_a_scan_plans_balanced_parts_without_bounds(spark):
    # a skewed number key: most rows in a thousandth of the range
    rows = [(i if i < 900 else i * 10_000, f"v{i}") for i in range(1000)]
    url = _filled(spark, "k INT NOT NULL PRIMARY KEY, v VARCHAR(20)", rows, "k int, v string")
    df = jdbc.read_table(spark, url, "things", properties=DRIVER, num_partitions=5)       # key from the metadata
    assert sorted(map(tuple, df.collect())) == rows
    sizes = _sizes(df)
    assert len(sizes) == 5 and max(sizes) <= 1.5 * 200
    # a text key: half of the rows share a long prefix
    rows = [(f"user-{i:04d}" if i % 2 else f"{chr(97 + i % 23)}{i}",) for i in range(1000)] + [("it's",)]
    url = _filled(spark, "k VARCHAR(20) NOT NULL PRIMARY KEY", rows, "k string")
    df = jdbc.read_table(spark, url, "things", properties=DRIVER, num_partitions=4)
    assert sorted(map(tuple, df.collect())) == sorted(rows)
    assert len(_sizes(df)) == 4 and max(_sizes(df)) <= 1.5 * 250
    # a time key with nulls, no primary key
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(seconds=i if i < 700 else i * 3600), i) for i in range(800)] + [(None, -i) for i in range(1, 11)]
    url = _filled(spark, "t TIMESTAMP, n INT", rows, "t timestamp, n int")
    df = jdbc.read_table(spark, url, "things", properties=DRIVER, num_partitions=4, partition_column="t")
    assert sorted(r[1] for r in df.collect()) == sorted(r[1] for r in rows)
    assert len(_sizes(df)) == 4 and max(_sizes(df)) <= 1.5 * 203
    with pytest.raises(ValueError):
        jdbc.read_table(spark, url, "things", properties=DRIVER, num_partitions=4)
    # one value, and no rows at all
    url = _filled(spark, "k INT", [(7,)] * 5, "k int")
    assert jdbc.read_table(spark, url, "things", properties=DRIVER, num_partitions=4, partition_column="k").count() == 5
    jdbc.execute(spark, url, ["DELETE FROM things"], DRIVER)
    assert jdbc.read_table(spark, url, "things", properties=DRIVER, num_partitions=4, partition_column="k").count() == 0


ORDERS_DDL = ("CREATE TABLE orders_raw (order_id VARCHAR(40) NOT NULL PRIMARY KEY, user_id VARCHAR(40), product_id VARCHAR(40), "
              "price DOUBLE, currency VARCHAR(8), timestamp TIMESTAMP)")
TABLES_DDL = [
    ORDERS_DDL.replace(", timestamp TIMESTAMP", ', "TIMESTAMP" TIMESTAMP'),
    "CREATE TABLE revenue_by_currency_5min (window_start TIMESTAMP NOT NULL, window_end TIMESTAMP, currency VARCHAR(8) NOT NULL, "
    "total_revenue DOUBLE, order_count BIGINT, avg_order_value DOUBLE, PRIMARY KEY (window_start, currency))",
    "CREATE TABLE conversion_funnel_5min (window_start TIMESTAMP NOT NULL, window_end TIMESTAMP, user_id VARCHAR(40) NOT NULL, "
    "view_count BIGINT, order_count BIGINT, conversion_rate DOUBLE, PRIMARY KEY (window_start, user_id))"]


def test_typed_scan_and_report_of_database_tables(spark, sf_small):
    from basketry.cli import jdbc_report
    from basketry.operators import kpis, segments, windows
    from basketry.sources import fixtures as fx

    url = f"jdbc:derby:memory:t{uuid.uuid4().hex[:8]};create=true"
    jdbc.execute(spark, url, TABLES_DDL, DRIVER)
    orders = fx.orders_raw(spark, sf_small)
    revenue, funnel = windows.revenue_by_currency(orders), windows.conversion_funnel_from_events(fx.funnel_events(spark, sf_small))
    upper = lambda df: df.toDF(*(c.upper() for c in df.columns))
    for name, df in (("orders_raw", orders), ("revenue_by_currency_5min", revenue), ("conversion_funnel_5min", funnel)):
        jdbc.write_table(upper(df), url, name, "append", properties=DRIVER)
    back = jdbc.read_typed(spark, url, "orders_raw", properties=DRIVER, num_partitions=3)
    assert back.schema.simpleString() == schemas.ORDERS_RAW.simpleString()
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, orders.collect()))
    sizes = _sizes(back)
    assert len(sizes) == 3 and max(sizes) <= 1.6 * sum(sizes) / 3
    got = jdbc_report(spark, url, DRIVER, 3)
    plain = lambda df: [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect()]
    assert plain(got["top currencies"]) == plain(kpis.top_currencies(revenue))
    assert plain(got["vip users"]) == plain(segments.vip_users(orders))
    with pytest.raises(ValueError):
        jdbc.read_typed(spark, url, "orders_raw", "revenue_by_currency_5min", properties=DRIVER)


def test_all_jobs_upsert_into_a_database(spark):
    from basketry.session import run_dir
    from basketry.sources.events import read_json_lines_stream
    from basketry.streaming import pipelines as pl

    url = f"jdbc:derby:memory:t{uuid.uuid4().hex[:8]};create=true"
    jdbc.execute(spark, url, [s.replace('"TIMESTAMP" TIMESTAMP', "event_time TIMESTAMP") if "orders_raw" in s else s for s in TABLES_DDL], DRIVER)
    root = run_dir(spark, "test-jdbc-jobs")
    now = pl.Trigger(processing_time=None, available_now=True)
    line = lambda i, m: json.dumps({"eventType": "ORDER", "orderId": f"o{i}", "userId": "u1", "productId": "p1", "price": 2.0,
                                    "currency": "USD", "timestamp": 1704103200 + 60 * m})
    for k, lines in enumerate([[line(1, 0), line(2, 1)], [line(3, 2)]]):
        spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{root}/feed/p={k}")
        raw = read_json_lines_stream(spark, f"{root}/feed").select("value")
        sink = JdbcUpsertSink(url, "revenue_by_currency_5min", ["window_start", "currency"], DRIVER)
        q = pl.start_revenue(raw, f"{root}/t", f"{root}/ckpt", now, sink=sink)
        q.awaitTermination()
        assert q.exception() is None
    r = jdbc.read_typed(spark, url, "revenue_by_currency_5min", properties=DRIVER, partition_column="window_start").collect()
    assert [(x.order_count, x.total_revenue) for x in r] == [(3, 6.0)]


def test_published_feeds_decode_to_the_same_rows(spark, sf_small):
    from basketry.cli import publish
    from basketry.session import run_dir
    from basketry.sources import fixtures as fx
    from basketry.sources.events import decode_orders, read_json_lines, split_valid

    root = run_dir(spark, "test-publish")
    publish(spark, sf_small, root)
    back = split_valid(decode_orders(read_json_lines(spark, f"{root}/orders")))[0]
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, fx.orders_raw(spark, sf_small).collect()))
    assert read_json_lines(spark, f"{root}/views").count() == fx.product_views(spark, sf_small).count()
    assert read_json_lines(spark, f"{root}/users").count() == fx.user_events(spark, sf_small).count()
