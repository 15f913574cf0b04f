"""Command line: list, run or explain registered queries; run the batch
report; start the streaming jobs.

    python -m basketry.cli list
    python -m basketry.cli run q10_user_segments_top30 --sf /root/testdata/sf0.01
    python -m basketry.cli explain q14_product_cooccurrence_top10_line --sf ...
    python -m basketry.cli report --sf ...            # the four batch analyses
    python -m basketry.cli stream --orders DIR --views DIR --root SHARED_DIR
    python -m basketry.cli stream --kafka host:9092 --root SHARED_DIR
    python -m basketry.cli stream ... --jdbc URL --jdbc-driver CLASS   # upsert into a database
    python -m basketry.cli report --jdbc URL --jdbc-driver CLASS       # analyses of its tables
    python -m basketry.cli publish --sf ... --root DIR [--kafka host:9092]

Console output is a preview only (SNK6): ``show`` of at most ``--rows``
rows, with doubles formatted to two decimals for display (X21).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT = ["q06_top_currencies", "q07_user_conversion_top20_5min", "q08_overall_conversion_5min",
          "q09_revenue_by_time_window_top20", "q10_user_segments_top30", "q11_segment_summary",
          "q12_revenue_by_currency", "q13_vip_users_top10", "q14_product_cooccurrence_top10",
          "q15_price_distribution", "q16_orders_by_hour"]


def money(df: DataFrame) -> DataFrame:
    """Doubles as '%.2f' text, for display only."""
    return df.select(*[F.format_string("%.2f", F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def _properties(a) -> dict:
    return {"driver": a.jdbc_driver} if a.jdbc_driver else {}


def jdbc_report(spark, url: str, properties: dict | None = None, num_partitions: int = 8) -> dict[str, DataFrame]:
    """The batch analyses over a database's tables, each read in balanced parts."""
    from basketry.operators import baskets, kpis, segments, stats
    from basketry.sources.jdbc import read_typed

    read = lambda name: read_typed(spark, url, name, num_partitions=num_partitions, properties=properties)
    revenue, funnel, orders = (read(n) for n in ("revenue_by_currency_5min", "conversion_funnel_5min", "orders_raw"))
    return {
        "top currencies": kpis.top_currencies(revenue),
        "user conversion": kpis.user_conversion(funnel, 20),
        "overall conversion": kpis.overall_conversion(funnel),
        "revenue by time window": kpis.revenue_by_time(revenue, 20),
        "user segments": segments.user_segments(orders),
        "segment summary": segments.segment_summary(orders),
        "vip users": segments.vip_users(orders),
        "product pairs": baskets.top_basket_pairs(orders, 10),
        "price distribution": stats.price_distribution(orders),
        "orders by hour": stats.orders_by_hour(orders),
    }


def publish(spark, sf_dir: str, root: str | None = None, kafka: str | None = None) -> None:
    """SNK8: the fixture feeds as JSON events, to a broker's topics or to JSON-lines
    folders ``root/orders``, ``root/views`` and ``root/users``."""
    from basketry.sources import events as ev
    from basketry.sources import fixtures as fx

    feeds = {"orders": ("orders", ev.encode_orders(fx.orders_raw(spark, sf_dir))),
             "views": ("product-view", ev.encode_views(fx.product_views(spark, sf_dir))),
             "users": ("user-events", ev.encode_user_events(fx.user_events(spark, sf_dir)))}
    for folder, (topic, rows) in feeds.items():
        if kafka:
            ev.publish_kafka(rows, kafka, topic)
        else:
            ev.write_json_lines(rows.select("value"), f"{root}/{folder}")


def main(argv=None):
    ap = argparse.ArgumentParser(prog="basketry")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for name in ("run", "explain"):
        p = sub.add_parser(name)
        p.add_argument("query")
        p.add_argument("--sf", default="/root/testdata/sf0.01")
        p.add_argument("--rows", type=int, default=20)
    p = sub.add_parser("report")
    p.add_argument("--sf", default="/root/testdata/sf0.01")
    p.add_argument("--rows", type=int, default=20)
    p.add_argument("--jdbc")
    p.add_argument("--jdbc-driver")
    p = sub.add_parser("publish")
    p.add_argument("--sf", default="/root/testdata/sf0.01")
    p.add_argument("--kafka")
    p.add_argument("--root")
    p = sub.add_parser("stream")
    p.add_argument("--jdbc")
    p.add_argument("--jdbc-driver")
    p.add_argument("--late", action="store_true", help="keep late rows for repair")
    p.add_argument("--health", action="store_true", help="write job health to ROOT/tables/job_health")
    p.add_argument("--orders")
    p.add_argument("--views")
    p.add_argument("--kafka")
    p.add_argument("--root", required=True)
    p.add_argument("--once", action="store_true", help="availableNow, then exit")
    a = ap.parse_args(argv)

    from basketry.plans.registry import load_all
    reg = load_all()
    if a.cmd == "list":
        for n, e in reg.items():
            print(f"{n}\t{'oracle' if e.sql else 'rows-only'}")
        return
    from basketry.session import build_session
    spark = build_session()
    if a.cmd == "run":
        money(reg[a.query].fn(spark, a.sf)).show(a.rows, truncate=False)
    elif a.cmd == "explain":
        reg[a.query].fn(spark, a.sf).explain("formatted")
    elif a.cmd == "report" and a.jdbc:
        for n, df in jdbc_report(spark, a.jdbc, _properties(a)).items():
            print(f"=== {n} ===")
            money(df).show(a.rows, truncate=False)
    elif a.cmd == "report":
        for n in REPORT:
            print(f"=== {n} ===")
            money(reg[n].fn(spark, a.sf)).show(a.rows, truncate=False)
    elif a.cmd == "publish":
        publish(spark, a.sf, a.root, a.kafka)
    elif a.cmd == "stream":
        from basketry.sources.events import read_json_lines_stream, read_kafka
        from basketry.streaming import pipelines as pl
        if a.kafka:
            kafka = lambda topic, feed: lambda job: read_kafka(
                spark, a.kafka, topic, pl.OFFSETS[job, feed]).select("value")
            orders, views = kafka("orders", "orders"), kafka("product-view", "views")
        else:
            orders = read_json_lines_stream(spark, a.orders).select("value")
            views = read_json_lines_stream(spark, a.views).select("value")
        trig = pl.Trigger(processing_time=None, available_now=True) if a.once else pl.Trigger()
        jdbc = {"url": a.jdbc, "properties": _properties(a)} if a.jdbc else None
        listener = None
        if a.health:
            from basketry.streaming.health import HealthListener
            listener = HealthListener(spark, f"{a.root}/tables/job_health")
            spark.streams.addListener(listener)
        try:
            pl.await_all(spark, pl.start_all(orders, views, a.root, trig, names="basketry" if a.health else None,
                                             jdbc=jdbc, late=a.late))
        finally:
            if listener is not None:
                listener.flush()
                spark.streams.removeListener(listener)


if __name__ == "__main__":
    main()
