"""File replay of the fixture feeds through the streaming queries.

The fixture tables are encoded as JSON events (SNK8) and staged as JSON-lines
files in ``pieces`` consecutive event-time ranges, by one distributed job a feed.
A piece is published by renaming its folder into the feed; then the query runs
with ``availableNow`` and stops; the next run restarts from the same checkpoint
(state, offsets and watermark restored), so every replay also exercises recovery
(ST11).  The driver only computes the time bounds and the number of rows (one row).
"""

from __future__ import annotations

import datetime as dt
import math
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import config
from basketry.session import run_dir
from basketry.sources import fixtures as fx
from basketry.sources.events import decode_orders, encode_orders, encode_views, read_json_lines, read_json_lines_stream, split_valid
from basketry.streaming.versions import _fs


def time_bounds(frames: list[DataFrame], ts: str = "timestamp") -> tuple[dt.datetime, dt.datetime, int]:
    """(first event time, last one, rows) of all feeds, in one pass."""
    parts = [f.select(F.col(ts).alias("t")) for f in frames]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    r = u.agg(F.min("t").alias("lo"), F.max("t").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    return r["lo"], r["hi"], r["n"]


def state_partitions(rows: int, most: int) -> int:
    """Partitions of a stateful query over a feed of ``rows`` rows, ``most`` at most.

    Every task of such a query reports metrics of every state partition, so what a
    batch sends to the driver grows with the square of their number; with the square
    root of the rows as their number it grows with the rows."""
    return min(most, max(config.STATE_PARTITIONS, math.ceil(math.sqrt(rows / config.STATE_ROWS))))


def stage(df: DataFrame, encode: Callable[..., DataFrame], path: str, pieces: int, lo, hi) -> None:
    """One pass over a feed: JSON lines in a folder per piece of its time range."""
    width = F.unix_micros(F.lit(hi)) - F.unix_micros(F.lit(lo))
    at = (F.unix_micros("timestamp") - F.unix_micros(F.lit(lo))) * pieces / F.greatest(width, F.lit(1))
    piece = F.least(F.floor(at), F.lit(pieces - 1)).cast("int")
    encode(df.withColumn("piece", piece), keep=("piece",)).select("value", "piece") \
        .write.partitionBy("piece").format("text").save(path)


def publish(spark: SparkSession, staged: str, feed: str) -> None:
    """Move a staged piece into the feed (nothing, if the piece has no rows)."""
    a, fs = _fs(spark, staged)
    b, _ = _fs(spark, feed)
    if fs.exists(a):
        fs.mkdirs(b.getParent())
        if not fs.rename(a, b):
            raise RuntimeError(f"cannot publish {staged}")


ENCODERS = {"orders": encode_orders, "views": encode_views}


def replay_session(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """A sibling session for the replay: same SparkContext, own SQL conf.

    Stateful operators pin ``spark.sql.shuffle.partitions`` in their
    checkpoint; until :func:`replay` knows how many rows the feeds have it is the
    caller's, or ``shuffle_partitions`` where given.
    """
    sess = spark.newSession()
    sess.conf.set("spark.sql.shuffle.partitions",
                  str(shuffle_partitions or spark.conf.get("spark.sql.shuffle.partitions", "200")))
    sess.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return sess


#: Seconds of the last replay: making the feed files, and running the queries.
LAST = {"staged": 0.0, "ran": 0.0}


def replay(spark: SparkSession, sf_dir: str, start: Callable[..., list], tag: str,
           pieces: int = 4, feeds: tuple[str, ...] = ("orders", "views"),
           shuffle_partitions: int | None = None, order: list[int] | None = None) -> str:
    """Run ``start(streams: dict[name, DataFrame], root: str) -> [StreamingQuery]``
    once per piece, in event-time order or in ``order`` (which may leave pieces
    out); returns the run folder holding feeds, checkpoints and tables."""
    began = time.perf_counter()
    root = run_dir(spark, f"replay-{tag}")
    spark = replay_session(spark, shuffle_partitions)
    frames = {"orders": fx.orders_raw(spark, sf_dir), "views": fx.product_views(spark, sf_dir)}
    frames = {k: v for k, v in frames.items() if k in feeds}
    lo, hi, rows = time_bounds(list(frames.values()))
    if lo is not None:
        for k, v in frames.items():
            stage(v, ENCODERS[k], f"{root}/staged/{k}", pieces, lo, hi)
    for k in frames:
        _, fs = _fs(spark, root)
        fs.mkdirs(_fs(spark, f"{root}/feeds/{k}")[0])
    LAST["staged"] = time.perf_counter() - began
    if shuffle_partitions is None:
        most = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions(rows, most)))
    for i in order if order is not None else range(pieces):
        for k in frames:
            publish(spark, f"{root}/staged/{k}/piece={i}", f"{root}/feeds/{k}/piece={i}")
        streams = {k: read_json_lines_stream(spark, f"{root}/feeds/{k}")
                   .select("value") for k in frames}
        for q in start(streams, root):
            q.awaitTermination()
            if q.exception():
                raise RuntimeError(str(q.exception()))
    LAST["ran"] = time.perf_counter() - began - LAST["staged"]
    return root


def replayed_orders(spark: SparkSession, root: str) -> DataFrame:
    """The valid orders of a replay's feed, as a batch."""
    return split_valid(decode_orders(read_json_lines(spark, f"{root}/feeds/orders")))[0]
