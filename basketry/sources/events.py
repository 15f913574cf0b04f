"""JSON event feeds: readers (SRC1, SRC2), decode (P1-P6) and encode (SNK8).

The same decode runs over a Kafka stream, a file stream of JSON lines, or a
batch DataFrame with a ``value`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import schemas


# ---- readers --------------------------------------------------------------

def read_kafka(spark: SparkSession, servers: str, topic: str,
               starting_offsets: str = "latest", **options) -> DataFrame:
    """Keyed JSON stream from a broker (needs the Kafka connector jar).

    ``starting_offsets`` is "latest", "earliest" or a per-partition JSON; use
    ``startingOffsetsByTimestamp`` in ``options`` to start at a time.
    """
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().select(F.col("key").cast("string").alias("key"),
                           F.col("value").cast("string").alias("value"))


def read_json_lines_stream(spark: SparkSession, path: str,
                           max_files_per_trigger: int | None = None) -> DataFrame:
    """File replay of a JSON-lines feed; one line per event in ``value``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("text").load(path)


# ---- decode ---------------------------------------------------------------

def _lenient(schema: T.StructType) -> T.StructType:
    """Same fields, with ``timestamp`` read as text so both wire encodings
    (epoch seconds and ISO strings, T1) survive the JSON parser."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if f.name == "timestamp" else f.dataType)
        for f in schema.fields])


def parse_event_time(c) -> "F.Column":
    """Epoch seconds (number) or ISO-8601 text -> TIMESTAMP; else null."""
    as_num = F.expr(f"try_cast({c} AS DOUBLE)")
    return F.coalesce(
        as_num.cast("timestamp"),             # same truncation as the reference's CAST
        F.try_to_timestamp(F.col(c)),
    )


def _decode(df: DataFrame, schema: T.StructType, value_col: str) -> DataFrame:
    return (df.select(F.col(value_col).cast("string").alias("json"))          # P1
              .select("json", F.from_json("json", _lenient(schema)).alias("data"))  # P2
              .select("json", "data.*")                                          # P3
              .withColumn("timestamp", parse_event_time("timestamp")))           # P4


def decode_orders(df: DataFrame, value_col: str = "value", keep_raw: bool = False) -> DataFrame:
    """JSON order events -> ``orders_raw`` columns.

    Adds ``is_valid`` (order id and event time present); use
    :func:`split_valid` to route the rest to a quarantine table (T2).
    """
    d = _decode(df, schemas.ORDER_EVENT, value_col)
    out = d.select(
        F.col("orderId").alias("order_id"),
        F.col("userId").alias("user_id"),
        F.col("productId").alias("product_id"),
        F.col("price"),
        F.col("currency"),
        F.col("timestamp"),
        (F.col("orderId").isNotNull() & F.col("timestamp").isNotNull()).alias("is_valid"),
        *(["json"] if keep_raw else []),
    )
    return out


def decode_views(df: DataFrame, value_col: str = "value", keep_raw: bool = False) -> DataFrame:
    d = _decode(df, schemas.VIEW_EVENT, value_col)
    return d.select(
        F.col("userId").alias("user_id"),
        F.col("productId").alias("product_id"),
        F.col("category"),
        F.col("timestamp"),
        (F.col("userId").isNotNull() & F.col("timestamp").isNotNull()).alias("is_valid"),
        *(["json"] if keep_raw else []),
    )


def decode_user_events(df: DataFrame, value_col: str = "value", keep_raw: bool = False) -> DataFrame:
    d = _decode(df, schemas.USER_EVENT, value_col)
    return d.select(
        F.col("eventType").alias("event_type"),
        F.col("userId").alias("user_id"),
        F.col("country"),
        F.col("device"),
        F.col("timestamp"),
        (F.col("userId").isNotNull() & F.col("timestamp").isNotNull()).alias("is_valid"),
        *(["json"] if keep_raw else []),
    )


def split_valid(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the flag, quarantined rows) -- T2."""
    valid = decoded.where(F.col("is_valid")).drop("is_valid", "json")
    bad = decoded.where(~F.col("is_valid")).drop("is_valid")
    return valid, bad


def tag(df: DataFrame, event_type: str) -> DataFrame:
    """Constant event-type column, keeping only what the funnel needs."""
    return df.select("user_id", "timestamp", F.lit(event_type).alias("event_type"))


# ---- encode (SNK8) ----------------------------------------------------------

def _epoch(c: str):
    return F.unix_micros(F.col(c)) / F.lit(1_000_000.0)


def encode_orders(orders: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """orders_raw rows -> (key = user id, value = JSON order event), and the
    columns in ``keep`` beside the event."""
    body = F.struct(
        F.lit("ORDER").alias("eventType"),
        F.col("order_id").alias("orderId"),
        F.col("user_id").alias("userId"),
        F.col("product_id").alias("productId"),
        F.col("price"),
        F.col("currency"),
        _epoch("timestamp").alias("timestamp"),
    )
    return orders.select(F.col("user_id").alias("key"), F.to_json(body).alias("value"), *keep)


def encode_views(views: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    body = F.struct(
        F.lit("VIEW").alias("eventType"),
        F.col("user_id").alias("userId"),
        F.col("product_id").alias("productId"),
        F.col("category"),
        _epoch("timestamp").alias("timestamp"),
    )
    return views.select(F.col("user_id").alias("key"), F.to_json(body).alias("value"), *keep)


def encode_user_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    body = F.struct(
        F.col("event_type").alias("eventType"),
        F.col("user_id").alias("userId"),
        F.col("country"),
        F.col("device"),
        _epoch("timestamp").alias("timestamp"),
    )
    return events.select(F.col("user_id").alias("key"), F.to_json(body).alias("value"), *keep)


def publish_kafka(encoded: DataFrame, servers: str, topic: str, partitions: int | None = None):
    """Batch publish of (key, value) rows; co-locates a user's events."""
    df = encoded.repartition(partitions, "key") if partitions else encoded
    (df.write.format("kafka")
       .option("kafka.bootstrap.servers", servers)
       .option("topic", topic)
       .save())


def write_json_lines(encoded: DataFrame, path: str, partition_col: str | None = None) -> None:
    """Publish to files instead of a broker: one JSON document per line."""
    w = encoded.write.mode("overwrite")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.format("text").save(path)
