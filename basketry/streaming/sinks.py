"""Streaming sinks built on ``foreachBatch`` (SNK1-SNK5, SNK7).

Every sink writes a versioned table (``versions.Table``): a batch is a folder of
its own, published with the next version.  A retried batch is skipped, a fresh
checkpoint over an old table starts a run whose rows come after the old ones,
folders fold level by level, and what no version lists is deleted in the end.

* :class:`OrdersSink`   one row per order id, the earliest copy (``ingest``);
* :class:`AppendSink`   all rows, deduped inside a batch;
* :class:`UpsertSink`   the newest row per key;
* :class:`DeltaSink`    sums of per-batch deltas per key;
* :class:`ReplaceSink`  the newest batch.

Readers (``read_*``) take the newest version; :func:`create_tables` describes the
same tables to SQL, as views that :func:`refresh_tables` moves to a new version in
one statement.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry import schemas
from basketry.streaming import versions
from basketry.streaming.ingest import OrdersTable
from basketry.streaming.versions import DeltaTable, Table


def write_batch(table: Table, df: DataFrame, batch_id: int, skip_empty: bool = True, info: dict | None = None) -> int | None:
    """Idempotent write of one micro-batch (SNK1/SNK5).

    The batch is persisted once so the emptiness check and the write do not
    recompute it (the reference counts, writes, counts and shows).
    """
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if skip_empty and df.isEmpty():
            return None
        table.add(df, batch_id, info=info)
        return batch_id
    finally:
        df.unpersist()


class AppendSink:
    """SNK1: append-only table; of rows that share ``keys`` inside a batch the
    first in the order of ``by`` (then of all columns) is kept."""

    def __init__(self, path: str, keys: Sequence[str] | None = None, by: str | None = None, **options):
        self.table, self.keys, self.by = Table(path, "append", **options), list(keys or []), by

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        if self.keys:
            rest = [c for c in df.columns if c not in self.keys]
            order = [c for c in rest if c == self.by] + [c for c in rest if c != self.by]
            first = df.groupBy(*self.keys).agg(F.min(F.struct(*order)).alias("_r"))
            df = first.select(*[F.col(c) if c in self.keys else F.col(f"_r.{c}").alias(c) for c in df.columns])
        write_batch(self.table, df, batch_id)


class OrdersSink:
    """Q01: the raw orders, duplicates settled while they arrive."""

    def __init__(self, path: str, key: str = "order_id", **options):
        self.table = OrdersTable(path, key, **options)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        self.table.ingest(df, batch_id)


class UpsertSink:
    """SNK2: keyed upsert of update-mode output (T5)."""

    def __init__(self, path: str, keys: Sequence[str], **options):
        self.table = Table(path, "latest", keys, **options)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        write_batch(self.table, df, batch_id)


class DeltaSink:
    """Per-batch additive deltas (ST9 pair counts), summed level by level."""

    def __init__(self, path: str, keys: Sequence[str], sums: Sequence[str], transform=None, **options):
        self.table, self.transform = DeltaTable(path, keys, sums, **options), transform

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        # the transform reads its input several times: hold the batch once
        df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            out = self.transform(df) if self.transform else df
            info = None
            if "window" in df.columns:
                end = df.agg(F.unix_micros(F.max("window.end"))).first()[0]
                if end is None:
                    return
                # windows without a pair close, too: their batch may be empty
                info = {"end": end}
            write_batch(self.table, out.select(*self.table.keys, *self.table.sums), batch_id, info is None, info)
        finally:
            df.unpersist()


class ReplaceSink:
    """SNK3: every batch replaces the whole table (complete-mode output); a crash
    in the middle of a write leaves the version before it in place."""

    def __init__(self, path: str, **options):
        self.table = Table(path, "replace", **options)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        write_batch(self.table, df, batch_id, skip_empty=False)


# -------------------------------------------------------------------- readers

def read_replaced(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The newest batch of a replaced table."""
    return Table(path, "replace").read(spark, schema=schema)


def read_orders(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The raw orders table: one row per order id, the earliest copy."""
    return OrdersTable(path).read(spark, schema=schema)


def read_appended(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    return Table(path, "append").read(spark, schema=schema)


def read_latest(spark: SparkSession, path: str, keys: Sequence[str], schema=None) -> DataFrame | None:
    """Latest row per key (the upserted table)."""
    return Table(path, "latest", keys).read(spark, schema=schema)


def read_summed(spark: SparkSession, path: str, keys: Sequence[str],
                sums: Sequence[str], schema=None) -> DataFrame | None:
    """Sums per key over all batches, and over the flushed open windows if any."""
    return DeltaTable(path, keys, sums).read(spark, schema=schema)


# ---------------------------------------------------------------------- tables

def sink_table(name: str, path: str) -> Table:
    """The table that the job of this output writes."""
    keys = schemas.TABLES[name][1]
    if name == "orders_raw":
        return OrdersTable(path)
    if name == "product_recommendations":
        return DeltaTable(path, keys, ["co_purchase_count"])
    return Table(path, "append" if name in schemas.APPENDED else "latest", keys)


def _view_sql(spark: SparkSession, name: str, path: str) -> str:
    schema = schemas.TABLES[name][0]
    table = sink_table(name, path)
    v = versions.version(spark, table.path)
    written = versions.schema_of(v) or schema
    stored = type(schema)([f for f in schema.fields if f.name in written.names])
    body = table.select_sql(v, stored)
    if name == "product_recommendations":
        # the score is the count; the table's last change is its newest version's
        body = ("SELECT product_id, recommended_product_id, CAST(co_purchase_count AS DOUBLE) AS score, "
                f"co_purchase_count, CAST({_changed(spark, table, v)} AS TIMESTAMP) AS last_updated FROM ({body})")
    return body


def _changed(spark: SparkSession, table: Table, v: versions.Version) -> str:
    if not v.number:
        return "NULL"
    p, fs = versions._fs(spark, f"{table.path}/versions/{v.number}.json")
    return f"timestamp_millis({fs.getFileStatus(p).getModificationTime()}L)"


def create_tables(spark: SparkSession, location: str, names: Sequence[str] | None = None) -> None:
    """SNK7: the output tables by name, from the one schema registry, as views of
    the newest versions under ``location``; empty where a sink has written nothing."""
    for name in names or schemas.TABLES:
        body = _view_sql(spark, name, f"{location.rstrip('/')}/{name}")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body}")


#: A view is replaced by one statement, so a reader sees one version or the next.
refresh_tables = create_tables


def drop_tables(spark: SparkSession, names: Sequence[str] | None = None) -> None:
    for name in names or schemas.TABLES:
        spark.sql(f"DROP VIEW IF EXISTS {name}")


class JdbcUpsertSink:
    """SNK2 against a database table with a primary key: staging + MERGE."""

    def __init__(self, url: str, table: str, keys: Sequence[str], properties: dict | None = None,
                 column_types: str | None = None):
        self.url, self.table, self.keys = url, table, list(keys)
        self.properties, self.column_types = properties or {}, column_types

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        from basketry.sources.jdbc import upsert
        df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not df.isEmpty():
                upsert(df, self.url, self.table, self.keys, batch_id,
                       properties=self.properties, column_types=self.column_types)
        finally:
            df.unpersist()
