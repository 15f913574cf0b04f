"""Raw orders, one row per order id, settled while they are ingested (Q01, ST13).

The table is append-only folders (``versions.Table``).  Each folder has a Bloom
filter of its ids beside it: rows (bucket, bits) of 4096 bytes, an id's bits all
in one bucket, so that a lookup reads one row an id.  A batch

1. keeps the earliest copy of each of its ids (``dedupe_orders``);
2. probes the filters of all folders (fewer than FAN a level) by (folder,
   bucket), and looks only possible repeats up, only in folders where they may be;
3. drops a row whose id is there with an earlier or equal copy, and notes
   (folder, id) of a stored copy that is later than the new one as dead;
4. publishes rows, filter and dead notes as one version.

So a reader takes the rows that are not noted as dead, with no aggregate over the
table; a fold applies the notes and builds the filter of the folded folder.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import config
from basketry.operators.kpis import dedupe_orders
from basketry.streaming import versions
from basketry.streaming.versions import FOLDER, SEQ, Folder, Table, Version

BUCKET_BITS = 32_768
BITS_PER_ID = 16
HASHES = 6
FILTER = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("bits", T.BinaryType())])


def _bucket(key: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(key), buckets)


def _places(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BUCKET_BITS)) for i in range(HASHES)]


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (place % 8).cast("int"))) != 0


def filter_of(ids: DataFrame, key: str, rows: int) -> tuple[DataFrame, int]:
    """(bucket, bits) of a Bloom filter for ``rows`` ids, and its bucket count."""
    buckets = max(1, -(-rows * BITS_PER_ID // BUCKET_BITS))
    bits = ids.select(_bucket(F.col(key), F.lit(buckets)).alias("bucket"), F.explode(F.array(*_places(F.col(key)))).alias("at"))
    return bits.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits")), buckets


class OrdersTable(Table):
    """``kind="append"`` with one row per ``key``; the earliest copy stands."""

    def __init__(self, path: str, key: str = "order_id", fan: int = config.FOLD_FAN, retain: float = config.RETAIN_SECONDS):
        super().__init__(path, "append", fan=fan, retain=retain)
        self.key = key

    # ---- lookups

    def possible(self, spark: SparkSession, v: Version, ids: DataFrame) -> DataFrame:
        """(key, folder) wherever a folder's filter holds the id."""
        filters = versions.frame(spark, self.path, [Folder(f.info["filter"], f.seq) for f in v.folders], FILTER, marks=True)
        sizes = F.array(*[F.struct(F.lit(f.info["filter"]).alias("filter"), F.lit(f.name).alias("folder"), F.lit(f.info["buckets"]).alias("n")) for f in v.folders])
        asked = ids.select(self.key, F.explode(sizes).alias("f")).select(self.key, "f.folder", F.col("f.filter").alias(FOLDER), _bucket(F.col(self.key), F.col("f.n")).alias("bucket"))
        found = asked.join(filters.drop(SEQ), [FOLDER, "bucket"])
        hit = F.lit(True)
        for place in _places(F.col(self.key)):
            hit = hit & _is_set(F.col("bits"), place)
        return found.where(hit).select(self.key, "folder")

    def dead(self, spark: SparkSession, v: Version) -> DataFrame | None:
        """(folder, key) of stored copies that an earlier one has replaced."""
        names = v.extra.get("dead", [])
        schema = T.StructType([T.StructField(FOLDER, T.StringType()), versions.schema_of(v)[self.key]] if names else [])
        return versions.frame(spark, self.path, [Folder(n, 0) for n in names], schema) if names else None

    def alive(self, spark: SparkSession, v: Version, folders: list[Folder]) -> DataFrame:
        rows = versions.frame(spark, self.path, folders, versions.schema_of(v), marks=True)
        dead = self.dead(spark, v)
        return rows if dead is None else rows.join(dead, [FOLDER, self.key], "left_anti")

    # ---- writing

    def ingest(self, batch_rows: DataFrame, batch: int, run: str | None = None) -> Version:
        spark = batch_rows.sparkSession
        run = run or versions.current_run(spark)
        v = versions.version(spark, self.path)
        if v.runs.get(run, -1) >= batch:
            return v
        held = []                            # persisted while the batch is written

        def hold(df: DataFrame) -> DataFrame:
            held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
            return df

        one = hold(dedupe_orders(batch_rows, self.key))
        try:
            if one.isEmpty():
                return v
            dead, new = [], one
            if v.folders:
                maybe = hold(self.possible(spark, v, one.select(self.key)))
                where = {r[0] for r in maybe.select("folder").distinct().collect()}     # at most the folders
                if where:
                    both = hold(self._settled(spark, v, one, maybe, [f for f in v.folders if f.name in where]))
                    new = both.select(*one.columns)
                    dead = self._note(both.where(F.col("_old").isNotNull()).select(F.col("_in").alias(FOLDER), self.key))
            return self._append(new, batch, run, dead)
        finally:
            for df in reversed(held):
                df.unpersist()

    def _settled(self, spark, v: Version, one: DataFrame, maybe: DataFrame, folders: list[Folder]) -> DataFrame:
        """Rows of the batch to keep, with the stored copy that each replaces, if any."""
        rest = [c for c in one.columns if c != self.key]
        order = ["timestamp", *(c for c in rest if c != "timestamp")]
        stored = self.alive(spark, v, folders).join(maybe.withColumnRenamed("folder", FOLDER), [FOLDER, self.key], "left_semi")
        there = stored.select(self.key, F.col(FOLDER).alias("_in"), F.struct(*order).alias("_old"))
        both = one.join(there, self.key, "left").withColumn("_new", F.struct(*order))
        earlier = F.col("_old").isNull() | (F.col("_new") < F.col("_old"))
        return both.where(earlier)

    def _note(self, replaced: DataFrame) -> list[str]:
        if replaced.isEmpty():
            return []
        name = versions.new_folder()
        versions.put(replaced, self.path, name)
        return [name]

    def _append(self, new: DataFrame, batch: int, run: str, dead: list[str]) -> Version:
        n = new.count()
        name, buckets = self._filter(new, n)
        return self.add(new, batch, run, {"rows": n, "filter": name, "buckets": buckets}, dead=dead, filters=[name])

    def _filter(self, rows: DataFrame, n: int) -> tuple[str, int]:
        bits, buckets = filter_of(rows, self.key, n)
        name = versions.new_folder()
        versions.put(bits, self.path, name)
        return name, buckets

    def merged(self, spark: SparkSession, v: Version, folders: list[Folder]):
        rows = self.alive(spark, v, folders).drop(SEQ, FOLDER)
        n = sum(f.info["rows"] for f in folders)
        name, buckets = self._filter(rows, n)
        dead, kept = self.dead(spark, v), []
        if dead is not None:
            kept = self._note(dead.where(~F.col(FOLDER).isin([f.name for f in folders])))
        filters = [x for x in v.extra["filters"] if x not in {f.info["filter"] for f in folders}] + [name]
        return rows, {"rows": n, "filter": name, "buckets": buckets}, v.extra | {"dead": kept, "filters": filters}

    # ---- reading

    def read(self, spark: SparkSession, number: int | None = None, schema: T.StructType | None = None) -> DataFrame | None:
        v = versions.version(spark, self.path, number)
        if v.schema is None:
            return None if schema is None else spark.createDataFrame([], schema)
        return self.alive(spark, v, v.folders).select(*[f.name for f in versions.schema_of(v)])

    def select_sql(self, v: Version, schema: T.StructType) -> str:
        names = v.extra.get("dead", [])
        if not names:
            return super().select_sql(v, schema)
        cols = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
        rows = " UNION ALL ".join(f"SELECT *, '{f.name}' AS {FOLDER} FROM parquet.`{self.path}/data/{f.name}`" for f in v.folders)
        dead = " UNION ALL ".join(f"SELECT * FROM parquet.`{self.path}/data/{n}`" for n in names)
        return f"SELECT {cols} FROM ({rows}) t LEFT ANTI JOIN ({dead}) d ON t.{FOLDER} = d.{FOLDER} AND t.`{self.key}` = d.`{self.key}`"
