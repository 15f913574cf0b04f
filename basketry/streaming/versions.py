"""Versioned sink tables: data folders plus a small file list per version.

    <table>/data/<folder>/part-*.parquet    written once, never rewritten
    <table>/versions/<n>.json               the folders of version n

A batch writes a folder of its own, then publishes the next version by renaming
a finished file to a name that does not exist yet; who loses that race reads the
new version and tries again.  So readers see whole batches, one version at a
time, and whatever a crash leaves behind is in no list.

* A version names the last batch of every run (one streaming checkpoint), so a
  retried batch is skipped, and a fresh checkpoint over an old table starts a
  new run whose rows come after all old ones: rows are ordered by ``seq``, which
  only grows, never by batch id.
* Folders form levels.  ``FAN`` folders of a level are folded into one of the
  next: every row is rewritten once per level, and a table of n batches is read
  from fewer than FAN * (log_FAN(n) + 1) folders.
* Folders that no version lists any more are deleted once they have been out of
  the list for ``retain`` seconds; version files older than that go, too.

The lists are small (levels times FAN names), so the driver may hold them.  The
store must not let a rename replace an existing file (HDFS, local disks).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import config

SEQ = "_seq"
FOLDER = "_folder"


@dataclass
class Folder:
    name: str
    seq: int
    level: int = 0
    run: str = ""
    info: dict = field(default_factory=dict)


@dataclass
class Version:
    number: int = 0
    schema: str | None = None
    runs: dict[str, int] = field(default_factory=dict)
    folders: list[Folder] = field(default_factory=list)
    extra: dict[str, list[str]] = field(default_factory=dict)     # side folders by kind
    gone: dict[str, float] = field(default_factory=dict)          # folder -> when it left the list
    notes: dict = field(default_factory=dict)                     # progress marks of the table's job

    def next(self, **change) -> Version:
        return replace(self, number=self.number + 1, **change)


# ------------------------------------------------------------------ file system

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def _numbers(spark: SparkSession, path: str) -> list[int]:
    p, fs = _fs(spark, f"{path}/versions")
    if not fs.exists(p):
        return []
    names = (f.getPath().getName() for f in fs.listStatus(p))
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    s = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(s, "UTF-8")
    finally:
        s.close()


def _publish(spark: SparkSession, path: str, text: str) -> bool:
    """Whether this call, and no other, made the file."""
    p, fs = _fs(spark, path)
    draft, _ = _fs(spark, f"{path}.{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.exists(p) and fs.rename(draft, p):
        return True
    fs.delete(draft, False)
    return False


def _delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


# --------------------------------------------------------------------- versions

def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """A published version of the table, the newest by default."""
    path = path.rstrip("/")
    numbers = _numbers(spark, path)
    if not numbers:
        return Version()
    number = numbers[-1] if number is None else number
    if number not in numbers:
        raise ValueError(f"{path} has no version {number} (any more)")
    d = json.loads(_read_text(spark, f"{path}/versions/{number}.json"))
    return Version(**d | {"folders": [Folder(**f) for f in d["folders"]]})


def change(spark: SparkSession, path: str, make: Callable[[Version], Version | None]) -> Version:
    """Publish ``make(newest version)``; again from the newest one where another
    writer was faster; nothing where it returns None."""
    while True:
        old = version(spark, path)
        new = make(old)
        if new is None:
            return old
        if _publish(spark, f"{path.rstrip('/')}/versions/{new.number}.json", json.dumps(asdict(new))):
            return new


def current_run(spark: SparkSession) -> str:
    """The streaming query whose batch is being written (its id stays with its
    checkpoint), else ``direct``."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def new_folder() -> str:
    return uuid.uuid4().hex


def put(df: DataFrame, path: str, name: str) -> None:
    df.write.parquet(f"{path.rstrip('/')}/data/{name}")


def frame(spark: SparkSession, path: str, folders: Sequence[Folder], schema: T.StructType,
          marks: bool = False) -> DataFrame:
    """Rows of these folders; ``marks`` adds each row's folder and its seq."""
    if not folders:
        out = spark.createDataFrame([], schema)
        return out.withColumns({FOLDER: F.lit(""), SEQ: F.lit(0).cast("long")}) if marks else out
    df = spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/data/{f.name}" for f in folders])
    if not marks:
        return df
    seqs = F.create_map(*[F.lit(x) for f in folders for x in (f.name, f.seq)])
    df = df.select("*", F.regexp_extract(F.col("_metadata.file_path"), "/data/([0-9a-f]+)/", 1).alias(FOLDER))
    return df.withColumn(SEQ, F.element_at(seqs, F.col(FOLDER)).cast("long"))


def schema_of(v: Version) -> T.StructType | None:
    return None if v.schema is None else T.StructType.fromJson(json.loads(v.schema))


# ----------------------------------------------------------------------- tables

class Table:
    """One versioned table.  ``kind`` says how its folders make rows:

    append    all rows;
    latest    the newest row per key (``keys``);
    sum       the sum of ``sums`` per key;
    replace   the newest folder.
    """

    def __init__(self, path: str, kind: str, keys: Sequence[str] = (), sums: Sequence[str] = (),
                 fan: int = config.FOLD_FAN, retain: float = config.RETAIN_SECONDS,
                 restart: str = "keep"):
        self.path, self.kind, self.keys, self.sums = path.rstrip("/"), kind, list(keys), list(sums)
        self.fan, self.retain, self.restart = max(2, fan), retain, restart

    # ---- writing

    def add(self, df: DataFrame, batch: int, run: str | None = None, info: dict | None = None,
            notes: dict | None = None, **extra: list[str]) -> Version:
        """One batch, once: a batch that its run has published is skipped.

        With ``restart="replace"`` the first batch of a new run empties the table
        (sums of a source that the new run reads again from its start)."""
        spark = df.sparkSession
        run = run or current_run(spark)
        before = version(spark, self.path)
        if before.runs.get(run, -1) >= batch:
            return before
        name = new_folder()
        put(df, self.path, name)

        def listed(v: Version) -> Version | None:
            if v.runs.get(run, -1) >= batch:
                return None
            drop = self.kind == "replace" or (self.restart == "replace" and v.runs and run not in v.runs)
            kept = [] if drop else v.folders
            gone = {f.name: time.time() for f in v.folders} if drop else {}
            more = {k: v.extra.get(k, []) + x for k, x in extra.items() if x}
            flushed = v.extra.get("open", [])           # counted again by this batch, or by the next flush
            gone |= dict.fromkeys(flushed, time.time())
            return v.next(schema=df.schema.json(), runs=v.runs | {run: batch}, gone=v.gone | gone,
                          folders=[*kept, Folder(name, v.number + 1, 0, run, info or {})],
                          extra={k: x for k, x in (v.extra | more).items() if k != "open"},
                          notes=v.notes | (notes or {}))

        out = change(spark, self.path, listed)
        return self.tidy(spark, out)

    def note(self, spark: SparkSession, **marks) -> Version:
        """Publish progress marks with the table's next version."""
        return change(spark, self.path, lambda v: None if v.notes | marks == v.notes else v.next(notes=v.notes | marks))

    def tidy(self, spark: SparkSession, v: Version) -> Version:
        """Fold full levels, then delete what has been out of the list for long."""
        while (full := self._full(v)) is not None:
            v = self._fold(spark, v, full)
        return self.expire(spark)

    def _full(self, v: Version) -> list[Folder] | None:
        by: dict[int, list[Folder]] = {}
        for f in v.folders:
            by.setdefault(f.level, []).append(f)
        # higher levels first: a fold adds to the level above
        return next((by[k] for k in sorted(by, reverse=True) if len(by[k]) >= self.fan), None)

    def merged(self, spark: SparkSession, v: Version, folders: list[Folder]) -> tuple[DataFrame, dict, dict]:
        """(rows of the folders as one folder, its info, side folders after the fold)."""
        rows = self._rows(frame(spark, self.path, folders, schema_of(v), marks=self.kind == "latest"))
        return rows, {}, v.extra

    def _fold(self, spark: SparkSession, v: Version, folders: list[Folder]) -> Version:
        name, names = new_folder(), {f.name for f in folders}
        rows, info, extra = self.merged(spark, v, folders)
        put(rows.coalesce(max(1, rows.rdd.getNumPartitions() // len(folders))) if self.kind == "append" else rows, self.path, name)
        one = Folder(name, max(f.seq for f in folders), folders[0].level + 1, "", info)

        def listed(w: Version) -> Version | None:
            if not names <= {f.name for f in w.folders}:
                return None                              # another writer has folded them
            kept = sorted([*(f for f in w.folders if f.name not in names), one], key=lambda f: f.seq)
            left = dict.fromkeys([*names, *(x for k, o in w.extra.items() for x in o if x not in extra.get(k, []) and x in v.extra.get(k, []))], time.time())
            after = {k: [x for x in w.extra.get(k, []) if x not in v.extra.get(k, [])] + extra.get(k, []) for k in w.extra.keys() | extra.keys()}
            return w.next(folders=kept, gone=w.gone | left, extra=after)

        return change(spark, self.path, listed)

    def expire(self, spark: SparkSession, retain: float | None = None) -> Version:
        """Delete folders that left the list more than ``retain`` seconds ago, and
        versions as old as that: who reads one of them has had this long."""
        limit = time.time() - (self.retain if retain is None else retain)
        new = version(spark, self.path)
        dead = [n for n, t in new.gone.items() if t <= limit]
        if dead:
            new = change(spark, self.path, lambda v: v.next(gone={n: t for n, t in v.gone.items() if n not in dead}))
        _, fs = _fs(spark, f"{self.path}/versions")
        for n in _numbers(spark, self.path):
            f, _ = _fs(spark, f"{self.path}/versions/{n}.json")
            if n < new.number and fs.getFileStatus(f).getModificationTime() / 1000 <= limit:
                _delete(spark, f"{self.path}/versions/{n}.json")
        for n in dead:
            _delete(spark, f"{self.path}/data/{n}")
        return new

    # ---- reading

    def _rows(self, df: DataFrame) -> DataFrame:
        cols = [c for c in df.columns if c not in (SEQ, FOLDER)]
        if self.kind == "latest":
            vals = [c for c in cols if c not in self.keys]
            top = df.groupBy(*self.keys).agg(F.max_by(F.struct(*vals), SEQ).alias("_v"))
            return top.select(*[F.col(c) if c in self.keys else F.col(f"_v.{c}").alias(c) for c in cols])
        if self.kind == "sum":
            return df.groupBy(*self.keys).agg(*[F.sum(c).cast(df.schema[c].dataType).alias(c) for c in self.sums])
        return df.select(*cols)

    def read(self, spark: SparkSession, number: int | None = None, schema: T.StructType | None = None) -> DataFrame | None:
        """The table at one version; None (or no rows of ``schema``) if it has none."""
        v = version(spark, self.path, number)
        if v.schema is None:
            return None if schema is None else spark.createDataFrame([], schema)
        return self._rows(frame(spark, self.path, v.folders, schema_of(v), marks=self.kind == "latest"))

    def select_sql(self, v: Version, schema: T.StructType) -> str:
        """The table at version ``v`` as SQL over its folders (for a view)."""
        names = [f"`{f.name}`" for f in schema.fields]
        typed = [f"CAST({n} AS {f.dataType.simpleString()}) AS {n}" for n, f in zip(names, schema.fields, strict=True)]
        if not v.folders:
            nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {n}" for n, f in zip(names, schema.fields, strict=True))
            return f"SELECT {nulls} WHERE false"
        rows = " UNION ALL ".join(f"SELECT *, {f.seq}L AS {SEQ} FROM parquet.`{self.path}/data/{f.name}`" for f in v.folders)
        if self.kind == "latest":
            vals = ", ".join(n for n, f in zip(names, schema.fields, strict=True) if f.name not in self.keys)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            rows = f"SELECT {keys}, _v.* FROM (SELECT {keys}, max_by(struct({vals}), {SEQ}) AS _v FROM ({rows}) GROUP BY {keys})"
        elif self.kind == "sum":
            keys = ", ".join(f"`{k}`" for k in self.keys)
            rows = f"SELECT {keys}, {', '.join(f'sum(`{c}`) AS `{c}`' for c in self.sums)} FROM ({rows}) GROUP BY {keys}"
        return f"SELECT {', '.join(typed)} FROM ({rows})"


class DeltaTable(Table):
    """``kind="sum"`` whose batches are closed windows, plus the windows that are
    still open: :meth:`flush` counts those from the raw rows and lists them apart,
    until the next batch of closed windows takes their place."""

    def __init__(self, path: str, keys: Sequence[str], sums: Sequence[str], **options):
        super().__init__(path, "sum", keys, sums, **options)

    def _open(self, spark: SparkSession, names: list[str], when: int | None = None) -> Version:
        def listed(v: Version) -> Version | None:
            if when is not None and self.closed_to(v) != when:
                return None
            old = dict.fromkeys(v.extra.get("open", []), time.time())
            return v.next(extra=v.extra | {"open": names}, gone=v.gone | old)
        return change(spark, self.path, listed)

    @staticmethod
    def closed_to(v: Version) -> int | None:
        """End (epoch microseconds) of the last closed window that was added."""
        ends = [f.info["end"] for f in v.folders if f.info.get("end") is not None]
        return max(ends) if ends else None

    def merged(self, spark: SparkSession, v: Version, folders: list[Folder]):
        rows, info, extra = super().merged(spark, v, folders)
        return rows, info | {"end": self.closed_to(replace(v, folders=folders))}, extra

    def flush(self, spark: SparkSession, count: Callable[[int | None], DataFrame]) -> Version:
        """``count(end)`` gives the sums of all windows that end after ``end``."""
        v = version(spark, self.path)
        end = self.closed_to(v)
        rows = count(end).select(*self.keys, *self.sums)
        name = new_folder()
        put(rows, self.path, name)
        if v.schema is None:
            change(spark, self.path, lambda w: w.next(schema=rows.schema.json()) if w.schema is None else None)
        return self._open(spark, [name], end)

    def read(self, spark: SparkSession, number: int | None = None, schema: T.StructType | None = None) -> DataFrame | None:
        v = version(spark, self.path, number)
        return super().read(spark, v.number or None, schema) if not v.extra.get("open") else self._rows(
            frame(spark, self.path, v.folders + [Folder(n, 0) for n in v.extra["open"]], schema_of(v)))

    def select_sql(self, v: Version, schema: T.StructType) -> str:
        return super().select_sql(replace(v, folders=v.folders + [Folder(n, 0) for n in v.extra.get("open", [])]), schema)
