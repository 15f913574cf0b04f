"""Helpers shared by the operators of this subpackage.

Arrow batches are handled as flat NumPy arrays: one byte buffer for all texts
of a slice plus row offsets.  A slice holds at most ``SLICE_BYTES`` of text
(or one row, if a single text is longer), which bounds the memory of a task
whatever the batch size is.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
import inspect
import os
import tempfile
import time
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 1_000_000

U64 = np.uint64
MIX = U64(0x9E3779B97F4A7C15)
MIX2 = U64(0xBF58476D1CE4E5B9)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(id_col: str | Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m`` (null id: null)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string").cast("binary")) % F.lit(m)


def free_name(taken, base: str) -> str:
    """``base``, with underscores appended until no column has that name."""
    low = {c.lower() for c in taken}
    while base.lower() in low:
        base += "_"
    return base


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- Arrow/NumPy

def text_buffer(arr) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null is empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("" if not pa.types.is_binary(arr.type) else b"")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, off, data = arr.buffers()
    o = np.frombuffer(off, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1]
    o = o.astype(np.int64)
    if data is None or not len(arr):
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[o[0]:o[-1]], o - o[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts sum to at most ``limit`` bytes (one row at least)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def text_slices(arr, limit: int = SLICE_BYTES):
    """(first row, end row, bytes, offsets) for each slice of a string array."""
    data, off = text_buffer(arr)
    for i, j in slices(off, limit):
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]


#: Bytes after which a long text may be cut: blanks and line ends.
BLANKS = np.zeros(256, bool)
BLANKS[[32, *range(9, 14)]] = True


def text_parts(data: np.ndarray, may_cut: np.ndarray = BLANKS, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, end) of the parts of one long text, in order: at most ``limit`` bytes
    each, cut after a byte of ``may_cut``, the next one if a part has none."""
    a, n = 0, len(data)
    while a < n:
        b = min(n, a + limit)
        if b < n:
            back = np.flatnonzero(may_cut[data[a:b]])
            if len(back):
                b = a + int(back[-1]) + 1
            else:
                while b < n and not may_cut[data[b]]:
                    step = np.flatnonzero(may_cut[data[b:b + limit]])
                    b = b + int(step[0]) if len(step) else min(n, b + limit)
                b = min(n, b + 1)
        yield a, b
        a = b


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every output bit depends on every input bit."""
    h = (h ^ (h >> U64(30))) * MIX2
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


#: Bytes of a word in the sense of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after A-Z
#: have become a-z; 0 elsewhere, else the lower-cased byte.
WORD_BYTES = np.zeros(256, np.uint8)
for _b in range(256):
    _c = _b + 32 if 65 <= _b <= 90 else _b
    if 48 <= _c <= 57 or 97 <= _c <= 122 or _c >= 128:
        WORD_BYTES[_b] = _c
#: The same for ``[^\x20\x09-\x0D]``; NUL bytes count as word bytes (as 32).
TOKEN_BYTES = np.zeros(256, np.uint8)
for _b in range(256):
    if not (_b == 32 or 9 <= _b <= 13):
        TOKEN_BYTES[_b] = _b + 32 if 65 <= _b <= 90 else (_b or 32)

_BASE = 0x2545F4914F6CDD1D | 1
_powers: list[np.ndarray] = []


def _pow_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        inv = pow(_BASE, -1, 1 << 64)
        tables = []
        for b in (_BASE, inv):
            t = np.full(size, U64(b), np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t))
        _powers[:] = tables
    return _powers[0], _powers[1]


def words(data: np.ndarray, off: np.ndarray, lut: np.ndarray = WORD_BYTES):
    """Words of the rows of a slice: (start, end, row, hash) arrays.

    Start and end are byte positions in ``data``; the hash is a mixed
    polynomial over the mapped bytes, modulo 2**64, equal for equal words.
    """
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64)
    m = lut[data]
    inw = m != 0
    first = np.zeros(n + 1, bool)
    first[off] = True
    start = np.flatnonzero(inw & (first[:n] | ~np.concatenate(([False], inw[:-1]))))
    end = np.flatnonzero(inw & (first[1:] | ~np.concatenate((inw[1:], [False])))) + 1
    power, inverse = _pow_tables(n + 1)
    pre = np.zeros(n + 1, np.uint64)
    np.cumsum(m.astype(np.uint64) * power[:n], out=pre[1:])
    h = mix((pre[end] - pre[start]) * inverse[start] + (end - start).astype(np.uint64) * MIX)
    row = np.searchsorted(off, start, "right") - 1
    return start, end, row, h


def grams(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` consecutive words of one row: (first, hash)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = np.zeros(n, np.uint64)
    for j in range(k):
        g = (g ^ h[j:j + n]) * MIX
        g ^= g >> U64(29)
    at = np.flatnonzero(row[:n] == row[k - 1:])
    return at, mix(g[at])


def sha_hex(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


# ------------------------------------------------------------ worker memory

def give_back() -> None:
    """Return a Python worker's free memory to the system: workers are reused, and
    what one task has freed would stay with the process for the next stage."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def lean(run: Callable) -> Callable:
    """``run`` for mapInArrow, giving memory back when its task ends."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped


def lean_group(f: Callable) -> Callable:
    """``f`` for applyInArrow (of one frame or two), giving memory back after each group."""
    def call(*args):
        try:
            return f(*args)
        finally:
            give_back()
    # Spark tells the kinds of functions apart by their parameters
    return {1: lambda t: call(t), 2: lambda key, t: call(key, t), 3: lambda key, a, b: call(key, a, b)}[len(inspect.signature(f).parameters)]


# --------------------------------------------------------------- Spark helpers

def map_text(df: DataFrame, text: str, keep: list[str], fields: list[T.StructField],
             make: Callable[[], Callable]) -> DataFrame:
    """Narrow map over Arrow batches: the ``keep`` columns plus new columns.

    ``make()`` runs once in each task and returns ``f(text array) -> list of
    pyarrow arrays``, one per field.  New columns whose name is taken get
    underscores appended.
    """
    cols = list(dict.fromkeys(keep))
    t = free_name(cols, "_text")
    out, names = [df.schema[c] for c in cols], list(cols)
    for f in fields:
        name = free_name(names, f.name)
        names.append(name)
        out.append(T.StructField(name, f.dataType))

    def run(batches):
        fn = make()
        for b in batches:
            new = fn(b.column(b.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(b.num_columns - 1)), *new], names)

    src = df.select(*(F.col(f"`{c}`") for c in cols), F.col(f"`{text}`").cast("string").alias(t))
    return src.mapInArrow(lean(run), T.StructType(out))


def release(spark: SparkSession) -> None:
    """Garbage collections in the driver now: what no DataFrame refers to any
    more (after a checkpoint: the shuffles it was made from) is then removed by
    Spark's context cleaner, instead of at some later collection."""
    for _ in range(2):  # the second finds what the first has let go of in Python
        gc.collect()
        time.sleep(0.3)
        spark.sparkContext._jvm.System.gc()


@contextlib.contextmanager
def short_shuffles(spark: SparkSession):
    """Of what is checkpointed inside, Spark deletes the shuffle files as soon as
    the checkpoint is written; else they stay until a garbage collection in the
    driver finds them, which a busy driver may do late."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors, once for each Spark application, so
    that their Python finds it wherever it is installed on the driver."""
    sc = spark.sparkContext
    if getattr(sc, "_basketry_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = os.path.join(tempfile.mkdtemp(prefix="basketry-ship-"), "basketry.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, names in os.walk(os.path.join(root, "basketry")):
            for n in sorted(names):
                if n.endswith(".py"):
                    z.write(os.path.join(d, n), os.path.relpath(os.path.join(d, n), root))
    sc.addPyFile(out)
    sc._basketry_shipped = True
