"""Quality classifier (operator 8): naive Bayes support vectors.

Features are indicators of byte n-grams (1 to 3, case kept) in hashed
buckets, and of n-grams (1 to 4) of the mark "this word equals the one before".
Each is scaled by its class log-count ratio; rows are scaled to unit
length; a linear hinge-loss model is fitted by dual coordinate descent and
interpolated with its mean weight.  A held-back part of the sample calibrates
the score (logistic in the margin).

The fit takes a bounded sample of the labelled rows (``TRAIN_ROWS``,
``TRAIN_BYTES``, drawn by a hash of the id); scoring is a narrow map over all
rows with a weight vector of ``2**BITS`` entries.

Defined results: null text counts as empty, an empty text has the score of no
feature (the bias alone); a doc_id labelled more than once takes the larger
label; without both labels in training every score is the share of label 1
(0.5 without labels); repeated rows each get a score; a text longer than a slice
is read in parts that overlap by what the longest feature spans.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import MIX, TOKEN_BYTES, U64, crc_mod, map_text, slices, table, text_buffer, text_parts, words

BITS = 17
ORDERS = (1, 2, 3)
#: Longest n-gram of repeated-word marks; they take the last buckets.
REPEATS = 4
#: Bounds of the fit: expected labelled rows and bytes of their text.
TRAIN_ROWS = 8_000
TRAIN_BYTES = 24_000_000
THRESHOLD = 0.3
C, EPOCHS, BETA, ALPHA = 1.0, 12, 0.25, 1.0
_BUCKETS: dict[int, np.ndarray] = {}


def _bucket(key: np.ndarray, order: int) -> np.ndarray:
    return ((key.astype(np.uint64) + U64(order << 26)) * MIX >> U64(64 - BITS)).astype(np.uint32)


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) pairs of a slice, sorted by row."""
    rows, keys = len(off) - 1, []
    row = np.repeat(np.arange(rows, dtype=np.uint32), np.diff(off)).astype(np.uint64) << U64(BITS)
    x = data.astype(np.uint32)
    for n in ORDERS:
        if len(x) < n:
            continue
        key = x[:len(x) - n + 1].copy()
        for j in range(1, n):
            key = (key << np.uint32(8)) | x[j:len(x) - n + 1 + j]
        if n <= 2:  # the bucket of every key of one or two bytes is looked up
            if n not in _BUCKETS:
                _BUCKETS[n] = _bucket(np.arange(1 << 8 * n), n)
            b = _BUCKETS[n][key]
        else:
            b = _bucket(key, n)
        same = row[:len(b)] == row[n - 1:]
        keys.append((row[:len(b)] | b)[same])
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, _, of, h = words(data, off, TOKEN_BYTES)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
    mark = again
    for n in range(1, REPEATS + 1):
        if not mark.any():
            break
        keys.append((of[mark].astype(np.uint64) << U64(BITS)) | U64((1 << BITS) - n))
        mark = again & np.concatenate(([False], mark[:-1]))
    k = np.concatenate(keys)
    k = k.astype(np.uint32) if rows <= 1 << (32 - BITS) else k
    k.sort()
    k = k[np.concatenate(([True], k[1:] != k[:-1]))] if len(k) else k
    k = k.astype(np.int64)
    return k >> BITS, k & ((1 << BITS) - 1)


def row_slices(arr, limit: int = 1_000_000):
    data, off = text_buffer(arr)
    for i, j in slices(off, limit):
        for a in range(i, j, 1 << (32 - BITS)):
            z = min(j, a + (1 << (32 - BITS)))
            yield a, z, data[off[a]:off[z]], off[a:z + 1] - off[a]


def long_features(data: np.ndarray, limit: int = 1_000_000) -> np.ndarray:
    """The features of one long text, part by part: a part starts some words and
    bytes early, so that every n-gram and every run of a repeated word lies in one."""
    found = np.zeros(1 << BITS, bool)
    early = 0
    for a, b in text_parts(data, limit=limit):
        part = data[early:b]
        found[features(part, np.array([0, len(part)]))[1]] = True
        start = words(part, np.array([0, len(part)]), TOKEN_BYTES)[0]
        back = early + int(start[-(REPEATS + 1)]) if len(start) > REPEATS else early
        early = max(0, min(back, b - max(ORDERS) + 1))
    return np.flatnonzero(found)


def row_features(arr, limit: int = 1_000_000):
    """(first row, end row, row of each feature, feature) of a string array."""
    for i, j, data, off in row_slices(arr, limit):
        if j == i + 1 and len(data) > limit:
            k = long_features(data, limit)
            yield i, j, np.zeros(len(k), np.int64), k
        else:
            yield i, j, *features(data, off)


class Model:
    def __init__(self, weights: np.ndarray, scale2: np.ndarray, bias: float, slope: float, shift: float):
        self.weights, self.scale2, self.bias, self.slope, self.shift = weights, scale2, bias, slope, shift

    def score(self, r: np.ndarray, k: np.ndarray, n: int) -> np.ndarray:
        """Scores of ``n`` rows from the (row, feature) pairs they have."""
        norm = np.sqrt(np.bincount(r, self.scale2[k], n))
        m = np.bincount(r, self.weights[k], n) / np.maximum(norm, 1e-12) + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * m + self.shift, -60, 60)))


def fit(rows: list[np.ndarray], y: np.ndarray, held: np.ndarray) -> Model:
    """``rows``: the buckets of each row; ``y``: 0/1; ``held``: rows that calibrate."""
    width = 1 << BITS
    share = float(y.mean()) if len(y) else 0.5
    flat = Model(np.zeros(width, np.float32), np.ones(width, np.float32), 0.0, 0.0, float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    train = np.flatnonzero(~held)
    if len(set(y[train].tolist())) < 2:
        train = np.arange(len(y))
    if len(set(y.tolist())) < 2:
        return flat
    # class log-count ratios of the indicators
    cnt = {c: np.full(width, ALPHA) for c in (0, 1)}
    for i in train:
        cnt[int(y[i])][rows[i]] += 1
    ratio = np.log((cnt[1] / cnt[1].sum()) / (cnt[0] / cnt[0].sum()))
    norm = [max(float(np.sqrt(np.square(ratio[rows[i]]).sum())), 1e-12) for i in range(len(rows))]
    vals = [ratio[rows[i]] / norm[i] for i in range(len(rows))]
    # dual coordinate descent, L1 hinge loss; the last weight is the bias
    w, bias, a = np.zeros(width), 0.0, np.zeros(len(rows))
    sign = np.where(y == 1, 1.0, -1.0)
    weight = {c: len(train) / (2.0 * max((y[train] == c).sum(), 1)) for c in (0, 1)}
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        worst = 0.0
        for i in order.permutation(train):
            g = sign[i] * (w[rows[i]] @ vals[i] + bias) - 1.0
            top = C * weight[int(y[i])]
            pg = min(g, 0.0) if a[i] <= 0 else max(g, 0.0) if a[i] >= top else g
            worst = max(worst, abs(pg))
            if abs(pg) > 1e-9:
                new = min(max(a[i] - g / 2.0, 0.0), top)  # unit rows and a bias of one: Q = 2
                step = (new - a[i]) * sign[i]
                a[i] = new
                w[rows[i]] += step * vals[i]
                bias += step
        if worst < 1e-3:
            break
    mean = np.abs(w).sum() / max(np.count_nonzero(w), 1)
    w = (1 - BETA) * mean * np.sign(w) + BETA * w if BETA < 1 else w
    weights = w * ratio
    m = Model(weights.astype(np.float32), np.square(ratio).astype(np.float32), bias, 1.0, 0.0)
    # logistic calibration by Newton steps on the held rows
    cal = np.flatnonzero(held)
    if len(set(y[cal].tolist())) < 2:
        cal = np.arange(len(y))
    x = np.array([w[rows[i]] @ vals[i] + bias for i in cal])
    n1, n0 = (y[cal] == 1).sum(), (y[cal] == 0).sum()
    t = np.where(y[cal] == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    b = np.array([1.0, 0.0])
    f = np.stack([x, np.ones(len(x))], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(f @ b, -50, 50)))
        h = (f * (p * (1 - p))[:, None]).T @ f + 1e-6 * np.eye(2)
        d = np.linalg.solve(h, f.T @ (t - p) - 1e-6 * b)
        b += d * min(1.0, 5.0 / max(np.abs(d).max(), 1e-12))
        if np.abs(d).max() < 1e-8:
            break
    m.slope, m.shift = float(b[0]), float(b[1])
    return m


def train(docs: DataFrame, labels: DataFrame, is_training: Column, label: str = "quality", doc_id: str = "doc_id",
          text: str = "text", train_rows: int = TRAIN_ROWS, train_bytes: int = TRAIN_BYTES) -> Model:
    """``is_training``: a condition on the label rows' id."""
    spark = docs.sparkSession
    lab = (labels.where(is_training & F.col(label).isNotNull() & F.col(doc_id).isNotNull())
           .groupBy(F.col(doc_id).alias("k")).agg(F.max(label).cast("int").alias("y"))
           .withColumn("h", F.abs(F.xxhash64(F.col("k").cast("string"), F.lit(8)))))
    top = 2.0**63 - 1024
    n = lab.count()
    share = min(1.0, train_rows / max(n, 1))
    texts = docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t"))
    for _ in range(2):  # at most train_rows rows are broadcast
        picked = texts.join(F.broadcast(lab.where(F.col("h") <= int(share * top))), "k")
        size = picked.agg(F.sum(F.octet_length("t"))).first()[0] or 0
        if size <= train_bytes * 1.2:
            break
        share *= train_bytes / size

    def sparse(batches):
        for b in batches:
            out = [None] * b.num_rows
            for i, j, r, k in row_features(b.column(0)):
                ends = np.searchsorted(r, np.arange(j - i + 1))
                k = k.astype("<u4")
                for q in range(j - i):
                    out[i + q] = k[ends[q]:ends[q + 1]].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), b.column(1), b.column(2)], ["f", "y", "h"])

    got = picked.select("t", "y", "h").mapInArrow(sparse, "f binary, y int, h long").toArrow()
    got = got.sort_by([("h", "ascending")])
    rows = [np.frombuffer(x.as_py(), "<u4") for x in got.column("f")]
    y, h = got.column("y").to_numpy(), got.column("h").to_numpy()
    return fit(rows, y, (h // 64) % 5 == 0)


FIELDS = [T.StructField("score", T.DoubleType())]


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all) plus score (0 to 1, higher: label 1)."""
    bc = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = bc.value
        return lambda arr: [pa.array(np.concatenate([m.score(r, k, j - i) for i, j, r, k in row_features(arr)] or [np.zeros(0)]), pa.float64())]

    return map_text(docs, text, docs.columns if keep is None else keep, FIELDS, make)


def op8(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels, crc_mod("doc_id", 5) != 0)
    r = score(docs, model, keep=["doc_id"])
    return r.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
                    F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
