r"""Mixing sources to target weights (operator 4).

1. Sizes: words ``[^\x20\x09-\x0D]+`` of each text.  Each source is one stream
   of words, its documents ordered by (bucket, doc_id); a document's place in
   the stream is a prefix sum in its bucket plus the bucket's own prefix sum,
   so that a source with a third of all rows is summed by many tasks.
2. The stream is packed into blocks of ``BLOCK`` words (the last is shorter).
3. Targets: sources by code point, null last, weigh 3, 1, 2, repeating, and
   share 150 % of all words; no target exceeds twice its source.
4. Every output shard draws multinomial source counts from its own seed.  What
   the draws of a source exceed its slots by goes to the sources whose draws
   fell short, so every source fills exactly the slots of its target.
5. Slot i of a source is block p(i mod n) of epoch i div n, with p a
   pseudorandom permutation of the block indexes (Feistel network with cycle
   walking) of that source and epoch.  A target of at most twice the source
   takes at most two epochs, so no word is taken more than twice.  The last
   slot of a source is cut to the words still wanted.
6. Slots and blocks are joined by (source, block index).

Defined results: null text has size 0; an empty document is never taken; an
empty table gives no rows; repeated rows are documents of their own, ordered
by (doc_id, size, text hash); null doc_id sorts first.  Memory of the driver:
a few numbers per source.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import MIX, U64, lean, mix as mix_bits, table
from basketry.session import checkpoint_root

BLOCK = 64
SHARD_SLOTS = 8192
#: Slots that one task makes, about.
TASK_SLOTS = 250_000
#: Documents of one source that one task sums, about.
BUCKET_DOCS = 4_000
SHARE = 1.5
REPEATS = 2
WEIGHTS = (3, 1, 2)
SEED = 20


def targets(sizes: list[int], share: float = SHARE, repeats: int = REPEATS, weights=WEIGHTS) -> list[float]:
    """Target words per source; ``sizes`` in the order that the weights follow."""
    w = [weights[k % len(weights)] for k in range(len(sizes))]
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), share * sum(sizes)
    while open_:
        total = sum(w[k] for k in open_)
        over = [k for k in open_ if left * w[k] / total > repeats * sizes[k]]
        if not over:
            for k in open_:
                out[k] = left * w[k] / total
            break
        for k in over:
            out[k] = float(repeats * sizes[k])
        left -= sum(out[k] for k in over)
        open_ = [k for k in open_ if k not in set(over)]
    return out


def _round(half: np.ndarray, key: int, r: int) -> np.ndarray:
    return mix_bits(half ^ (U64((key * 8 + r + 1) & (2**64 - 1)) * np.full(1, MIX)))


def permute(i: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 (or its inverse), applied to ``i``."""
    bits = max(1, math.ceil(math.log2(max(n, 2)) / 2))
    mask, out = U64((1 << bits) - 1), np.asarray(i, np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        a, b = x >> U64(bits), x & mask
        for r in (range(3, -1, -1) if back else range(4)):
            if back:
                a, b = b ^ (_round(a, key, r) & mask), a
            else:
                a, b = b, a ^ (_round(b, key, r) & mask)
        x = (a << U64(bits)) | b
        out[todo] = x
        todo = todo[x >= U64(n)]
    return out.astype(np.int64)


@dataclass
class Plan:
    """What the mix takes of each source; lists in source order."""
    sources: list
    size: list[int]
    target: list[float]
    block: int
    seed: int

    def __post_init__(self):
        self.blocks = [-(-z // self.block) for z in self.size]
        self.slots, self.last = [], []
        for s, (z, t) in enumerate(zip(self.size, self.target, strict=True)):
            want = round(t)
            epoch, rest = divmod(want, z) if z else (0, 0)
            m, cut = 0, self.block
            if rest:
                n = self.blocks[s]
                short = self.block * n - z  # what the last block lacks
                at = int(permute(np.array([n - 1]), n, self.key(s, epoch), back=True)[0])
                words = lambda k: k * self.block - (short if at < k else 0)  # noqa: B023, E731
                m = min(n, rest // self.block)
                while words(m) < rest:
                    m += 1
                cut = rest - words(m - 1)
            self.slots.append(epoch * self.blocks[s] + m)
            self.last.append(cut)

    def key(self, source: int, epoch: int) -> int:
        return (self.seed * 1_000_003 + source) * 7 + epoch


@dataclass
class Mix:
    plan: Plan
    #: doc_id, source, row hash, size, s (source number), first (place in the source's stream)
    documents: DataFrame
    #: shard, slot, source number, first (of the document), doc_id, first_word, n_words
    spans: DataFrame


def _stream(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """doc_id, source, row hash, size and place of every document in its source's stream."""
    n = docs.count()
    buckets = max(1, -(-n // BUCKET_DOCS))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("row"),
                       F.size(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long").alias("size"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "row"), F.lit(buckets)))
    inside = Window.partitionBy("source", "bucket").orderBy("doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    checkpoint_root(docs.sparkSession)
    rows = rows.checkpoint()
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    over = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("source2"), F.col("bucket").alias("bucket2"), F.coalesce(F.sum("words").over(over), F.lit(0)).alias("offset"))
    return (rows.join(sums, F.col("source").eqNullSafe(F.col("source2")) & (F.col("bucket") == F.col("bucket2")))
            .select("doc_id", "source", "row", "size", (F.col("before") + F.col("offset")).alias("first")))


def _counts(plan: Plan, shard_slots: int):
    total = sum(plan.slots)
    p = np.array(plan.slots, float) / max(total, 1)

    def run(batches):
        for b in batches:
            k = b.column(0).to_numpy()
            c = [np.random.default_rng([plan.seed, int(x)]).multinomial(min(shard_slots, total - int(x) * shard_slots), p) for x in k]
            shard, s = np.nonzero(np.array(c)) if c else (np.zeros(0, int), np.zeros(0, int))
            yield pa.RecordBatch.from_arrays([pa.array(k[shard], pa.int64()), pa.array(s, pa.int32()),
                                              pa.array(np.array(c)[shard, s] if c else [], pa.int64())], ["shard", "s", "n"])
    return run


def _slots(plan: Plan, drawn: list[int]):
    """Blocks of every slot of a shard; surplus draws go to sources that fell short."""
    want, drawn = np.array(plan.slots, np.int64), np.array(drawn, np.int64)
    over, under = np.maximum(drawn - want, 0), np.maximum(want - drawn, 0)
    over_at, under_at = np.cumsum(over) - over, np.cumsum(under) - under
    blocks = np.array(plan.blocks, np.int64)

    def run(batches):
        for b in batches:
            for shard, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = sorted(rows, key=lambda r: r["s"])
                s = np.concatenate([np.full(r["n"], r["s"]) for r in rows])
                i = np.concatenate([np.arange(r["start"], r["start"] + r["n"]) for r in rows])
                more = np.flatnonzero(i >= want[s])
                u = over_at[s[more]] + i[more] - want[s[more]]
                to = np.searchsorted(under_at + under, u, "right")
                s[more], i[more] = to, drawn[to] + u - under_at[to]
                block = np.empty(len(i), np.int64)
                epoch = i // blocks[s]
                for x in np.unique(s * 8 + epoch):
                    on = s * 8 + epoch == x
                    k, e = int(x) // 8, int(x) % 8
                    block[on] = permute(i[on] - e * blocks[k], int(blocks[k]), plan.key(k, e))
                last = i == want[s] - 1
                take = np.where(last, np.array(plan.last, np.int64)[s], plan.block)
                slot = permute(np.arange(len(i)), len(i), plan.seed * 31 + shard)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), shard), pa.int64()), pa.array(slot), pa.array(s, pa.int32()), pa.array(block), pa.array(take)],
                                                 ["shard", "slot", "s", "block", "take"])
    return run


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", share: float = SHARE,
        block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> Mix:
    spark = docs.sparkSession
    rows = _stream(docs, doc_id, text, source)
    stats = rows.groupBy("source").agg(F.sum("size").alias("size")).collect()
    stats = sorted(stats, key=lambda r: (r.source is None, r.source or ""))
    sizes = [r["size"] for r in stats]
    plan = Plan([r.source for r in stats], sizes, targets(sizes, share), block, seed)
    numbers = spark.createDataFrame([(r.source, k) for k, r in enumerate(stats)], f"source2 {docs.schema[source].dataType.simpleString()}, s int")
    rows = rows.join(numbers, F.col("source").eqNullSafe(F.col("source2"))).drop("source2").checkpoint()
    shards = -(-sum(plan.slots) // shard_slots)
    counts = spark.range(shards).mapInArrow(lean(_counts(plan, shard_slots)), "shard long, s int, n long")
    drawn = [0] * len(stats)
    for r in counts.groupBy("s").agg(F.sum("n").alias("n")).collect():
        drawn[r.s] = r.n
    before = Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    slots = (counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
             .groupBy("shard").agg(F.collect_list(F.struct("s", "n", "start")).alias("rows"))
             .repartition(max(1, min(shards, -(-sum(plan.slots) // TASK_SLOTS))), "shard")  # few small rows make many slots
             .mapInArrow(lean(_slots(plan, drawn)), "shard long, slot long, s int, block long, take long"))
    pieces = (rows.where("size > 0")
              .select("s", "first", "doc_id", "size", F.explode(F.sequence(F.floor(F.col("first") / block), F.floor((F.col("first") + F.col("size") - 1) / block))).alias("block")))
    lo = F.greatest(F.col("first"), F.col("block") * block)
    hi = F.least(F.col("first") + F.col("size"), F.col("block") * block + F.col("take"))
    # slots come from a few rows by a Python map, so their size is underestimated: never broadcast them
    spans = (slots.hint("merge").join(pieces, ["s", "block"])
             .select("shard", "slot", "s", "first", "doc_id", (lo - F.col("first")).alias("first_word"), (hi - lo).alias("n_words"))
             .where("n_words > 0"))
    return Mix(plan, rows, spans)


def per_document(m: Mix) -> DataFrame:
    """doc_id, row hash, size, source_size, target, taken of every document."""
    spark = m.documents.sparkSession
    taken = m.spans.groupBy("s", "first").agg(F.sum("n_words").alias("taken"))
    goal = spark.createDataFrame([(k, z, t) for k, (z, t) in enumerate(zip(m.plan.size, m.plan.target, strict=True))], "s int, source_size long, target double")
    taken = taken.select("s", "first", F.lit(True).alias("_full"), "taken")
    d = m.documents.withColumn("_full", F.col("size") > 0)
    return (d.join(taken, ["s", "first", "_full"], "left").join(goal, "s")
            .select("doc_id", "row", "size", "source_size", "target", F.coalesce(F.col("taken"), F.lit(0)).alias("taken")))


def op4(spark, sf_dir: str) -> DataFrame:
    return per_document(mix(table(spark, sf_dir, "documents"))).drop("row")
