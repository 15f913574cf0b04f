"""Co-purchase pairs: market-basket counts (B1) and windowed
recommendations (B2), plus the streaming pair deltas (ST9).

Both are an equi self-join on the basket key with the residual
``a.item < b.item``, after pre-aggregating each basket to one row per item:

* B1 weights a pair by ``n_a * n_b`` (order lines are a multiset) and adds the
  same-product term ``n (n - 1) / 2`` separately;
* B2 counts baskets (distinct items per (window, user)).

Skew: a basket key (one user) may hold a large share of all rows.  Every basket
is dealt by an item hash into ``ceil(size / block_items)`` blocks, one for
ordinary baskets, and each pair of blocks is a join key of its own.  So one join
key never yields more than about ``block_items ** 2`` pairs, whatever the size
of the basket; there is no cap and no switch.  The pair counts are partially
aggregated before the shuffle on (item_a, item_b).

The top pairs alone (:func:`top_basket_pairs`) need no table of all pairs: an item
is sent with the rest of its basket, as one row, to the task that sums its pairs,
where they stay; what leaves a task is its best k.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry import config
from basketry.session import checkpoint_root


def _materialize(df: DataFrame) -> DataFrame:
    """Write the pre-aggregated items once (reliable checkpoint in the shared
    ``spark.checkpoint.dir``): they feed the sizes, both join
    sides and the same-item term, and recomputing the upstream joins for
    each would multiply the scan.  Also cuts the lineage for recovery."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def _block_pairs(items: DataFrame, keys: list[str], item: str, weight: str | None,
                 block_items: int) -> DataFrame:
    """(item_a, item_b, w) for every item_a < item_b sharing a key."""
    sizes = items.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(block_items)).cast("int").alias("_k"))
    tagged = items.join(sizes, keys).withColumn("_mine", F.pmod(F.xxhash64(item), F.col("_k")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_other")
    w = (lambda: F.col(weight)) if weight else (lambda: F.lit(1))
    a = tagged.select(*keys, F.col(item).alias("item_a"), w().alias("_wa"), F.col("_mine").alias("_ba"), other)
    a = a.withColumnRenamed("_other", "_bb")
    b = tagged.select(*keys, F.col(item).alias("item_b"), w().alias("_wb"), F.col("_mine").alias("_bb"), other)
    b = b.withColumnRenamed("_other", "_ba")
    j = a.join(b, [*keys, "_ba", "_bb"]).where(F.col("item_a") < F.col("item_b"))
    return j.select("item_a", "item_b", (F.col("_wa") * F.col("_wb")).cast("long").alias("w"))


def basket_pairs(orders: DataFrame, user: str = "user_id", item: str = "product_id",
                 block_items: int = config.PAIR_BLOCK_ITEMS, materialize: bool = True) -> DataFrame:
    """B1: whole-history pair counts per user, duplicates kept.

    For products p != q: sum over users of n_p * n_q; for (p, p):
    n_p (n_p - 1) / 2.  Columns: product1 <= product2, co_occurrence_count.
    """
    counts = (orders.where(F.col(item).isNotNull())
                    .groupBy(user, item).agg(F.count(F.lit(1)).alias("_n")))
    if materialize:
        counts = _materialize(counts)
    cross = _block_pairs(counts, [user], item, "_n", block_items)
    same = counts.where(F.col("_n") > 1).select(
        F.col(item).alias("item_a"), F.col(item).alias("item_b"),
        (F.col("_n") * (F.col("_n") - 1) / 2).cast("long").alias("w"))
    return (cross.unionByName(same)
                 .groupBy("item_a", "item_b").agg(F.sum("w").alias("co_occurrence_count"))
                 .select(F.col("item_a").alias("product1"), F.col("item_b").alias("product2"),
                         "co_occurrence_count"))


def top_pairs(pairs: DataFrame, k: int = 10, count_col: str = "co_occurrence_count",
              a: str = "product1", b: str = "product2") -> DataFrame:
    """L2/L4: top k by count with a key tiebreak."""
    return pairs.orderBy(F.desc(count_col), F.asc(a), F.asc(b)).limit(k)


def _dealt_items(counts: DataFrame, item: str, block_items: int, max_blocks: int) -> tuple[DataFrame, int, int]:
    """(items, id bits, blocks).  One row per item, checkpointed: ``_id`` ascends
    with the item's name, ``_norm`` is the Euclidean norm of its counts over users,
    ``_self`` its pairs with itself; items of like norm share a block ``_blk``, the
    largest norms in the last one.  ``_code`` is the block followed by the id."""
    n = F.col("_n").cast("double")
    stats = counts.groupBy(item).agg(F.sqrt(F.sum(n * n)).alias("_norm"),
                                     (F.sum(F.col("_n") * (F.col("_n") - 1)) / 2).cast("long").alias("_self"))
    named = (stats.repartitionByRange(item).sortWithinPartitions(item)
                  .withColumn("_at", F.monotonically_increasing_id()).checkpoint())
    part, place = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    size = named.agg(F.count(F.lit(1)).alias("n"), F.max(part).alias("parts"), F.max(place).alias("most")).first()
    width = (size.most or 0).bit_length()
    bits = width + (size.parts or 0).bit_length()
    blocks = max(1, min(max_blocks, -(-size.n // block_items)))
    named = named.withColumn("_id", F.shiftleft(part, width).bitwiseOR(place)).drop("_at")
    items = (named.repartitionByRange(blocks, F.col("_norm"), F.col("_id"))
                  .withColumn("_blk", F.spark_partition_id())
                  .withColumn("_code", F.shiftleft(F.col("_blk").cast("long"), bits).bitwiseOR(F.col("_id"))).checkpoint())
    return items, bits, blocks


def _coded_baskets(rows: DataFrame, user: str, basket_items: int) -> DataFrame:
    """Baskets in pieces of about ``basket_items`` items, checkpointed: user, _mine
    (piece), _k (pieces of the basket), _codes (ascending) and _ns (their counts, null
    if all are 1)."""
    pieces = F.ceil(F.count(F.lit(1)).over(Window.partitionBy(user)) / F.lit(basket_items)).cast("int")
    rows = rows.withColumn("_k", pieces).withColumn("_mine", F.pmod(F.xxhash64("_code"), F.col("_k")).cast("int"))
    b = rows.groupBy(user, "_k", "_mine").agg(F.sort_array(F.collect_list(F.struct("_code", "_n"))).alias("_b"))
    ns = F.col("_b._n")
    return b.select(user, "_k", "_mine", F.col("_b._code").alias("_codes"), F.when(F.array_max(ns) > 1, ns).alias("_ns")).checkpoint()


def _best_pairs(baskets: DataFrame, user: str, bits: int, from_code: int, low: list[int] | None, parts: int,
                least: int, k: int) -> list:
    """The best k pairs (count, a, b) of items whose codes are ``from_code`` or more;
    with ``low`` only of items x and b >= low[block of x], where x has the lesser code.

    An item travels with the greater codes of its basket to one task, as one row, so
    a pair is counted where its item of lesser norm is: frequent items gather no rows."""
    bound = F.element_at(F.array(*[F.lit(x) for x in low]), (F.shiftright("_x", bits) + 1).cast("int")) if low else F.lit(0)
    size = F.size("_codes")
    # baskets of one piece: what follows the item in it
    start = F.col("_pos") + 2
    if low:
        start = F.greatest(start, size - F.size(F.filter("_codes", lambda c: c >= bound)) + 1)
    tail = lambda c: F.slice(c, F.col("_start"), size)
    one = (baskets.where((F.col("_k") == 1) & (size > 1)).select("_codes", "_ns", F.posexplode("_codes").alias("_pos", "_x"))
                  .where(F.col("_x") >= from_code).withColumn("_start", start).where(F.col("_start") <= size)
                  .select("_x", F.coalesce(F.get("_ns", F.col("_pos")), F.lit(1)).alias("_n"),
                          tail("_codes").alias("_codes"), tail("_ns").alias("_ns")))
    # others: every item against every piece, each pair of pieces a join key of its own
    more = baskets.where("_k > 1").withColumn("_ns", F.coalesce("_ns", F.array_repeat(F.lit(1).cast("long"), size)))
    other = F.explode(F.sequence(F.lit(0), F.col("_k") - 1))
    a = more.select(user, F.col("_mine").alias("_i"), other.alias("_j"), F.arrays_zip("_codes", "_ns").alias("_a"))
    b = more.select(user, other.alias("_i"), F.col("_mine").alias("_j"), F.arrays_zip("_codes", "_ns").alias("_b"))
    both = (a.join(b, [user, "_i", "_j"]).select(F.explode("_a").alias("_r"), "_b")
             .select(F.col("_r._codes").alias("_x"), F.col("_r._ns").alias("_n"), "_b").where(F.col("_x") >= from_code)
             .withColumn("_b", F.filter("_b", lambda r: (r["_codes"] > F.col("_x")) & (r["_codes"] >= bound)))
             .where(F.size("_b") > 0)
             .select("_x", "_n", F.col("_b._codes").alias("_codes"), F.col("_b._ns").alias("_ns")))
    sent = one.unionByName(both).repartition(parts, "_x")
    p = (sent.select("_x", "_n", "_ns", F.posexplode("_codes").alias("_pos", "_y"))
             .select("_x", "_y", (F.col("_n") * F.coalesce(F.get("_ns", F.col("_pos")), F.lit(1))).alias("w")))
    ids = [F.col(c).bitwiseAND(F.lit((1 << bits) - 1)) for c in ("_x", "_y")]
    c = p.groupBy("_x", "_y").agg(F.sum("w").alias("c")).where(F.col("c") >= least)
    c = c.select("c", F.least(*ids).alias("a"), F.greatest(*ids).alias("b")).orderBy(F.desc("c"), "a", "b").limit(k)
    return [(r.c, r.a, r.b) for r in c.collect()]


def top_basket_pairs(orders: DataFrame, k: int = 10, user: str = "user_id", item: str = "product_id",
                     block_items: int = config.TOP_BLOCK_ITEMS, max_blocks: int = 32,
                     basket_items: int = config.PAIR_BLOCK_ITEMS, task_pairs: int = config.TOP_TASK_PAIRS) -> DataFrame:
    """The first k rows of B1 by count, then by names, without a table of all pairs.

    Threshold algorithm: no count exceeds the product of the two items' norms.  The
    items of the largest norms give k exact counts; of all pairs only those are summed
    whose blocks' largest norms reach the k-th of these.  A pair is summed in one task,
    of about ``task_pairs`` pairs.  The driver holds k rows and ``max_blocks`` norms.
    A basket of d items is sent as d rows that hold d / 2 items on average."""
    counts = (orders.where(F.col(item).isNotNull() & F.col(user).isNotNull())
                    .groupBy(user, item).agg(F.count(F.lit(1)).alias("_n")))
    counts = _materialize(counts)
    items, bits, blocks = _dealt_items(counts, item, block_items, max_blocks)
    best = [(r["_self"], r["_id"], r["_id"]) for r in
            items.where("_self > 0").orderBy(F.desc("_self"), "_id").limit(k).collect()]
    top = {r["_blk"]: r["top"] for r in items.groupBy("_blk").agg(F.max("_norm").alias("top")).collect()}
    last = max(top, default=0)
    code = F.col("_code").cast("int" if bits + last.bit_length() < 32 else "long").alias("_code")
    baskets = _coded_baskets(counts.join(items.select(item, "_code"), item).select(user, code, "_n"), user, basket_items)
    # pairs of all items, and of the last block's: of several pieces at most that many
    hot = last << bits
    d, h = F.size("_codes").cast("double"), F.size(F.filter("_codes", lambda c: c >= hot)).cast("double")
    n = baskets.agg(*[F.sum(F.when(F.col("_k") == 1, x * (x - 1) / 2).otherwise(x * x * F.col("_k") / 2)).alias(c)
                      for c, x in (("all", d), ("hot", h))]).first()
    parts = lambda pairs: max(orders.sparkSession.sparkContext.defaultParallelism, math.ceil((pairs or 0) / task_pairs))
    rank = lambda rows: sorted(rows, key=lambda x: (-x[0], x[1], x[2]))[:k]
    least, low = best[-1][0] if len(best) == k else 0, None
    if last:
        first = rank(best + _best_pairs(baskets, user, bits, hot, None, parts(n["hot"]), least, k))
        least = first[-1][0] if len(first) == k else 0
    reach = [min((j for j in top if top[i] * top[j] * (1 + 1e-9) >= least), default=last + 1) if i in top else 0 for i in range(last + 1)]
    if any(reach):
        low = [j << bits for j in reach]
    best = rank(best + _best_pairs(baskets, user, bits, 0, low, parts(n["all"]), least, k))
    ids = sorted({x for _, a, b in best for x in (a, b)})
    names = {r["_id"]: r[item] for r in items.where(F.col("_id").isin(ids)).select("_id", item).collect()} if ids else {}
    kind = orders.schema[item].dataType.simpleString()
    return orders.sparkSession.createDataFrame([(names[a], names[b], int(c)) for c, a, b in best],
                                               f"product1 {kind}, product2 {kind}, co_occurrence_count long")


def window_baskets(orders: DataFrame, window: str = config.BASKET_WINDOW,
                   slide: str = config.BASKET_SLIDE) -> DataFrame:
    """Distinct (window, user, product) rows: the collect_set baskets of Q04
    in long form (no whole basket ever sits in one row)."""
    return (orders.where(F.col("product_id").isNotNull())
                  .select(F.window("timestamp", window, slide).alias("window"),
                          "user_id", "product_id")
                  .distinct())


def basket_pair_counts(baskets: DataFrame, block_items: int = config.PAIR_BLOCK_ITEMS,
                       materialize: bool = True) -> DataFrame:
    """(product_id, recommended_product_id, co_purchase_count) over baskets
    given as distinct (window, user_id, product_id) rows.  ``materialize=False``
    when the caller already holds the baskets persisted (a micro-batch)."""
    if materialize:
        baskets = _materialize(baskets)
    p = _block_pairs(baskets, ["window", "user_id"], "product_id", None, block_items)
    return (p.groupBy("item_a", "item_b").agg(F.sum("w").alias("co_purchase_count"))
             .select(F.col("item_a").alias("product_id"),
                     F.col("item_b").alias("recommended_product_id"),
                     "co_purchase_count"))


def recommendations(orders: DataFrame, window: str = config.BASKET_WINDOW,
                    slide: str = config.BASKET_SLIDE,
                    updated_at: dt.datetime | None = None, **skew) -> DataFrame:
    """B2 / Q04 batch form: pairs of products bought by the same user in the
    same sliding window, counted once per basket; score = count."""
    pc = basket_pair_counts(window_baskets(orders, window, slide), **skew)
    stamp = F.lit(updated_at).cast("timestamp") if updated_at else F.current_timestamp()
    return pc.select("product_id", "recommended_product_id",
                     F.col("co_purchase_count").cast("double").alias("score"),
                     "co_purchase_count", stamp.alias("last_updated"))
