"""Connected components and blockwise all-pairs work over groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import release
from basketry.session import checkpoint_root


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 50) -> DataFrame:
    """(node, component): the smallest node reachable, for all nodes of ``edges``.

    Alternating large-star and small-star: every node points its larger
    neighbours at its smallest one, then itself and its smaller neighbours, until
    only stars are left (a logarithmic number of rounds in practice).  Each
    star step is written to the shared checkpoint folder.  Hub nodes are pre-aggregated
    (``min``) and merge-joined back, which adaptive skew joins split.
    """
    checkpoint_root(edges.sparkSession)
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct().checkpoint()
    for _ in range(max_rounds):
        # u > v in every edge; each star is a small plan of its own, as the driver holds a plan many times over while it is adapted
        low = e.union(e.select("v", "u")).groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = e.join(low.hint("merge"), F.col("v") == F.col("k")).select("u", F.col("m").alias("v")).distinct().checkpoint()
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        # the smallest neighbour's own row stands for the node itself
        small = large.join(low.hint("merge"), F.col("u") == F.col("k")).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        e = small.distinct().checkpoint()
        ends = e.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("v", F.lit(0), F.lit(1)))
        loose = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = 1 AND down = 1").agg(F.count(F.lit(1))).first()[0]
        release(edges.sparkSession)
        if not loose:  # every node hangs on one node that hangs on none
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())


def block_pairs(members: DataFrame, group: str, item: str, block: int) -> DataFrame:
    """``members`` once per pair of blocks that its group needs, with columns lo, hi, mine.

    A group of m members is dealt by a hash into ceil(m / block) blocks; every
    pair of blocks is one unit of work, so all pairs of a group are compared in
    tasks of about 2 * block members, whatever the size of the group."""
    size = members.groupBy(group).agg(F.count(F.lit(1)).alias("_m")).select(F.col(group).alias("_g"), F.ceil(F.col("_m") / block).cast("int").alias("_n"))
    m = members.join(size, F.col(group) == F.col("_g")).drop("_g").withColumn("mine", F.pmod(F.xxhash64(item, F.lit(5)), F.col("_n")).cast("int"))
    m = m.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return m.withColumns({"lo": F.least("mine", "_other").cast("int"), "hi": F.greatest("mine", "_other").cast("int")}).drop("_other", "_n")
