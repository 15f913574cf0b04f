"""Distribution statistics: one-pass summary (A19), exact order statistics
(A20), orders by hour (B7).

Exact order statistics without a global sort or a driver collect:

1. histogram ``value -> n`` (one row per distinct value, map-side combined;
   a value held by a third of all rows is still one row);
2. range-partition the histogram into P ordered slices and tag each row with
   its slice id; checkpoint it so the slice assignment is fixed;
3. per-slice totals (P rows) -> prefix offsets -> the slice that holds each
   wanted rank;
4. range refinement: while such a range has more than ``RANK_BOUND`` distinct
   values, approximate quantiles cut it into ``RANK_CUTS`` sub-ranges, an exact
   count of each finds the one that holds the rank, and that one is the range of
   the next round (a distributed quickselect);
5. running counts inside the last ranges pick the value at each rank.

The driver sees counts of at most P slices and ``RANK_CUTS`` sub-ranges a wanted
rank; no task sorts more than ``RANK_BOUND`` values for a rank.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import checkpoint_root


def summary(df: DataFrame, col: str = "price", population: bool = True) -> DataFrame:
    """count, mean, min, max, stddev in one aggregate (A19; A11 vs A10)."""
    sd = F.stddev_pop(col) if population else F.stddev_samp(col)
    return df.agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(col).alias("mean"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
        sd.alias("stddev"),
    )


def _slices(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def ranked_histogram(df: DataFrame, col: str, slices: int | None = None) -> DataFrame:
    """(value, _n, _slice): one row per distinct value (nulls included, as one
    row), range-partitioned into ordered slices and checkpointed so the slice
    assignment is fixed for every later use."""
    checkpoint_root(df.sparkSession)  # reliable checkpoints need the shared folder
    p = slices or _slices(df)
    hist = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    return (hist.repartitionByRange(p, col)
                .withColumn("_slice", F.spark_partition_id())
                .checkpoint(eager=True))


#: Distinct values that one task may sort for a rank, and sub-ranges of a round.
RANK_BOUND = 100_000
RANK_CUTS = 64


@dataclass(frozen=True)
class _Range:
    """Values of slice ``slice`` above ``lo`` and up to ``hi`` (None: open)."""
    slice: int
    lo: object
    hi: object
    before: int      # rows below the range
    distinct: int

    def holds(self, col: str) -> Column:
        c = F.col("_slice") == self.slice
        if self.lo is not None:
            c &= F.col(col) > F.lit(self.lo)
        return c if self.hi is None else c & (F.col(col) <= F.lit(self.hi))


def _tagged(ranged: DataFrame, col: str, ranges: list[_Range]) -> DataFrame:
    """Rows of the ranges only, with the range's number; ranges never overlap."""
    tag = F.coalesce(*[F.when(r.holds(col), F.lit(i)) for i, r in enumerate(ranges)])
    return ranged.where(reduce(or_, (r.holds(col) for r in ranges))).withColumn("_range", tag)


def _sub_range(value: Column, cuts: list) -> Column:
    """Number of the cuts below ``value``: a balanced tree of comparisons."""
    def tree(a: int, b: int) -> Column:
        if a == b:
            return F.lit(a)
        m = (a + b) // 2
        return F.when(value <= F.lit(cuts[m]), tree(a, m)).otherwise(tree(m + 1, b))
    return tree(0, len(cuts))


def _refined(ranged: DataFrame, col: str, wide: dict[_Range, list[int]], cuts: int) -> dict[int, _Range]:
    """One round: the sub-range of each wide range that holds each rank."""
    ranges = list(wide)
    rows = _tagged(ranged, col, ranges)
    steps = [i / cuts for i in range(1, cuts)]
    found = {r["_range"]: r for r in rows.groupBy("_range").agg(
        F.percentile_approx(col, steps, 100 * cuts).alias("cuts"),
        F.max(col).alias("top")).collect()}
    # the range's greatest value is no cut: every sub-range is smaller than the range
    points = {i: sorted({c for c in r.cuts if c != r.top}) for i, r in found.items()}
    sub = F.coalesce(*[F.when(F.col("_range") == i, _sub_range(F.col(col), c)) for i, c in points.items()])
    counts = rows.groupBy("_range", sub.alias("_sub")).agg(
        F.sum("_n").alias("n"), F.count(F.lit(1)).alias("d")).collect()
    out = {}
    for i, r in enumerate(ranges):
        at = r.before
        for c in sorted((c for c in counts if c["_range"] == i), key=lambda c: c["_sub"]):
            cut, k = points[i], c["_sub"]
            part = _Range(r.slice, cut[k - 1] if k else r.lo, cut[k] if k < len(cut) else r.hi, at, c.d)
            out |= {rank: part for rank in wide[r] if at <= rank < at + c.n}
            at += c.n
    return out


def ranks_from_histogram(ranged: DataFrame, col: str, fractions: dict[str, tuple[int, int]],
                         bound: int | None = None, cuts: int | None = None) -> DataFrame:
    """Value at rank ``floor(n * num / den)`` for each name (see the module's
    steps 3-5).  Runs one small job a round; numbers, dates and timestamps."""
    bound, cuts = bound or RANK_BOUND, cuts or RANK_CUTS
    ranged = ranged.where(F.col(col).isNotNull())
    sizes = sorted(ranged.groupBy("_slice").agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("d")).collect())
    total = sum(s.n for s in sizes)
    wanted = {name: total * a // b for name, (a, b) in fractions.items()}
    where: dict[int, _Range] = {}
    at = 0
    for s in sizes:
        where |= {rank: _Range(s["_slice"], None, None, at, s.d) for rank in wanted.values() if at <= rank < at + s.n}
        at += s.n
    while True:
        wide: dict[_Range, list[int]] = {}
        for rank, r in where.items():
            if r.distinct > bound:
                wide.setdefault(r, []).append(rank)
        if not wide:
            break
        where |= _refined(ranged, col, wide, cuts)
    names = [(name, rank) for name, rank in wanted.items() if rank in where]
    if not names:
        return ranged.select(F.lit("").alias("name"), F.col(col).alias("value")).limit(0)
    ranges = list(dict.fromkeys(where[rank] for _, rank in names))
    of = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(rank).cast("long").alias("_rank"),
                            F.lit(where[rank].before).cast("long").alias("_start"),
                            F.lit(ranges.index(where[rank])).alias("_of")) for name, rank in names])
    inside = _tagged(ranged, col, ranges).withColumn("w", F.explode(F.filter(of, lambda x: x["_of"] == F.col("_range"))))
    inside = inside.select(col, "_n", "w.name", "w._rank", "w._start")
    wr = Window.partitionBy("name").orderBy(col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = inside.withColumn("_upto", F.col("_start") + F.sum("_n").over(wr))
    return (cum.where((F.col("_rank") < F.col("_upto")) &
                      (F.col("_rank") >= F.col("_upto") - F.col("_n")))
               .select("name", F.col(col).alias("value")))


def values_at_ranks(df: DataFrame, col: str, fractions: dict[str, tuple[int, int]],
                    slices: int | None = None, bound: int | None = None,
                    cuts: int | None = None) -> DataFrame:
    """Value at 0-based rank ``floor(n * num / den)`` of the ascending sort,
    one row per name in ``fractions`` (T11; nulls excluded; empty input -> no rows).
    """
    return ranks_from_histogram(ranked_histogram(df, col, slices), col, fractions, bound, cuts)


QUARTILES = {"p25": (1, 4), "p50": (1, 2), "p75": (3, 4)}


def summary_from_histogram(ranged: DataFrame, col: str) -> DataFrame:
    """A19 over the (value, count) histogram instead of the rows: count of
    all rows, and mean, min, max and population stddev of non-null values
    (two passes over the distinct values: mean, then squared deviations)."""
    nn = F.col(col).isNotNull()
    mean = ranged.select(F.try_divide(F.sum(F.when(nn, F.col(col) * F.col("_n"))),
                                      F.sum(F.when(nn, F.col("_n"))))).scalar()
    dev2 = F.when(nn, F.col("_n") * (F.col(col) - mean) * (F.col(col) - mean))
    return ranged.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("count"),
        mean.alias("mean"),
        F.min(col).alias("min"),
        F.max(col).alias("max"),
        F.sqrt(F.try_divide(F.sum(dev2), F.sum(F.when(nn, F.col("_n"))))).alias("stddev"))


def price_distribution(df: DataFrame, col: str = "price") -> DataFrame:
    """Summary plus the reference's quartile indices, one row; the
    input is read once (into the checkpointed histogram)."""
    ranged = ranked_histogram(df, col)
    q = ranks_from_histogram(ranged, col, QUARTILES)
    wide = q.agg(F.struct(*[F.max(F.when(F.col("name") == k, F.col("value"))).alias(k)
                            for k in QUARTILES])).scalar()          # one scalar subquery
    return summary_from_histogram(ranged, col).select(
        "*", *[wide.getField(k).alias(k) for k in QUARTILES])


def approx_quartiles(df: DataFrame, col: str = "price", accuracy: int = 10_000) -> DataFrame:
    """Named approximate variant (percentile_approx), for very large inputs."""
    return df.agg(F.percentile_approx(col, [0.25, 0.5, 0.75], accuracy).alias("q")).select(
        F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"))


def orders_by_hour(orders: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Orders per hour of day (session zone UTC, T12), ascending."""
    return (orders.groupBy(F.hour(ts).alias("hour"))
                  .agg(F.count(F.lit(1)).alias("order_count"))
                  .orderBy("hour"))
