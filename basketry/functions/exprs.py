"""Scalar expressions used across the operators.

Each helper returns a ``Column`` built only from ``pyspark.sql.functions``
so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry import config


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prefixed_id(prefix: str, c: str | Column) -> Column:
    """'u' + 42 -> 'u42' (ids of the fixture views)."""
    return F.concat(F.lit(prefix), _c(c).cast("string"))


def pick(values: Sequence[str], index: str | Column) -> Column:
    """values[index mod len(values)], 0-based."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(_c(index), F.lit(len(values))) + 1).cast("int"))


def segment(total: str | Column, ladder=None, default: str | None = None) -> Column:
    """CASE ladder with strict ``>`` thresholds."""
    ladder = ladder or config.SEGMENTS
    default = default or config.SEGMENT_DEFAULT
    expr = None
    for label, bound in ladder:
        cond = _c(total) > F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def order_bucket(n: str | Column, buckets=None, rest: str | None = None) -> Column:
    """CASE bucket on a count with inclusive BETWEEN ranges."""
    buckets = buckets or config.ORDER_BUCKETS
    rest = rest or config.ORDER_BUCKET_REST
    expr = None
    for label, lo, hi in buckets:
        cond = _c(n).between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(rest))


def bucket_rank(label: str | Column, buckets=None) -> Column:
    """Sort key for the bucket labels (L6): position in the ladder, rest last."""
    buckets = buckets or config.ORDER_BUCKETS
    expr = None
    for i, (lbl, _, _) in enumerate(buckets, start=1):
        cond = _c(label) == F.lit(lbl)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(len(buckets) + 1))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / NULLIF(den, 0) as double (X7, A18); null instead of an ANSI error."""
    return F.try_divide(_c(num).cast("double"), F.nullif(_c(den).cast("double"), F.lit(0.0)))


def round_half_up(c: str | Column, digits: int = 2) -> Column:
    """ROUND(x, d) as the reference's SQL does it."""
    return F.round(_c(c), digits)


def stable_round(c: str | Column, digits: int = 6) -> Column:
    """round(x * 10^d) / 10^d on doubles.

    Used only to make floating sums comparable across engines (summation order
    differs); it is the same arithmetic DuckDB's ROUND(double, d) performs.
    """
    m = float(10 ** digits)
    return F.round(_c(c).cast("double") * F.lit(m)) / F.lit(m)


def epoch_seconds(c: str | Column) -> Column:
    """Timestamp -> fractional epoch seconds."""
    return F.unix_micros(_c(c)) / F.lit(1_000_000.0)


def epoch_millis(c: str | Column) -> Column:
    """Timestamp -> epoch milliseconds, the RDD job's ``Long timestamp``."""
    return F.unix_millis(_c(c))


def seconds_between(later: str | Column, earlier: str | Column) -> Column:
    """EXTRACT(EPOCH FROM later - earlier) (X13); Spark has no EPOCH field."""
    return (F.unix_micros(_c(later)) - F.unix_micros(_c(earlier))) / F.lit(1_000_000.0)


def as_of_lit(as_of: dt.datetime | None = None) -> Column:
    return F.lit(as_of or config.AS_OF).cast("timestamp")


def lookback(ts: str | Column, interval: str, as_of: dt.datetime | None = None,
             inclusive: bool = False) -> Column:
    """``ts > as_of - INTERVAL`` (or ``>=``), the NOW() filters of T20."""
    bound = as_of_lit(as_of) - F.expr(f"INTERVAL {interval}")
    return _c(ts) >= bound if inclusive else _c(ts) > bound


def band(value: str | Column, steps: Sequence[tuple[float, str]], base: str = "ok") -> Column:
    """Threshold banding (X22): the label of the highest step whose lower
    bound the value reaches; ``base`` below the first step, null stays null."""
    expr = None
    for bound, label in sorted(steps, key=lambda s: -s[0]):
        cond = _c(value) >= F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = F.lit(base) if expr is None else expr.otherwise(F.lit(base))
    return F.when(_c(value).isNull(), F.lit(None).cast("string")).otherwise(expr)
