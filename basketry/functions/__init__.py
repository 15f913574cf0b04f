"""Column-expression helpers (all built-in Spark expressions, no UDFs)."""

from basketry.functions.exprs import (  # noqa: F401
    band,
    epoch_millis,
    epoch_seconds,
    lookback,
    order_bucket,
    pick,
    prefixed_id,
    round_half_up,
    safe_ratio,
    segment,
    seconds_between,
    stable_round,
)
