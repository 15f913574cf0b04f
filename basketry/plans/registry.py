"""Registry of named queries: ``name -> (spark callable, oracle SQL)``.

Callables take ``(spark, sf_dir)`` and return a lazy DataFrame.  Floating
outputs are passed through :func:`finalize` (6-digit rounding of doubles)
and the oracle SQL rounds the same columns with ``ROUND(x, 6)``, because
summation order differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from basketry.functions.exprs import stable_round


@dataclass
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Entry] = {}


def finalize(df: DataFrame, digits: int = 6, cents: tuple[str, ...] = ()) -> DataFrame:
    """Round doubles to ``digits``; money totals named in ``cents`` to 2 digits
    (their magnitude makes summation-order noise exceed 1e-6)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            d = 2 if f.name in cents else digits
            cols.append(stable_round(f.name, d).alias(f.name))
        else:
            cols.append(df[f"`{f.name}`"])
    return df.select(*cols)


def register(name: str, sql: str | None = None, note: str = "", cents: tuple[str, ...] = ()):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finalize(fn(spark, sf_dir), cents=cents)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Entry(name, run, sql.strip() if sql else None, note)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # importing the modules fills REGISTRY
    from basketry.plans import (  # noqa: F401
        q_batch,
        q_kpis,
        q_quality,
        q_series,
        q_sparksql,
        q_stored,
        q_streaming,
        q_windows,
    )
    return REGISTRY
