"""Last row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keep the row with the greatest ``order`` for every key.

    An aggregate, not a window: each task reduces its copies of a key before the shuffle, so
    a key with very many copies never meets in one place. All other columns follow as final
    tie-breakers, which makes the choice repeatable.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    ranked = [*order, *[c for c in rest if c not in order]]
    latest = F.max(F.struct(*[F.col(c) for c in ranked])).alias("__last")
    return (
        df.groupBy(*keys)
        .agg(latest)
        .select(*[F.col(c) if c in keys else F.col("__last").getField(c).alias(c) for c in df.columns])
    )


def last_value_map(df: DataFrame, key: str, value: str, order: Sequence[str] = ()) -> DataFrame:
    """``(key, value)`` with the last value per key; rows without a key are dropped."""
    columns = list(dict.fromkeys([key, value, *order]))
    return last_per_key(df.filter(F.col(key).isNotNull()).select(*columns), [key], order).select(key, value)
