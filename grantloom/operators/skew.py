"""Many-to-one joins and rankings that survive one key holding a third of all rows.

There is one plan for every size of input, and building it runs no job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_HASH = "__key_hash"


def lookup_join(facts: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``facts`` to ``dim``, which holds at most one row per key.

    Adaptive execution splits the partition of a hot key only when both inputs are shuffled
    for the join itself. ``dim`` is mostly an aggregate on the same key and would be taken as
    it lies; a hash of the key as one more join key makes the planner deal out both sides
    anew. That moves one narrow row per key once more, and nothing else.
    """
    on = list(on)
    if how not in ("left", "inner"):
        raise ValueError(f"lookup_join supports left and inner joins, not {how}")
    key = F.xxhash64(*on)
    return facts.withColumn(_HASH, key).join(dim.withColumn(_HASH, key), [*on, _HASH], how).drop(_HASH)


def row_number_in_groups(
    df: DataFrame, group: Sequence[str], order: Sequence[str], bucket: Column, name: str
) -> DataFrame:
    """``row_number() over (partition by group order by order)`` as column ``name``.

    ``bucket`` must never decrease along ``order`` and should bound the rows that share a
    value (such as ``id div 100000`` of a unique id); a null order value gives a null bucket,
    which comes first as nulls do. Rows are numbered within their bucket, and a bucket starts
    after the rows of the buckets before it, so no task orders more than one bucket's rows.
    """
    group, piece = list(group), "__bucket"
    cut = df.withColumn(piece, bucket)
    before = Window.partitionBy(*group).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.groupBy(*group, piece)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            *[F.col(c).alias(f"__s_{c}") for c in [*group, piece]],
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"),
        )
    )
    inside = F.row_number().over(Window.partitionBy(*group, piece).orderBy(*[F.col(c) for c in order]))
    same = F.lit(True)
    for c in [*group, piece]:
        same = same & F.col(c).eqNullSafe(F.col(f"__s_{c}"))
    return (
        cut.withColumn(name, inside)
        .join(starts, same, "left")
        .withColumn(name, (F.col(name) + F.col("__start")).cast("int"))
        .select(*df.columns, name)
    )


def sort_rows(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Total order by ``keys``; ties are spread over the sort's partitions.

    Range partitioning sends all rows with equal sort keys to one task, so equal keys get a
    tie-breaker from the row and its input partition.
    """
    tie = "__tie"
    return (
        df.withColumn(tie, F.xxhash64(F.spark_partition_id(), *df.columns)).orderBy(*keys, F.col(tie)).drop(tie)
    )
