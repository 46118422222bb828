"""Evaluate a costly expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df.withColumn(name, value)`` whose value is not copied into later filters.

    The optimizer moves filters below projections and merges projections, which repeats
    ``value`` at each use; a report that tests one description against twenty words would
    fold its case twenty times. Exploding a one-element array makes one row of one row, stays
    in generated code, and is a step the expression is not moved across. Filters on other
    columns still go down to the scan.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c != name]
    return df.select(*kept, F.explode(F.array(value)).alias(name))

