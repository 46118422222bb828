"""Schema and content checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text


class MissingColumns(ValueError):
    """A frame lacks required columns."""


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Return ``df``; raise with the sorted missing names otherwise. Looks at the schema only."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise MissingColumns(f"missing columns: {', '.join(missing)}")
    return df


def has_rows(df: DataFrame) -> bool:
    """Whether a step has anything to do; reads no more than one row."""
    return not df.isEmpty()


def optional(df: DataFrame, name: str, default: str | None = ""):
    """Column ``name``, or a literal when the frame does not have it."""
    return F.col(name) if name in df.columns else F.lit(default)


def first_spelling(df: DataFrame, names: Sequence[str]):
    """The first of several spellings of a header that the frame has, else null."""
    for name in names:
        if name in df.columns:
            return F.col(name)
    return F.lit(None).cast("string")


def union_files(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames that may each lack some columns."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def split_rejects(
    df: DataFrame,
    key: str = "id_codigo_sit",
    amounts: Sequence[str] = ("valor",),
    dates_: Sequence[str] = ("data_pagamento", "data_debito_convenio"),
) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` of staging rows that are still text.

    A row is rejected, with the reason, when it has no key, an amount that is no number or a
    date that cannot be read; blank dates are fine and become null. Good rows come back typed.
    """
    reasons = F.when(F.coalesce(text.strip(F.col(key)), F.lit("")) == "", F.lit("missing key"))
    for name in amounts:
        reasons = reasons.when(
            text.strip(F.col(name)).try_cast("decimal(18,2)").isNull(), F.lit(f"bad amount: {name}")
        )
    for name in dates_:
        written = text.blank_to_null(F.col(name))
        reasons = reasons.when(
            written.isNotNull() & dates.parse_day_first(written).isNull(), F.lit(f"bad date: {name}")
        )
    tagged = df.withColumn("reject_reason", reasons)
    good = tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    typed = good.withColumns(
        {
            **{name: text.strip(F.col(name)).try_cast("decimal(18,2)") for name in amounts},
            **{name: dates.parse_day_first(F.col(name)) for name in dates_},
        }
    )
    return typed, tagged.filter(F.col("reject_reason").isNotNull())
