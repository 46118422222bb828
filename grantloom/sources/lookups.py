"""Configuration lookups as frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from .. import settings as S


def contract_numbers(spark: SparkSession, pairs: Mapping[str, str] = S.CONTRACT_BY_SIT) -> DataFrame:
    """``(nro_sit, termo)``."""
    return spark.createDataFrame(list(pairs.items()), "nro_sit string, termo string")


def class_rules(spark: SparkSession, rules: Sequence[tuple[str, str]] = S.EXPENSE_CLASSES) -> DataFrame:
    """``(prioridade, chave, classe)`` in order of application."""
    rows = [(i, word, label) for i, (word, label) in enumerate(rules)]
    return spark.createDataFrame(rows, "prioridade int, chave string, classe string")
