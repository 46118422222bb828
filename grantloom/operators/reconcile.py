"""Reconcile reported income and refunds with the stored ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import money, text
from . import skew
from .dedup import last_per_key, last_value_map


def reconcile_income(
    reported: DataFrame,
    contracts: DataFrame,
    tolerance: str = S.TOLERANCE,
    order: Sequence[str] = (),
) -> DataFrame:
    """``(nro_sit, rendimento_financeiro_total_csv)`` of contracts whose income differs."""
    new = last_per_key(
        reported.select(
            text.clean_id(F.col("nro_sit")).alias("nro_sit"),
            F.col("rendimento_financeiro_total").alias("rendimento_financeiro_total_csv"),
            *order,
        ),
        ["nro_sit"],
        order,
    ).drop(*order)
    old = contracts.select(
        text.clean_id(F.col("nro_sit")).alias("nro_sit"),
        F.col("rendimento_financeiro_total").alias("rendimento_financeiro_total_sql"),
    )
    return (
        skew.lookup_join(old, new, ["nro_sit"], "inner")
        .filter(
            money.differs(
                F.col("rendimento_financeiro_total_csv"), F.col("rendimento_financeiro_total_sql"), tolerance
            )
        )
        .select("nro_sit", "rendimento_financeiro_total_csv")
    )


def translate_lines(
    reported: DataFrame, contracts: DataFrame, order: Sequence[str] = ()
) -> DataFrame:
    """Reported refunds keyed by the ledger's contract id; numbers it does not know are dropped."""
    ids = last_value_map(
        contracts.select(
            text.clean_id(F.col("nro_sit")).alias("nro_sit"),
            text.clean_id(F.col("id_termo")).alias("id_termo"),
        ),
        "nro_sit",
        "id_termo",
    )
    known = skew.lookup_join(
        reported.withColumn("nro_sit", text.clean_id(F.col("nro_sit"))), ids, ["nro_sit"], "inner"
    ).filter(F.col("id_termo").isNotNull())
    keyed = known.select(
        text.line_key(F.col("id_termo"), F.col("rubrica")).alias("id_termo_rubrica"), "valor_estornado", *order
    )
    return last_per_key(keyed, ["id_termo_rubrica"], order).drop(*order)


def reconcile_lines(
    reported: DataFrame,
    contracts: DataFrame,
    lines: DataFrame,
    tolerance: str = S.TOLERANCE,
    order: Sequence[str] = (),
) -> DataFrame:
    """``(id_termo_rubrica, valor_estornado)`` of budget lines whose refund differs."""
    new = translate_lines(reported, contracts, order)
    old = lines.select("id_termo_rubrica", F.col("valor_estornado").alias("__stored"))
    return (
        skew.lookup_join(old, new, ["id_termo_rubrica"], "inner")
        .filter(money.differs(F.col("valor_estornado"), F.col("__stored"), tolerance))
        .select("id_termo_rubrica", "valor_estornado")
    )
