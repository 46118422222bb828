"""Budget-line and contract balances: spend, balance, burn rate, runway, consumed income.

The refresh order is a data dependency: lines first, then contracts from the new lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import dates, money, text
from ..functions.dates import AsOf
from ..operators import skew

KEY = "id_termo_rubrica"
# the line key as the ledger compares it
_LINE = "__line"
BEFORE, REFRESHED = "saldo_anterior", "recalculada"


def line_metrics(
    lines: DataFrame, contracts: DataFrame, expenses: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """Spend, days left and burn rate per budget line of a known contract.

    Line keys are compared without regard to case, as the ledger does. A line goes by its stored
    spelling; two spellings of one line, which the ledger's unique key rules out, would each get
    all of its expenses. Expenses are summed per line before the join, so the large table is reduced in its own
    scan tasks and only one row per line is joined. A line stored several times counts its
    expenses as many times, as joining first would.
    """
    return _line_metrics(lines, contracts, expenses, as_of).drop(_LINE)


def _line_metrics(lines: DataFrame, contracts: DataFrame, expenses: DataFrame, as_of: AsOf) -> DataFrame:
    today, line = dates.as_of_date(as_of), text.fold_case(F.col(KEY)).alias(_LINE)
    spent = (
        expenses.filter(F.col(KEY).isNotNull())
        .groupBy(line)
        .agg(F.sum(money.money(F.col("valor"))).alias("__spent"), F.max("data_pagamento").alias("__last"))
    )
    # dealt out by the compared key, which serves the grouping by spelling and the join
    known = lines.select(KEY, line).repartition(_LINE).groupBy(_LINE, KEY).agg(F.count(F.lit(1)).alias("__copies"))
    terms = contracts.select(
        F.col("id_termo").alias("__contract"),
        F.col("data_inicio_vigencia").alias("__start"),
        F.col("data_fim_vigencia").alias("__end"),
    )
    # both sides are grouped by the line key, so this join needs no further shuffle
    keyed = known.join(spent, _LINE, "left").withColumn("__contract", text.contract_of(F.col(KEY)))
    # one contract may own very many lines
    joined = skew.lookup_join(keyed, terms, ["__contract"], "inner")
    total = F.coalesce(F.col("__spent") * F.col("__copies"), F.lit(0)).cast(money.WIDE)
    months = dates.month_boundaries(F.col("__start"), F.col("__last")) + F.lit(1)
    return joined.select(
        KEY,
        _LINE,
        today.alias("data_atual"),
        F.datediff(F.col("__end"), today).alias("dias_restantes"),
        total.alias("saldo_total_gasto"),
        money.quotient(total, months).alias("media_mensal_gastos"),
    )


def refresh_lines(
    lines: DataFrame, contracts: DataFrame, expenses: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """Budget lines with refreshed balance, percent spent, burn rate and runway.

    Lines of unknown contracts keep their stored values.
    """
    return refresh_lines_traced(lines, contracts, expenses, as_of).select(*lines.columns)


def line_change_log(
    lines: DataFrame, contracts: DataFrame, expenses: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """Balance before and after for every refreshed line, by line key."""
    return line_log(refresh_lines_traced(lines, contracts, expenses, as_of))


def line_log(traced: DataFrame) -> DataFrame:
    """The change log held in the result of ``refresh_lines_traced``."""
    return skew.sort_rows(
        traced.filter(F.col(REFRESHED)).select(
            F.lit(S.LINE_LOG_TITLE).alias("TIPO"),
            F.col(KEY).alias("Id"),
            F.col(BEFORE).alias("SaldoAntigo"),
            F.col("saldo_atual").alias("SaldoNovo"),
            F.col("dias_restantes").alias("DiasRestantes"),
        ),
        "Id",
    )


def refresh_lines_traced(
    lines: DataFrame, contracts: DataFrame, expenses: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """As ``refresh_lines``, with the balance before and whether the line was refreshed.

    Written once, it yields both the new lines and their change log.
    """
    metrics = line_metrics(lines, contracts, expenses, as_of)
    new = metrics.select(
        KEY, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__m_{c}") for c in metrics.columns if c != KEY]
    )
    joined = skew.lookup_join(lines, new, [KEY], "left").withColumn(BEFORE, F.col("saldo_atual"))

    planned, spend, burn = F.col("saldo_inicial_previsto"), F.col("__m_saldo_total_gasto"), F.col("__m_media_mensal_gastos")
    balance = (planned - spend + money.zero_if_null(F.col("valor_estornado"))).cast(money.WIDE)
    percent = F.when(planned > 0, money.format_percent(money.quotient(spend * F.lit(100), planned)))
    runway = F.when(burn > 0, (balance / F.nullif(burn, F.lit(0).cast(money.QUOTIENT))).cast(money.QUOTIENT))
    values = {
        "data_atual": F.col("__m_data_atual"),
        "dias_restantes": F.col("__m_dias_restantes"),
        "saldo_total_gasto": money.money(spend),
        "saldo_atual": money.money(balance),
        "executado": percent,
        "media_mensal_gastos": money.money(burn),
        "previsao_mensal_saldo": runway.try_cast("int"),
        "previsao_mensal_saldo_texto": money.runway_text(runway),
    }
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    out = [
        F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in lines.columns
    ]
    return joined.select(*out, BEFORE, hit.alias(REFRESHED))


def contract_metrics(lines: DataFrame, as_of: AsOf = None, compat_text_pct: bool = False) -> DataFrame:
    """Per contract: latest line end, days left, spend, balance and the income it has used.

    One grouping serves both the contract refresh and the consumed income.
    """
    today = dates.as_of_date(as_of)
    return (
        lines.withColumn("id_termo", text.contract_of(F.col(KEY)))
        .groupBy("id_termo")
        .agg(
            F.max("data_fim_vigencia").alias("data_fim_vigencia"),
            F.sum(money.zero_if_null(F.col("saldo_total_gasto"))).alias("saldo_total_gasto"),
            F.sum(money.zero_if_null(F.col("saldo_atual"))).alias("saldo_atual"),
            F.sum(_overdraw(compat_text_pct)).alias("valor_utilizado_rendimento"),
        )
        .select(
            "id_termo",
            "data_fim_vigencia",
            today.alias("data_atual"),
            F.datediff(F.col("data_fim_vigencia"), today).alias("dias_restantes"),
            money.money(F.col("saldo_total_gasto")).alias("saldo_total_gasto"),
            money.money(F.col("saldo_atual")).alias("saldo_atual"),
            money.money(F.col("valor_utilizado_rendimento")).alias("valor_utilizado_rendimento"),
        )
    )


def _overdraw(compat_text_pct: bool):
    over = (
        (F.col("saldo_atual") < 0)
        & (F.col("saldo_inicial_previsto") > 0)
        & (money.parse_percent(F.col("executado"), compat_text_pct) > 100)
    )
    return money.money(F.when(over, -F.col("saldo_atual")).otherwise(F.lit(0)))


def refresh_contracts(contracts: DataFrame, lines: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Contracts with refreshed spend, balance including income, and days left.

    Days left follow the contract's own end. Contracts without lines stay as they are.
    """
    return _with_metrics(contracts, lines, as_of, refresh=True, income=False).select(*contracts.columns)


def consumed_income(contracts: DataFrame, lines: DataFrame, compat_text_pct: bool = False) -> DataFrame:
    """Contracts with ``rendimento_financeiro_atual``: income less what overdrawn lines used."""
    return _with_metrics(contracts, lines, None, refresh=False, income=True, compat_text_pct=compat_text_pct).select(
        *contracts.columns
    )


def refresh_contract_balances(
    contracts: DataFrame, lines: DataFrame, as_of: AsOf = None, compat_text_pct: bool = False
) -> DataFrame:
    """``refresh_contracts`` and ``consumed_income`` in one pass over the lines."""
    return _with_metrics(
        contracts, lines, as_of, refresh=True, income=True, compat_text_pct=compat_text_pct
    ).select(*contracts.columns)


def contract_change_log(contracts: DataFrame, lines: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Days left before and after and the new balance of every refreshed contract, by id."""
    both = _with_metrics(contracts, lines, as_of, refresh=True, income=False).filter(F.col("__hit"))
    return skew.sort_rows(
        both.select(
            F.lit(S.CONTRACT_LOG_TITLE).alias("TIPO"),
            F.col("id_termo").alias("Id"),
            F.col("__days_before").alias("DiasAntigos"),
            F.col("dias_restantes").alias("DiasNovos"),
            F.col("saldo_atual").alias("SaldoNovo"),
        ),
        "Id",
    )


def _with_metrics(
    contracts: DataFrame,
    lines: DataFrame,
    as_of: AsOf,
    refresh: bool,
    income: bool,
    compat_text_pct: bool = False,
) -> DataFrame:
    metrics = contract_metrics(lines, as_of, compat_text_pct).filter(F.col("id_termo").isNotNull())
    new = metrics.select(
        "id_termo",
        F.lit(True).alias("__hit"),
        F.col("saldo_total_gasto").alias("__spent"),
        F.col("saldo_atual").alias("__balance"),
        F.col("valor_utilizado_rendimento").alias("__used"),
    )
    joined = contracts.join(new, "id_termo", "left").withColumn("__days_before", F.col("dias_restantes"))
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    today = dates.as_of_date(as_of)
    total_income = money.zero_if_null(F.col("rendimento_financeiro_total"))
    values = {}
    if refresh:
        values |= {
            "data_atual": F.when(hit, today).otherwise(F.col("data_atual")),
            "dias_restantes": F.when(hit, F.datediff(F.col("data_fim_vigencia"), today)).otherwise(
                F.col("dias_restantes")
            ),
            "saldo_total_gasto": F.when(hit, F.col("__spent")).otherwise(F.col("saldo_total_gasto")),
            "saldo_atual": F.when(hit, money.money(F.col("__balance") + total_income)).otherwise(
                F.col("saldo_atual")
            ),
        }
    if income:
        values["rendimento_financeiro_atual"] = money.money(total_income - money.zero_if_null(F.col("__used")))
    out = [values[c].alias(c) if c in values else F.col(c) for c in contracts.columns]
    return joined.select(*out, "__days_before", hit.alias("__hit"))
