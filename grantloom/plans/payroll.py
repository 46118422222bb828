"""Payroll reports over the expense table.

Filters are written on bare columns, so contract, code and date conditions reach the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import money, text
from ..operators import skew
from ..operators.once import compute_once

_TEXT = "descricao_despesa"
_FOLDED = "__folded"
_DAY = "data_debito_convenio"


def _between(start: str, end: str, column: str = _DAY) -> Column:
    """Half-open date range."""
    return (F.col(column) >= F.lit(start).cast("date")) & (F.col(column) < F.lit(end).cast("date"))


def _folded(df: DataFrame) -> DataFrame:
    """Add the upper-case description, worked out once for all tests on it."""
    return compute_once(df, _FOLDED, F.upper(_TEXT))


def _of_contract(contract: str | None) -> Column:
    return F.lit(True) if contract is None else F.col("termo") == str(contract)


def month_spend(
    expenses: DataFrame,
    contract: str | None,
    start: str,
    end: str,
    codes: Sequence[str] = S.PERSONNEL_CODES,
    words: Sequence[str] = (S.CHARGES, S.SALARY_PAYMENT, S.VACATION),
) -> DataFrame:
    """Personnel spend in a date range as Brazilian money text, of one contract or of each."""
    personnel = F.col("rubrica").isin(*codes) | text.has_any(F.col(_FOLDED), words)
    return (
        _folded(expenses.filter(_of_contract(contract) & _between(start, end)))
        .filter(personnel)
        .groupBy("termo")
        .agg(F.sum("valor").alias("total"))
        .select("termo", money.format_brl(F.col("total")).alias("total_gasto_pessoal"))
    )


def month_detail(
    expenses: DataFrame,
    contract: str | None,
    start: str,
    end: str,
    codes: Sequence[str] = S.PERSONNEL_CODES,
) -> DataFrame:
    """The personnel expenses of one contract, or of all, in a date range."""
    return expenses.filter(_of_contract(contract) & F.col("rubrica").isin(*codes) & _between(start, end))


def spend_matrix(
    expenses: DataFrame,
    start: str,
    end: str,
    contracts: Sequence[str] | None = None,
    codes: Sequence[str] = S.PERSONNEL_CODES,
    jobs: Sequence[tuple[str, str]] = S.SPEND_JOBS,
    kinds: Sequence[tuple[str, str]] = S.SPEND_KINDS,
) -> DataFrame:
    """People and spend by contract, kind of payment and job; largest spend first in each kind.

    Rows without a known job form a group of their own. ``contracts=None`` takes all.
    """
    wanted = F.col("rubrica").isin(*codes) & _between(start, end)
    if contracts is not None:
        wanted = F.col("termo").isin(*[str(c) for c in contracts]) & wanted
    folded = F.col(_FOLDED)
    grouped = (
        _folded(expenses.filter(wanted))
        .filter(text.has_rule(folded, kinds))
        .select(
            "termo",
            text.first_rule(folded, kinds, None).alias("tipo_despesa"),
            text.first_rule(folded, jobs, None).alias("cargo"),
            "cpf_cnpj",
            "valor",
        )
        .groupBy("termo", "tipo_despesa", "cargo")
        .agg(F.countDistinct("cpf_cnpj").alias("qtd_funcionarios"), F.sum("valor").alias("total"))
    )
    return skew.sort_rows(
        grouped.withColumn("total_gasto", money.format_brl(F.col("total"))), "termo", "tipo_despesa", F.desc("total")
    ).drop("total")


def detail_rows(
    expenses: DataFrame,
    contract: str | None = None,
    line: str | None = None,
    containing: Sequence[str] = (),
    without: Sequence[str] = (),
) -> DataFrame:
    """Expenses of a contract or budget line whose description has and has not some words."""
    test = _of_contract(contract)
    if line is not None:
        test = test & (F.col("id_termo_rubrica") == line)
    words = F.lit(True)
    for word in containing:
        words = words & F.col(_FOLDED).contains(word)
    for word in without:
        words = words & ~F.col(_FOLDED).contains(word)
    return _folded(expenses.filter(test)).filter(words).drop(_FOLDED)


# --- fixed values: words each detail report looks for ---------------------------------
TERMINATION = "RESCISÃO"
INSS = "RECOLHIMENTO INSS"
INSS_13TH = "RECOLHIMENTO INSS - 13º SALÁRIO"
SALARY_13TH = "13º SALÁRIO"
IRRF = "RECOLHIMENTO IRRF"
FGTS = "REEMBOLSO RECOLHIMENTO FGTS"


def terminations(expenses: DataFrame, line: str | None = None) -> DataFrame:
    return detail_rows(expenses, line=line, containing=[TERMINATION])


def salaries(expenses: DataFrame, line: str | None = None) -> DataFrame:
    return detail_rows(expenses, line=line, containing=[S.SALARY_PAYMENT])


def inss_on_13th(expenses: DataFrame, line: str | None = None) -> DataFrame:
    return detail_rows(expenses, line=line, containing=[INSS_13TH])


def fgts_on_13th(expenses: DataFrame, contract: str | None = None) -> DataFrame:
    return detail_rows(expenses, contract=contract, containing=[SALARY_13TH])


def inss(expenses: DataFrame, line: str | None = None) -> DataFrame:
    return detail_rows(expenses, line=line, containing=[INSS], without=[INSS_13TH])


def irrf(expenses: DataFrame, line: str | None = None) -> DataFrame:
    return detail_rows(expenses, line=line, containing=[IRRF])


def fgts(expenses: DataFrame, contract: str | None = None) -> DataFrame:
    return detail_rows(expenses, contract=contract, containing=[FGTS], without=[SALARY_13TH])


def payee_search(expenses: DataFrame, word: str) -> DataFrame:
    """Expenses whose payee's name contains ``word``."""
    return expenses.filter(text.contains(F.col("favorecido"), word))


def vacations(expenses: DataFrame, jobs: Sequence[tuple[str, str]] = S.VACATION_JOBS) -> DataFrame:
    """Vacation days, start and end read out of the description, by payee and start."""
    folded = F.col(_FOLDED)
    rows = (
        _folded(expenses)
        .filter(folded.contains(S.VACATION) & text.has_rule(folded, jobs))
        .select(
            "favorecido",
            text.first_rule(folded, jobs, S.OTHER_JOB).alias("cargo"),
            text.days_phrase(F.col(_TEXT), folded).alias("dias_ferias"),
            text.date_after(folded, "GOZO DE ").alias("inicio_gozo"),
            text.date_after(folded, " A ").alias("fim_gozo"),
            "termo",
        )
    )
    return skew.sort_rows(rows, "favorecido", "inicio_gozo")


def instalments(expenses: DataFrame, jobs: Sequence[tuple[str, str]] = S.INSTALMENT_JOBS) -> DataFrame:
    """13th-salary instalments by contract, payee and instalment."""
    folded = F.col(_FOLDED)
    rows = (
        _folded(expenses)
        .filter(folded.contains("13") & text.has_rule(folded, S.INSTALMENTS) & text.has_rule(folded, jobs))
        .select(
            "favorecido",
            text.first_rule(folded, jobs, S.OTHER_JOB).alias("cargo"),
            text.first_rule(folded, S.INSTALMENTS, S.NO_INSTALMENT).alias("parcela"),
            "valor",
            "data_pagamento",
            "termo",
        )
    )
    return skew.sort_rows(rows, "termo", "favorecido", "parcela")


def line_history(expenses: DataFrame, line: str) -> DataFrame:
    """Expenses whose line key contains ``line``, by debit date."""
    return skew.sort_rows(expenses.filter(text.contains(F.col("id_termo_rubrica"), line)), _DAY)
