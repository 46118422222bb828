"""Extraction: raw workbook rows to clean expenses, reports to summaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import dates, money, text
from ..sources import reports, workbooks

OK, UNREADABLE = workbooks.OK, workbooks.UNREADABLE
NO_PAYMENT_DATE = "missing payment date"
UNKNOWN_CONTRACT = "unknown contract"
MISSING_COLUMN = "missing column"
#: Why a row of a usable workbook is not loaded; the first that fits, in this order.
NO_DATE, BAD_DATE, NO_CODE, NO_KEY = "no payment date", "bad payment date", "no line code", "no expense code"
REASONS = (NO_DATE, BAD_DATE, NO_CODE, NO_KEY)
REASON = "motivo"

MANDATORY = (S.H_TYPE, S.H_TAX_ID, S.H_PAYEE, S.H_DESCRIPTION)
PROVENANCE = ("source_file", "modified", "row_no")


def _contract(mapping: Mapping[str, str]) -> Column:
    """Contract id from the number in the file's name."""
    number = F.regexp_extract("source_file", r"Despesas_SIT_([^/]+?)\.xlsx$", 1)
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.try_element_at(table, number)


def file_verdict(mapping: Mapping[str, str] = S.CONTRACT_BY_SIT) -> Column:
    """Why a workbook is used or skipped."""
    lacks = F.lit(False)
    for header in MANDATORY:
        lacks = lacks | F.array_contains("absent", header)
    return (
        F.when(F.col("file_status") != OK, F.col("file_status"))
        .when(_contract(mapping).isNull(), F.lit(UNKNOWN_CONTRACT))
        .when(F.array_contains("absent", S.H_PAID_ON), F.lit(NO_PAYMENT_DATE))
        .when(lacks, F.lit(MISSING_COLUMN))
        .otherwise(F.lit(OK))
    )


def checked_expenses(raw: DataFrame, mapping: Mapping[str, str] = S.CONTRACT_BY_SIT) -> DataFrame:
    """Every row of the usable workbooks, cleaned, with its provenance and why it is not loaded.

    ``motivo`` is null for rows that can be loaded. Files with a verdict other than ``ok`` are
    accounted for as files (``workbook_summary``).
    """
    c = {h: F.col(f"`{h}`") for h in workbooks.HEADERS}
    first, second = S.H_DEBITED_ON
    debited = F.when(F.array_contains("absent", first), c[second]).otherwise(c[first])
    contract = _contract(mapping)
    code = text.line_code(c[S.H_TYPE])
    clean = raw.filter((F.col("row_no") > 0) & (file_verdict(mapping) == OK)).select(
        text.strip_or_blank(c[S.H_CODE]).alias("id_codigo_sit"),
        contract.alias("termo"),
        code.alias("rubrica"),
        text.expense_class(c[S.H_TYPE]).alias("tipo_despesa"),
        text.tax_id(c[S.H_TAX_ID]).alias("cpf_cnpj"),
        text.strip_or_blank(c[S.H_PAYEE]).alias("favorecido"),
        text.strip_or_blank(c[S.H_EXPENSE_DOC]).alias("tipo_doc_despesa"),
        text.strip_or_blank(c[S.H_DESCRIPTION]).alias("descricao_despesa"),
        text.strip_or_blank(c[S.H_PAYMENT_DOC]).alias("tipo_doc_pagamento"),
        dates.parse_day_first(c[S.H_PAID_ON]).alias("data_pagamento"),
        dates.parse_day_first(debited).alias("data_debito_convenio"),
        money.parse_amount(c[S.H_AMOUNT]).alias("valor"),
        text.line_key(contract, code).alias("id_termo_rubrica"),
        *PROVENANCE,
        text.blank_to_null(c[S.H_PAID_ON]).isNotNull().alias("__dated"),
    )
    reason = (
        F.when(F.col("data_pagamento").isNull(), F.when(F.col("__dated"), F.lit(BAD_DATE)).otherwise(F.lit(NO_DATE)))
        .when((F.coalesce(F.length("rubrica"), F.lit(0)) == 0) | (F.length("termo") == 0), F.lit(NO_CODE))
        .when(F.length("id_codigo_sit") == 0, F.lit(NO_KEY))
    )
    return clean.withColumn(REASON, reason).drop("__dated")


def consolidate_expenses(
    raw: DataFrame, mapping: Mapping[str, str] = S.CONTRACT_BY_SIT, provenance: bool = False
) -> DataFrame:
    """Clean expenses from decoded workbooks: the thirteen columns in their order.

    Rows without a payment date or a line code and files with a verdict other than ``ok``
    are left out; rows without a code of their own stay (see ``changes.split_keyless``). With
    ``provenance`` the file, its time and the row number are kept, which order repeated keys.
    """
    checked = checked_expenses(raw, mapping)
    kept = checked.filter(F.col(REASON).isNull() | (F.col(REASON) == NO_KEY))
    return kept.select(*S.EXPENSE_COLUMNS, *(PROVENANCE if provenance else ()))


def workbook_summary(raw: DataFrame, mapping: Mapping[str, str] = S.CONTRACT_BY_SIT) -> DataFrame:
    """``(status, arquivos, linhas)``: files and rows by verdict."""
    return (
        raw.groupBy(file_verdict(mapping).alias("status"))
        .agg(
            F.sum(F.when(F.col("row_no") == 0, 1).otherwise(0)).alias("arquivos"),
            F.sum(F.when(F.col("row_no") > 0, 1).otherwise(0)).alias("linhas"),
        )
    )


def missing_workbooks(raw: DataFrame, mapping: Mapping[str, str] = S.CONTRACT_BY_SIT) -> DataFrame:
    """``(nro_sit, termo)`` of configured contracts for which no workbook was found."""
    known = raw.sparkSession.createDataFrame(list(mapping.items()), "nro_sit string, termo string")
    seen = raw.filter(F.col("row_no") == 0).select(_contract(mapping).alias("termo")).distinct()
    return known.join(seen, "termo", "left_anti")


def report_summary(parsed: DataFrame) -> DataFrame:
    """``(status, arquivos)`` of parsed summary reports."""
    return reports.status_of(parsed).groupBy("status").agg(F.count(F.lit(1)).alias("arquivos"))
