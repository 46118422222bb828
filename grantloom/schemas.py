"""Explicit Spark schemas of every staging and stored table."""

from __future__ import annotations

from pyspark.sql import types as T

from . import settings as S

MONEY = T.DecimalType(18, 2)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


def all_strings(*names: str) -> T.StructType:
    """Staging text is read as strings first and cast by hand, never inferred."""
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


EXPENSES = T.StructType(
    [
        T.StructField(
            name,
            {"valor": MONEY, "data_pagamento": T.DateType(), "data_debito_convenio": T.DateType()}.get(
                name, T.StringType()
            ),
            True,
        )
        for name in S.EXPENSE_COLUMNS
    ]
)

EXPENSE_CHANGES = T.StructType(EXPENSES.fields + [T.StructField("acao", T.StringType(), True)])

CONTRACT_SUMMARY = _struct(nro_sit=T.StringType(), rendimento_financeiro_total=MONEY)

LINE_SUMMARY = _struct(
    nro_sit=T.StringType(),
    rubrica=T.StringType(),
    valor_estornado=MONEY,
    id_termo_rubrica=T.StringType(),
)

INCOME_UPDATES = _struct(nro_sit=T.StringType(), rendimento_financeiro_total_csv=MONEY)

REFUND_UPDATES = _struct(id_termo_rubrica=T.StringType(), valor_estornado=MONEY)

CONTRACTS = _struct(
    id_termo=T.IntegerType(),
    situacao_atual=T.StringType(),
    data_inicio_vigencia=T.DateType(),
    data_fim_vigencia=T.DateType(),
    valor_total_transferido=MONEY,
    data_atual=T.DateType(),
    dias_restantes=T.IntegerType(),
    saldo_total_gasto=MONEY,
    saldo_atual=MONEY,
    rendimento_financeiro_total=MONEY,
    rendimento_financeiro_atual=MONEY,
    nro_sit=T.IntegerType(),
)

LINES = _struct(
    id_termo_rubrica=T.StringType(),
    data_inicio_vigencia=T.DateType(),
    data_fim_vigencia=T.DateType(),
    saldo_inicial_previsto=MONEY,
    data_atual=T.DateType(),
    dias_restantes=T.IntegerType(),
    saldo_total_gasto=MONEY,
    saldo_atual=MONEY,
    media_mensal_gastos=MONEY,
    previsao_mensal_saldo=T.IntegerType(),
    previsao_mensal_saldo_texto=T.StringType(),
    termo=T.StringType(),
    descricao_rubrica=T.StringType(),
    valor_estornado=MONEY,
    executado=T.StringType(),
    nro_sit=T.IntegerType(),
)

PAYEE_EVENTS = _struct(
    termo=T.IntegerType(),
    favorecido=T.StringType(),
    cpf=T.StringType(),
    cargo=T.StringType(),
    tipo_evento=T.StringType(),
    data_evento=T.DateType(),
    valor_evento=MONEY,
)

SEATS = _struct(
    id_vaga=T.IntegerType(),
    termo=T.IntegerType(),
    cargo=T.StringType(),
    favorecido_atual=T.StringType(),
    data_inicio=T.DateType(),
    status_vaga=T.StringType(),
)
