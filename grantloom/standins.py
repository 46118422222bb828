"""The ledger's tables derived from the driver's star-schema tables.

Every frame covers its whole source table, so the work of a query grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import settings as S
from .functions import money, text

AS_OF = "2001-08-01"
SEATS_AS_OF = "2001-07-20"
LOADED_BEFORE = "2001-01-01"

JOBS_BY_MONTH = (
    "AUXILIAR SERVIÇOS GERAIS",
    "CUIDADORA AUXILIAR",
    "CUIDADORA",
    "NUTRICIONISTA",
    "PSICÓLOGA",
    "ASSISTENTE SOCIAL",
    "COORDENADORA",
    "COZINHEIRA",
    "PROFESSORA NÃO REGENTE",
    "PROFESSORA REGENTE",
    "MOTORISTA",
    "ZELADOR",
)
JOBS_BY_PRIORITY = (
    ("1-URGENT", "CUIDADORA"),
    ("2-HIGH", "COZINHEIRA"),
    ("3-MEDIUM", "MOTORISTA"),
    ("4-NOT SPECIFIED", "NUTRICIONISTA"),
    ("5-LOW", "PSICÓLOGA"),
)


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _case(c: Column, pairs) -> Column:
    (key, value), *rest = pairs
    out = F.when(c == key, F.lit(value))
    for key, value in rest:
        out = out.when(c == key, F.lit(value))
    return out


def expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One expense per order; contract = customer, budget line = customer and priority."""
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey AS string) AS id_codigo_sit",
        "cast(o_custkey AS string) AS termo",
        "o_orderpriority AS rubrica",
        f"'{S.OTHER_CLASS}' AS tipo_despesa",
        "lpad(cast(o_custkey AS string), 11, '0') AS cpf_cnpj",
        "concat('PESSOA ', o_custkey) AS favorecido",
        "'' AS tipo_doc_despesa",
        "concat('PEDIDO ', o_orderstatus) AS descricao_despesa",
        "'' AS tipo_doc_pagamento",
        "cast(o_orderdate AS date) AS data_pagamento",
        "cast(o_orderdate AS date) AS data_debito_convenio",
        "cast(o_totalprice AS decimal(18,2)) AS valor",
        "concat(o_custkey, '-', o_orderpriority) AS id_termo_rubrica",
    )


def paid_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expenses of orders no longer pending; those of open orders spell their line in lower case."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")
    line = text.line_key(F.col("o_custkey"), F.col("o_orderpriority"))
    return orders.select(
        F.when(F.col("o_orderstatus") == "O", F.lower(line)).otherwise(line).alias("id_termo_rubrica"),
        F.col("o_orderdate").cast("date").alias("data_pagamento"),
        money.money(F.col("o_totalprice")).alias("valor"),
    )


def stored_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as of an earlier load.

    Later orders are missing, pending amounts and some descriptions have since been revised, and
    one order in fifty has a second expense that is in no workbook.
    """
    kept = expenses(spark, sf_dir).filter(F.col("data_pagamento") < F.lit(LOADED_BEFORE).cast("date"))
    pending, high = F.col("descricao_despesa") == "PEDIDO P", F.col("rubrica") == "2-HIGH"
    revised = kept.withColumns(
        {
            "valor": money.money(F.when(pending, F.col("valor") + F.lit(1)).otherwise(F.col("valor"))),
            "descricao_despesa": F.when(high, F.lit("PEDIDO ANTIGO")).otherwise(F.col("descricao_despesa")),
        }
    )
    key, line = F.col("id_codigo_sit"), F.concat(F.lit("X-"), F.col("rubrica"))
    alone = revised.filter(key.cast("bigint") % 50 == 0).withColumns(
        {"id_codigo_sit": F.concat(F.lit("X"), key), "termo": F.lit("X"), "id_termo_rubrica": line}
    )
    return revised.unionByName(alone).withColumn("tipo_doc_despesa", F.lit(None).cast("string"))


def repeated_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expenses of two workbooks, ``vez`` 1 and 2; the second brings one order in seven again, two dearer."""
    first = expenses(spark, sf_dir)
    again = first.filter(F.col("id_codigo_sit").cast("bigint") % 7 == 0).withColumn("valor", money.money(F.col("valor") + F.lit(2)))
    return first.withColumn("vez", F.lit(1)).unionByName(again.withColumn("vez", F.lit(2)))


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contract per customer."""
    income = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    none = F.lit(None)
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("id_termo"),
        F.col("c_mktsegment").alias("situacao_atual"),
        F.add_months(F.lit("1994-06-15").cast("date"), F.col("c_nationkey")).alias("data_inicio_vigencia"),
        F.add_months(F.lit("2001-06-15").cast("date"), F.col("c_nationkey")).alias("data_fim_vigencia"),
        none.cast(money.MONEY).alias("valor_total_transferido"),
        none.cast("date").alias("data_atual"),
        F.lit(999).alias("dias_restantes"),
        none.cast(money.MONEY).alias("saldo_total_gasto"),
        none.cast(money.MONEY).alias("saldo_atual"),
        money.money(income).alias("rendimento_financeiro_total"),
        none.cast(money.MONEY).alias("rendimento_financeiro_atual"),
        (F.col("c_custkey") + F.lit(50000)).cast("int").alias("nro_sit"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One budget line per customer and priority; the plan depends on the priority."""
    priority, none = F.col("o_orderpriority"), F.lit(None)
    high, low = F.col("high"), F.col("low")
    planned = (
        F.when(priority == "1-URGENT", high * 2)
        .when(priority == "2-HIGH", high)
        .when(priority == "3-MEDIUM", low)
        .when(priority == "4-NOT SPECIFIED", F.lit(0))
        .otherwise(high * F.lit("0.05").cast("decimal(3,2)"))
    )
    refund = F.when(priority != "3-MEDIUM", low * F.lit("0.01").cast("decimal(3,2)"))
    price = money.money(F.col("o_totalprice"))
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", "o_orderpriority")
        .agg(F.max(price).alias("high"), F.min(price).alias("low"), F.max("o_orderdate").alias("last"))
        .select(
            text.line_key(F.col("o_custkey"), priority).alias("id_termo_rubrica"),
            none.cast("date").alias("data_inicio_vigencia"),
            F.col("last").cast("date").alias("data_fim_vigencia"),
            money.money(planned).alias("saldo_inicial_previsto"),
            none.cast("date").alias("data_atual"),
            none.cast("int").alias("dias_restantes"),
            none.cast(money.MONEY).alias("saldo_total_gasto"),
            money.money(low).alias("saldo_atual"),
            none.cast(money.MONEY).alias("media_mensal_gastos"),
            none.cast("int").alias("previsao_mensal_saldo"),
            none.cast("string").alias("previsao_mensal_saldo_texto"),
            F.col("o_custkey").cast("string").alias("termo"),
            priority.alias("descricao_rubrica"),
            money.money(refund).alias("valor_estornado"),
            none.cast("string").alias("executado"),
            (F.col("o_custkey") + F.lit(50000)).cast("int").alias("nro_sit"),
        )
    )


def payroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payroll expense per order line; contract = supplier, person = part."""
    number, status, day = F.col("l_linenumber"), F.col("l_linestatus"), F.col("l_shipdate").cast("date")
    job = F.element_at(F.array(*[F.lit(j) for j in JOBS_BY_MONTH]), F.month(day))
    kind = (
        F.when((number == 1) & (status == "F"), F.lit("RESCISÃO"))
        .when(number == 1, F.lit("PAGAMENTO SALÁRIO"))
        .when(number == 3, F.lit("REEMBOLSO RECOLHIMENTO FGTS"))
        .when((number == 4) & (status == "F"), F.lit("RECOLHIMENTO IRRF"))
        .when(number == 4, F.lit("RECOLHIMENTO INSS"))
        .when(number == 5, F.lit("RECOLHIMENTO INSS - 13º SALÁRIO"))
        .when(number == 6, F.lit("13º SALÁRIO 1ª PARCELA"))
        .otherwise(F.lit("13º SALÁRIO 2ª PARCELA"))
    )
    days = F.col("l_quantity").cast("int")
    period = F.concat(
        F.lit(" - "),
        days.cast("string"),
        F.lit(" DIAS GOZO DE "),
        F.date_format(day, "dd/MM/yy"),
        F.lit(" A "),
        F.date_format(F.date_add(day, days), "dd/MM/yy"),
    )
    vacation = F.concat(F.lit("FÉRIAS "), job, F.when(status == "O", period).otherwise(F.lit("")))
    description = F.when(number == 2, vacation).otherwise(F.concat(kind, F.lit(" "), job))
    code = (
        F.when(F.col("l_returnflag") == "A", F.lit("3.1.90.11.99"))
        .when(F.col("l_returnflag") == "N", F.lit("3.1.90.13.99"))
        .otherwise(F.lit("3.3.90.30.99"))
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("."), number.cast("string")).alias("id_codigo_sit"),
        F.col("l_suppkey").cast("string").alias("termo"),
        code.alias("rubrica"),
        text.tax_id(F.col("l_partkey").cast("string")).alias("cpf_cnpj"),
        # one person under two spellings that differ in case
        F.concat(F.when(F.col("l_returnflag") == "R", "Pessoa ").otherwise("PESSOA "), F.col("l_partkey").cast("string")).alias(
            "favorecido"
        ),
        F.when(F.col("l_returnflag") == "N", F.lower(description)).otherwise(description).alias("descricao_despesa"),
        day.alias("data_pagamento"),
        day.alias("data_debito_convenio"),
        money.money(F.col("l_extendedprice")).alias("valor"),
        text.line_key(F.col("l_suppkey"), code).alias("id_termo_rubrica"),
    )


def payee_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order to its customer; contract = nation, job = priority."""
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return (
        table(spark, sf_dir, "orders")
        .join(people, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("c_nationkey").alias("termo"),
            F.col("c_name").alias("favorecido"),
            text.tax_id(F.col("o_custkey").cast("string")).alias("cpf"),
            _case(F.col("o_orderpriority"), JOBS_BY_PRIORITY).alias("cargo"),
            F.when(F.col("o_orderstatus") == "P", F.lit("PAGAMENTO FÉRIAS"))
            .otherwise(F.lit(S.SALARY_PAYMENT))
            .alias("tipo_evento"),
            F.col("o_orderdate").cast("date").alias("data_evento"),
            money.money(F.col("o_totalprice")).alias("valor_evento"),
        )
    )


def seats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One seat per supplier; contract = nation, job = range of the account balance."""
    balance = F.col("s_acctbal")
    job = (
        F.when(balance < 2000, F.lit("CUIDADORA"))
        .when(balance < 4000, F.lit("cozinheira"))
        .when(balance < 6000, F.lit("MOTORISTA"))
        .when(balance < 8000, F.lit("Nutricionista"))
        .otherwise(F.lit("PSICÓLOGA"))
    )
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("id_vaga"),
        F.col("s_nationkey").alias("termo"),
        job.alias("cargo"),
        F.lit("ANTIGO").alias("favorecido_atual"),
        F.lit(None).cast("date").alias("data_inicio"),
        F.lit(S.SEAT_TAKEN).alias("status_vaga"),
    )


def report_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One summary report per order, as ``(source_file, modified, content)``.

    Orders of status P lack the contract number and those of status O repeat the income
    section, so that the last total counts.
    """
    price = money.money(F.col("o_totalprice"))
    shown = F.concat(F.lit("R$ "), money.format_brl(price))
    head = F.concat(F.lit(f"lixo;1\n{S.MARK_SIT};"), (F.col("o_custkey") + F.lit(50000)).cast("string"), F.lit("\r\n"))
    income = F.concat(F.lit(f"  {S.MARK_INCOME}\n01/2025;R$ 10,00\n{S.MARK_TOTAL};"), shown, F.lit("\n"))
    early = F.lit(f"{S.MARK_INCOME}\n{S.MARK_TOTAL};R$ 7,00\n{S.MARK_TOTAL};R$ 8,00\n")
    code = F.concat(F.lit("3.3.90.30.0"), F.left(F.col("o_orderpriority"), F.lit(1)))
    body = F.concat(
        F.lit(f"{S.MARK_EXPENSES}\n{S.MARK_HEADER}Previsto;Pago;Saldo;Estornado\n"),
        code,
        F.lit(" - MATERIAL;1.000,00;500,00;500,00;"),
        shown,
        F.lit("\n3.1.90.11.99 - PESSOAL;2.000,00;900,00;1.100,00;-\ncurta;1;2\n\n"),
        F.lit(f"{S.MARK_TOTAL};3.000,00;1.400,00;1.600,00;25,10\n"),
    )
    status = F.col("o_orderstatus")
    content = F.concat(
        F.when(status == "P", F.lit("lixo;1\n")).otherwise(head),
        F.when(status == "O", early).otherwise(F.lit("")),
        income,
        body,
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("source_file"),
        F.col("o_orderdate").alias("modified"),
        content.alias("content"),
    )


# contract number of the raw workbooks, one per priority; the last has no contract
SIT_BY_PRIORITY = {"901": "11", "902": "12", "903": "13", "904": "14"}


def class_text(c: Column) -> Column:
    """Expense-type text per part type, mixing case and keywords."""
    return _case(
        c,
        (
            ("STANDARD", "Pessoal Civil"),
            ("PROMO", "obrigações patronais"),
            ("SMALL", "MATERIAIS DE CONSUMO e pessoal civil"),
            ("MEDIUM", "Serviços de Terceiros"),
            ("LARGE", "Diárias"),
        ),
    )


def raw_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded workbook rows, one per order; the file goes by the priority."""
    priority, day = F.col("o_orderpriority"), F.col("o_orderdate").cast("date")
    number = F.left(priority, F.lit(1))
    absent = F.when(priority == "2-HIGH", F.array(F.lit(S.H_DEBITED_ON[0]))).otherwise(F.array(F.lit(S.H_DEBITED_ON[1])))
    bad_day = F.when(F.col("o_orderstatus") == "P", F.lit("31/02/2001")).otherwise(F.date_format(day, "dd/MM/yyyy"))
    kind = F.when(priority == "3-MEDIUM", F.lit("sem código")).otherwise(F.lit("3.1.90.11.99 - pessoal civil"))
    debit = F.date_format(F.date_add(day, 3), "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("file:/landing/Despesas_SIT_90"), number, F.lit(".xlsx")).alias("source_file"),
        F.col("o_orderdate").alias("modified"),
        (F.col("o_orderkey") + F.lit(1)).alias("row_no"),
        F.lit("ok").alias("file_status"),
        absent.alias("absent"),
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), F.lit("\t")).alias(S.H_CODE),
        kind.alias(S.H_TYPE),
        F.concat(F.col("o_custkey").cast("string"), F.lit("-00")).alias(S.H_TAX_ID),
        F.concat(F.lit("Pessoa "), F.col("o_custkey").cast("string"), F.lit("  ")).alias(S.H_PAYEE),
        F.lit(None).cast("string").alias(S.H_EXPENSE_DOC),
        F.concat(F.lit(" Pedido "), priority).alias(S.H_DESCRIPTION),
        F.lit("TED").alias(S.H_PAYMENT_DOC),
        bad_day.alias(S.H_PAID_ON),
        F.when(priority != "2-HIGH", debit).alias(S.H_DEBITED_ON[0]),
        F.when(priority == "2-HIGH", debit).alias(S.H_DEBITED_ON[1]),
        money.format_brl(money.money(F.col("o_totalprice"))).alias(S.H_AMOUNT),
    )
