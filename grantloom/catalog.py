"""Every registered query: ``name -> (spark, sf_dir) -> DataFrame``.

Results are shown with plain types (money as double, dates as ISO text) so that two engines
can be compared value by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import settings as S
from . import standins as st
from .functions import dates, fingerprint, money, text
from .operators import apply, changes, checks, dedup, reconcile, settle
from .plans import balances, extract, full_run, payroll, staffing
from .sources import landing, reports, staging, stored

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

MONTH = ("1999-09-01", "1999-10-01")


def _query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return show(build(spark, sf_dir))

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return build


def show(df: DataFrame) -> DataFrame:
    """Money as double and dates as ISO text; all else as it is."""

    def plain(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return dates.iso(c).alias(f.name)
        return c

    return df.select(*[plain(f) for f in df.schema])


# --- balances -------------------------------------------------------------------------


def _ledger(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return st.lines(spark, d), st.contracts(spark, d), st.paid_expenses(spark, d)


def _lines_after(spark: SparkSession, d: str) -> DataFrame:
    return balances.refresh_lines(*_ledger(spark, d), st.AS_OF)


@_query
def burn_rate(spark, d):
    """Spend, days left and monthly burn per budget line."""
    return balances.line_metrics(*_ledger(spark, d), st.AS_OF)


@_query
def line_refresh(spark, d):
    """Balance, percent spent, burn and runway of every budget line."""
    return _lines_after(spark, d).select(
        "id_termo_rubrica",
        "data_atual",
        "dias_restantes",
        "saldo_inicial_previsto",
        "valor_estornado",
        "saldo_total_gasto",
        "saldo_atual",
        "executado",
        "media_mensal_gastos",
        F.col("previsao_mensal_saldo").cast("double").alias("previsao_mensal_saldo"),
        "previsao_mensal_saldo_texto",
    )


@_query
def line_change_log(spark, d):
    return balances.line_change_log(*_ledger(spark, d), st.AS_OF)


@_query
def contract_rollup(spark, d):
    """Latest end, days left, spend and balance per contract."""
    return balances.contract_metrics(_lines_after(spark, d), st.AS_OF).drop("valor_utilizado_rendimento")


@_query
def contract_refresh(spark, d):
    return balances.refresh_contracts(st.contracts(spark, d), _lines_after(spark, d), st.AS_OF).select(
        "id_termo", "data_atual", "dias_restantes", "saldo_total_gasto", "saldo_atual"
    )


@_query
def contract_change_log(spark, d):
    return balances.contract_change_log(st.contracts(spark, d), _lines_after(spark, d), st.AS_OF)


@_query
def consumed_income(spark, d):
    return balances.consumed_income(st.contracts(spark, d), _lines_after(spark, d)).select(
        "id_termo", "rendimento_financeiro_total", "rendimento_financeiro_atual"
    )


@_query
def consumed_income_text_percent(spark, d):
    """As ``consumed_income``, with percents read the ledger's old way."""
    return balances.consumed_income(st.contracts(spark, d), _lines_after(spark, d), compat_text_pct=True).select(
        "id_termo", "rendimento_financeiro_atual"
    )


@_query
def key_split_join(spark, d):
    """Budget lines joined to contracts on the number in front of the first dash."""
    lines = st.lines(spark, d).select(
        "id_termo_rubrica", text.contract_of(F.col("id_termo_rubrica")).alias("id_termo")
    )
    terms = st.contracts(spark, d).select("id_termo", "nro_sit", "situacao_atual")
    return lines.join(terms, "id_termo")


# --- change detection -----------------------------------------------------------------


def _classified(spark: SparkSession, d: str) -> DataFrame:
    return changes.classify(st.expenses(spark, d), st.stored_expenses(spark, d))


def _changes(spark: SparkSession, d: str) -> DataFrame:
    return changes.detect_changes(st.expenses(spark, d), st.stored_expenses(spark, d))


@_query
def row_fingerprint(spark, d):
    return st.expenses(spark, d).select("id_codigo_sit", fingerprint.fingerprint().alias("impressao"))


@_query
def change_detect(spark, d):
    """New and changed expenses with all their columns."""
    return _changes(spark, d)


@_query
def change_counts(spark, d):
    return changes.count_actions(_classified(spark, d))


@_query
def change_preview(spark, d):
    return changes.preview(_changes(spark, d)).select("acao", "id_codigo_sit", "termo", "valor")


@_query
def new_expenses(spark, d):
    """Expenses the ledger does not have, by anti join."""
    return changes.new_rows(st.expenses(spark, d), st.stored_expenses(spark, d)).select("id_codigo_sit", "valor")


@_query
def apply_changes(spark, d):
    """The whole ledger after a change set that updates some keys twice; rows in no workbook stay."""
    before = st.stored_expenses(spark, d)
    found = changes.detect_changes(st.repeated_expenses(spark, d), before)
    after = apply.apply_expense_changes(before, found, order=("vez",))
    return after.withColumn("tipo_doc_despesa", F.coalesce("tipo_doc_despesa", F.lit("")))


@_query
def diff_idempotent(spark, d):
    """A second run over its own result finds nothing to do."""
    after = apply.apply_expense_changes(st.stored_expenses(spark, d), _changes(spark, d))
    return changes.count_actions(changes.classify(st.expenses(spark, d), after))


@_query
def dedup_keep_last(spark, d):
    """Last event of every user."""
    events = st.table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return dedup.last_per_key(events, ["user_id"], ("ts", "event_id")).drop("ts")


@_query
def last_value_map(spark, d):
    """Last event type per user as a lookup."""
    return dedup.last_value_map(st.table(spark, d, "events"), "user_id", "event_type", ("ts", "event_id"))


# --- summary reports, reconcile and value updates -------------------------------------


@_query
def section_parse(spark, d):
    """Lines of the reports with the number and section in force."""
    return reports.tagged_lines(st.report_texts(spark, d)).select(
        "source_file", F.col("pos").cast("bigint").alias("pos"), "nro_sit", "section", "line"
    )


@_query
def report_contracts(spark, d):
    return reports.contract_summary(st.report_texts(spark, d))


@_query
def report_lines(spark, d):
    return reports.line_summary(st.report_texts(spark, d))


@_query
def report_status(spark, d):
    """Reports used and ignored."""
    status = reports.report_status(st.report_texts(spark, d))
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("arquivos"))


def _income_updates(spark: SparkSession, d: str) -> DataFrame:
    """Reported balances: half a cent, one cent and two cents off, by market segment."""
    off = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(0.01))
        .when(F.col("c_mktsegment") == "FURNITURE", F.lit(0.02))
        .otherwise(F.lit(0.0))
    )
    reported = st.table(spark, d, "customer").select(
        F.concat((F.col("c_custkey") + F.lit(50000)).cast("string"), F.lit(".0")).alias("nro_sit"),
        (money.money(F.col("c_acctbal")) + money.money(off)).cast(money.MONEY).alias("rendimento_financeiro_total"),
    )
    return reconcile.reconcile_income(reported, st.contracts(spark, d))


def _refund_lines(spark: SparkSession, d: str, number: Column) -> DataFrame:
    """Refund lines of the reports by contract ``number``, written with the ledger's priority as line code."""
    return st.table(spark, d, "orders").select(
        number.alias("nro_sit"),
        F.col("o_orderpriority").alias("rubrica"),
        money.money(money.money(F.col("o_totalprice")) * F.lit("0.01").cast("decimal(3,2)")).alias("valor_estornado"),
        F.col("o_orderdate").alias("modified"),
        F.col("o_orderkey").alias("row_no"),
    )


def _reported_refunds(spark: SparkSession, d: str) -> DataFrame:
    """Every order's refund line; one in eleven comes once more, by a number that the ledger does not know."""
    number = (F.col("o_custkey") + F.lit(50000)).cast("string")
    twice = F.when(F.col("o_orderkey") % 11 == 0, F.array(number, F.concat(F.lit("X"), number)))
    return _refund_lines(spark, d, F.explode(F.coalesce(twice, F.array(number))))


def _known_refunds(spark: SparkSession, d: str) -> DataFrame:
    """One order in eleven goes by a contract number that the ledger does not know, and by no other."""
    unknown = F.when(F.col("o_orderkey") % 11 == 0, F.lit(7_000_000)).otherwise(F.lit(50000))
    return _refund_lines(spark, d, (F.col("o_custkey") + unknown).cast("string"))


def _refund_updates(spark: SparkSession, d: str, reported: DataFrame) -> DataFrame:
    return reconcile.reconcile_lines(reported, st.contracts(spark, d), st.lines(spark, d), order=("modified", "row_no"))


@_query
def reconcile_income(spark, d):
    return _income_updates(spark, d)


@_query
def reconcile_lines(spark, d):
    return _refund_updates(spark, d, _reported_refunds(spark, d))


@_query
def apply_income(spark, d):
    return apply.apply_income(st.contracts(spark, d), _income_updates(spark, d)).select(
        "id_termo", "nro_sit", "rendimento_financeiro_total"
    )


@_query
def apply_refunds(spark, d):
    return apply.apply_refunds(st.lines(spark, d), _refund_updates(spark, d, _reported_refunds(spark, d))).select(
        "id_termo_rubrica", "saldo_inicial_previsto", "valor_estornado"
    )


@_query
def run_preview(spark, d):
    """First rows and totals of the three change sets of a run."""
    return changes.preview_run(
        _changes(spark, d), _income_updates(spark, d), _refund_updates(spark, d, _known_refunds(spark, d))
    )


@_query
def full_run_contracts(spark, d):
    """Contracts at the end of a run: changes found, applied, lines and contracts refreshed."""
    state = full_run.Ledger(st.stored_expenses(spark, d), st.contracts(spark, d), st.lines(spark, d))
    found = full_run.ChangeSets(_changes(spark, d), _income_updates(spark, d), _refund_updates(spark, d, _known_refunds(spark, d)))
    return full_run.refresh(full_run.apply_changes(state, found), st.AS_OF).contracts.select(
        "id_termo",
        "data_atual",
        "dias_restantes",
        "saldo_total_gasto",
        "saldo_atual",
        "rendimento_financeiro_total",
        "rendimento_financeiro_atual",
    )


# --- cleaning expressions -------------------------------------------------------------


@_query
def classify_rules(spark, d):
    """Expense class of parts, from text that mixes case and several keywords."""
    kind = F.concat(F.col("p_name"), F.lit(" / "), st.class_text(F.col("p_type")))
    return st.table(spark, d, "part").select("p_partkey", text.expense_class(kind).alias("classe"))


@_query
def tax_id_clean(spark, d):
    """Digits of formatted ids of many lengths."""
    raw = F.concat(F.col("c_custkey").cast("string"), F.lit(".-/"), F.repeat(F.lit("7 "), F.col("c_nationkey")))
    return st.table(spark, d, "customer").select(
        "c_custkey", text.tax_id(F.when(F.col("c_acctbal") >= 0, raw)).alias("cpf_cnpj")
    )


@_query
def line_code_extract(spark, d):
    full = F.concat(F.lit("3.1.90."), F.col("p_size").cast("string"), F.lit(" - "), F.col("p_name"))
    return st.table(spark, d, "part").select(
        "p_partkey",
        text.line_code(full).alias("rubrica"),
        text.line_code(F.col("p_name")).alias("sem_rubrica"),
    )


@_query
def id_clean(spark, d):
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    return st.table(spark, d, "customer").select(
        "c_custkey",
        text.clean_id(F.concat(F.lit(" "), key, F.lit(".0"))).alias("de_numero"),
        text.clean_id(F.concat(name, F.lit("  "))).alias("de_texto"),
    )


@_query
def brl_parse(spark, d):
    """Amounts written the Brazilian way and read back, with blanks, dashes and junk."""
    shown = F.concat(F.lit("R$ "), money.format_brl(money.money(F.col("l_extendedprice"))))
    raw = (
        F.when(F.col("l_linenumber") == 1, F.lit("-"))
        .when(F.col("l_linenumber") == 2, F.lit("  "))
        .when(F.col("l_linenumber") == 3, F.lit("R$ abc"))
        .otherwise(shown)
    )
    return st.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", money.parse_brl(raw).alias("valor")
    )


@_query
def brl_format(spark, d):
    return st.table(spark, d, "customer").select(
        "c_custkey",
        money.format_brl(money.money(F.col("c_acctbal")) * F.lit(1000)).alias("texto"),
        money.format_percent(money.quotient(money.money(F.col("c_acctbal")), F.lit(7))).alias("percentual"),
    )


@_query
def num_coerce(spark, d):
    """Number text with junk and Brazilian notation mixed in."""
    price = money.money(F.col("o_totalprice"))
    raw = (
        F.when(F.col("o_orderstatus") == "P", F.concat(price.cast("string"), F.lit("x")))
        .when(F.col("o_orderstatus") == "O", money.format_brl(price))
        .otherwise(price.cast("string"))
    )
    return st.table(spark, d, "orders").select(
        "o_orderkey", money.parse_number(raw).alias("numero"), money.parse_amount(raw).alias("valor")
    )


@_query
def date_parse_dayfirst(spark, d):
    """Day-first, ISO and broken date text."""
    day = F.col("o_orderdate").cast("date")
    raw = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(day, "dd/MM/yyyy"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(day, "d/M/yyyy"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", dates.iso(day))
        .otherwise(F.date_format(day, "'31/02/'yyyy"))
    )
    return st.table(spark, d, "orders").select("o_orderkey", dates.to_sql_date(raw).alias("data"))


@_query
def consolidate_rows(spark, d):
    """Raw expense text cleaned into typed columns, rows without date or code dropped."""
    return extract.consolidate_expenses(st.raw_expenses(spark, d), st.SIT_BY_PRIORITY)


@_query
def union_files(spark, d):
    """Two files with different spellings of one header, read as one table."""
    orders = st.table(spark, d, "orders")
    first = orders.filter(F.col("o_orderstatus") != "P").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias(S.H_DEBITED_ON[0])
    )
    second = orders.filter(F.col("o_orderstatus") == "P").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias(S.H_DEBITED_ON[1]), F.col("o_orderpriority").alias("obs")
    )
    parts = [
        f.select(
            "o_orderkey",
            checks.first_spelling(f, S.H_DEBITED_ON).alias("data_debito_convenio"),
            checks.optional(f, "obs").alias("obs"),
        )
        for f in (first, second)
    ]
    return checks.union_files(parts)


def _staged_text(spark: SparkSession, d: str) -> DataFrame:
    """Staged expenses as text, some of them unusable."""
    priority = F.col("o_orderpriority")
    return st.table(spark, d, "orders").select(
        F.when(priority == "1-URGENT", F.lit(" ")).otherwise(F.col("o_orderkey").cast("string")).alias("id_codigo_sit"),
        F.when(priority == "2-HIGH", F.lit("1,5x")).otherwise(money.money(F.col("o_totalprice")).cast("string")).alias("valor"),
        F.when(priority == "3-MEDIUM", F.lit("31/02/1999"))
        .otherwise(dates.iso(F.col("o_orderdate")))
        .alias("data_pagamento"),
        F.lit("").alias("data_debito_convenio"),
        F.col("o_orderkey").alias("linha"),
    )


@_query
def rejects_split(spark, d):
    """Rows that cannot be loaded, with the reason."""
    return checks.split_rejects(_staged_text(spark, d))[1].select("linha", "reject_reason")


@_query
def rejects_good(spark, d):
    """Rows that can be loaded, typed."""
    return checks.split_rejects(_staged_text(spark, d))[0]


@_query
def clear_table(spark, d):
    """Rows of the ledger before and after it is cleared."""
    before, none = st.expenses(spark, d), F.lit(0).cast("bigint")
    marked = before.select(F.lit(1).cast("bigint").alias("a"), none.alias("b")).unionByName(
        apply.clear_table(before).select(none.alias("a"), F.lit(1).cast("bigint").alias("b"))
    )
    return marked.agg(F.coalesce(F.sum("a"), none).alias("linhas_antes"), F.coalesce(F.sum("b"), none).alias("linhas_depois"))


# --- staffing and payroll reports -----------------------------------------------------


@_query
def seat_assignment(spark, d):
    return staffing.assign_seats(st.seats(spark, d), st.payee_events(spark, d), st.SEATS_AS_OF)


@_query
def first_last_event(spark, d):
    return staffing.first_and_last_payment(st.payee_events(spark, d))


@_query
def roster_status(spark, d):
    return staffing.roster(st.payroll(spark, d), st.AS_OF)


@_query
def month_spend(spark, d):
    return payroll.month_spend(st.payroll(spark, d), None, *MONTH)


@_query
def month_detail(spark, d):
    return payroll.month_detail(st.payroll(spark, d), None, *MONTH)


@_query
def spend_matrix(spark, d):
    return payroll.spend_matrix(st.payroll(spark, d), "1995-01-01", "2002-01-01")


@_query
def terminations(spark, d):
    return payroll.terminations(st.payroll(spark, d))


@_query
def salaries(spark, d):
    return payroll.salaries(st.payroll(spark, d))


@_query
def inss_on_13th(spark, d):
    return payroll.inss_on_13th(st.payroll(spark, d))


@_query
def fgts_on_13th(spark, d):
    return payroll.fgts_on_13th(st.payroll(spark, d))


@_query
def inss(spark, d):
    return payroll.inss(st.payroll(spark, d))


@_query
def irrf(spark, d):
    return payroll.irrf(st.payroll(spark, d))


@_query
def fgts(spark, d):
    return payroll.fgts(st.payroll(spark, d))


@_query
def payee_search(spark, d):
    return payroll.payee_search(st.payroll(spark, d), "soa 12")


@_query
def vacations(spark, d):
    return payroll.vacations(st.payroll(spark, d))


@_query
def instalments(spark, d):
    return payroll.instalments(st.payroll(spark, d))


@_query
def line_history(spark, d):
    return payroll.line_history(st.payroll(spark, d), "-3.1.90.11.99")


# --- scans, file checks and views -----------------------------------------------------


@_query
def report_decode(spark, d):
    """Reports as bytes, half of them UTF-8 and half Latin-1, read back as text."""
    texts = st.report_texts(spark, d)
    even = F.col("source_file").cast("bigint") % 2 == 0
    content = F.when(even, F.encode("content", "UTF-8")).otherwise(F.encode("content", "ISO-8859-1"))
    files = texts.select(F.col("source_file").alias("path"), F.col("modified").alias("modificationTime"), content.alias("content"))
    return (
        reports.decode_files(files)
        .join(texts.select("source_file", F.col("content").alias("written")), "source_file")
        .select("source_file", (F.col("content") == F.col("written")).cast("int").alias("igual"))
    )


@_query
def stored_scans(spark, d):
    """The four scans of the stored tables over the given files."""
    customers = stored.read_table(spark, f"{d}/customer.parquet")
    orders = stored.read_table(spark, f"{d}/orders.parquet")
    terms = customers.select(
        F.col("c_custkey").alias("id_termo"),
        (F.col("c_custkey") + 50000).alias("nro_sit"),
        money.money(F.col("c_acctbal")).alias("rendimento_financeiro_total"),
        "c_name",
    )
    keyless = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey").cast("string"))
    spent = st.expenses(spark, d).join(
        orders.select(F.col("o_orderkey").cast("string").alias("id_codigo_sit"), keyless.alias("chave")), "id_codigo_sit"
    )
    parts = (
        ("despesas", stored.stored_expenses(spent.withColumn("id_codigo_sit", F.col("chave"))), "id_codigo_sit", "valor"),
        ("termos", stored.contract_map(terms), "id_termo", "nro_sit"),
        ("rendimentos", stored.stored_income(terms), "nro_sit", "rendimento_financeiro_total"),
        ("estornos", stored.stored_refunds(st.lines(spark, d)), "id_termo_rubrica", "valor_estornado"),
    )
    shown = [
        df.select(F.lit(name).alias("tabela"), F.col(key).cast("string").alias("chave"), money.money(F.col(value)).alias("valor"))
        for name, df, key, value in parts
    ]
    return checks.union_files(shown)


@_query
def file_guard(spark, d):
    """Why each workbook row is used or skipped, with headers missing from some files."""
    third = F.col("row_no") % 3
    lacks = F.when(third == 0, F.array(F.lit(S.H_PAYEE))).when(third == 1, F.array(F.lit(S.H_PAID_ON))).otherwise(F.array())
    raw = st.raw_expenses(spark, d).withColumn("absent", F.concat("absent", lacks))
    checks.require_columns(raw, ["source_file", "row_no", "file_status", "absent"])
    return raw.select("row_no", extract.file_verdict(st.SIT_BY_PRIORITY).alias("status"))


@_query
def contract_detail(spark, d):
    """Personnel expenses of one contract, given as a number."""
    return payroll.month_detail(st.payroll(spark, d), 7, "1994-01-01", "1999-01-01")


@_query
def line_terminations(spark, d):
    """Terminations of one budget line."""
    return payroll.terminations(st.payroll(spark, d), line="7-3.1.90.11.99")


@_query
def sql_views(spark, d):
    """Spend of lines whose contract has ended, asked of the ledger's views with a parameter."""
    lines, contracts, expenses = _ledger(spark, d)
    question = "SELECT id_termo_rubrica, saldo_total_gasto FROM {vw_rubricas_calc} WHERE dias_restantes < :dias"
    return full_run.ask(spark, question, full_run.Ledger(expenses, contracts, lines), {"dias": 0}, st.AS_OF)


@_query
def staging_round_trip(spark, d):
    """Staged expenses written as CSV for one run, read back as text and then typed."""
    text_ = F.concat(F.lit('"x", '), F.col("linha").cast("string"), F.lit(";\\"))
    written = _staged_text(spark, d).withColumn("obs", F.when(F.col("linha") % 2 == 0, text_)).drop("data_debito_convenio")
    path = staging.run_path(settle.shared_folder(spark), "despesas_csv", uuid.uuid4().hex)
    staging.write_csv(written, path)
    kinds = {"valor": T.DecimalType(18, 2), "data_pagamento": T.DateType(), "linha": T.IntegerType()}
    schema = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in written.columns])
    return staging.read_typed(spark, path, schema)


@_query
def report_scan(spark, d):
    """A report per nation, every other one in Latin-1, written as files and read through the scan."""
    nations = st.table(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("soma"))
    number = (F.col("c_nationkey") + 900).cast("string")
    content = F.concat(
        F.concat(F.lit(f"{S.MARK_SIT};"), number, F.lit(f"\n{S.MARK_INCOME}\n{S.MARK_TOTAL};R$ ")),
        F.concat(F.col("n").cast("string"), F.lit(f",50\n{S.MARK_EXPENSES}\n3.1 - Férias;1;2;3;"), F.col("soma").cast("string")),
    )
    texts = nations.select("c_nationkey", content.alias("value"))
    base = f"{settle.shared_folder(spark)}/relatos-{uuid.uuid4().hex}"
    folders = {"UTF-8": 0, "ISO-8859-1": 1}
    for encoding, rest in folders.items():
        some = texts.filter(F.col("c_nationkey") % 2 == rest).repartition("c_nationkey")
        some.write.option("encoding", encoding).partitionBy("c_nationkey").text(f"{base}/{encoding}")
    found = reports.parse(reports.read_texts(spark, [f"{base}/{e}/*" for e in folders], "*.txt"))
    lines = reports.lines_of(found).select("nro_sit", "rubrica", "valor_estornado")
    return lines.join(reports.contracts_of(found).select("nro_sit", "rendimento_financeiro_total"), "nro_sit")


@_query
def landed_files(spark, d):
    """Files of a landing folder by kind, with the rows they hold; an empty kind and a table that is not there."""
    orders = st.table(spark, d, "orders").select(F.concat_ws(";", "o_orderkey", "o_orderpriority").alias("value"), "o_orderpriority")
    base = f"{settle.shared_folder(spark)}/landing-{uuid.uuid4().hex}"
    orders.repartition("o_orderpriority").write.option("encoding", "UTF-8").partitionBy("o_orderpriority").text(base)
    files = landing.landed_files(spark, f"{base}/*", "*.txt")
    waiting = checks.has_rows(files) and not checks.has_rows(landing.landed_files(spark, f"{base}/*", "*.xlsx"))
    known = [stored.table_exists(spark, name) for name in ("no_such_table",)]
    return landing.count_by_extension(files).select(
        "extension", "arquivos", F.lit(waiting).alias("a_processar"), F.lit(known[0]).alias("tabela_existe")
    )
