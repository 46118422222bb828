from __future__ import annotations

import contextlib
import datetime as dt
import io
import itertools
import random
from collections import defaultdict

from conftest import D
from pyspark.sql import functions as F

from grantloom import schemas
from grantloom import settings as S
from grantloom.operators import apply
from grantloom.plans import balances, payroll, staffing

AS_OF = dt.date(2025, 6, 15)


def frame(spark, schema, *rows):
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def contract(id_termo, **more):
    return {
        "id_termo": id_termo,
        "data_inicio_vigencia": dt.date(2025, 1, 31),
        "data_fim_vigencia": dt.date(2025, 12, 31),
        "dias_restantes": 999,
        "rendimento_financeiro_total": D("100.00"),
        "nro_sit": id_termo + 1000,
    } | more


def line(key, planned, **more):
    return {"id_termo_rubrica": key, "saldo_inicial_previsto": D(planned), "saldo_atual": D("1.00")} | more


def paid(key, day, amount):
    return {"id_termo_rubrica": key, "data_pagamento": dt.date.fromisoformat(day), "valor": D(amount)}


def refreshed(spark, lines, contracts, *expenses):
    return balances.refresh_lines(
        frame(spark, schemas.LINES, *lines),
        frame(spark, schemas.CONTRACTS, *contracts),
        frame(spark, schemas.EXPENSES, *expenses),
        AS_OF,
    )


def by_key(df, key="id_termo_rubrica"):
    return {r[key]: r for r in df.collect()}


def test_line_refresh_by_hand(spark):
    out = refreshed(
        spark,
        [
            line("7-3.1", "1000.00", valor_estornado=D("20.00")),
            line("7-3.1-x", "0.00"),
            line("7-3.2", "100.00"),
            line("7-3.3", "10.00"),
            line("8-3.1", "5.00", saldo_total_gasto=D("4.00"), executado="old"),
            line("nokey", "5.00"),
        ],
        [contract(7)],
        paid("7-3.1", "2025-02-01", "100.00"),
        paid("7-3.1", "2025-03-31", "200.00"),
        paid("7-3.3", "2025-01-31", "123.45"),
        paid("9-9", "2025-01-31", "1.00"),
    )
    got = by_key(out)
    assert out.schema == schemas.LINES
    a = got["7-3.1"]
    # January to March are three months; 720 / 100 is 7.2 months
    assert (a["saldo_total_gasto"], a["saldo_atual"], a["media_mensal_gastos"]) == (D("300.00"), D("720.00"), D("100.00"))
    assert (a["executado"], a["previsao_mensal_saldo"]) == ("30,00%", 7)
    assert a["previsao_mensal_saldo_texto"] == "0 anos, 7 meses e 6 dias"
    assert (a["data_atual"], a["dias_restantes"]) == (AS_OF, 199)
    # plan of zero: no percent
    assert got["7-3.1-x"]["executado"] is None
    # no expenses: spend 0, no burn, no runway
    b = got["7-3.2"]
    assert (b["saldo_total_gasto"], b["media_mensal_gastos"], b["previsao_mensal_saldo"], b["previsao_mensal_saldo_texto"]) == (
        D("0.00"),
        None,
        None,
        None,
    )
    # over one thousand percent
    assert got["7-3.3"]["executado"] == "1.234,50%"
    # unknown contract or no contract number: untouched
    assert (got["8-3.1"]["saldo_total_gasto"], got["8-3.1"]["executado"], got["8-3.1"]["data_atual"]) == (D("4.00"), "old", None)
    assert got["nokey"]["saldo_atual"] == D("1.00")


def test_line_stored_twice_counts_its_expenses_twice(spark):
    out = refreshed(spark, [line("7-1", "100.00"), line("7-1", "200.00")], [contract(7)], paid("7-1", "2025-01-31", "10.00"))
    assert sorted((r["saldo_total_gasto"], r["saldo_atual"]) for r in out.collect()) == [
        (D("20.00"), D("80.00")),
        (D("20.00"), D("180.00")),
    ]


def test_no_burn_when_the_month_count_is_zero(spark):
    out = by_key(refreshed(spark, [line("7-1", "100.00")], [contract(7)], paid("7-1", "2024-12-01", "10.00")))
    assert out["7-1"]["media_mensal_gastos"] is None and out["7-1"]["saldo_atual"] == D("90.00")


def test_line_log_has_before_and_after(spark):
    lines = [line("7-2", "100.00"), line("7-1", "50.00"), line("8-1", "1.00")]
    log = balances.line_change_log(
        frame(spark, schemas.LINES, *lines), frame(spark, schemas.CONTRACTS, contract(7)), frame(spark, schemas.EXPENSES), AS_OF
    )
    assert [tuple(r)[1:] for r in log.collect()] == [("7-1", D("1.00"), D("50.00"), 199), ("7-2", D("1.00"), D("100.00"), 199)]


def contracts_and_lines(spark):
    contracts = [contract(7), contract(8, rendimento_financeiro_total=None), contract(9)]
    lines = [
        line("7-1", "10.00", saldo_total_gasto=D("160.00"), saldo_atual=D("-150.00"), executado="1.600,00%"),
        line("7-2", "100.00", saldo_total_gasto=D("110.00"), saldo_atual=D("-10.00"), executado="110,00%", data_fim_vigencia=dt.date(2025, 7, 1)),
        line("7-3", "100.00", saldo_total_gasto=D("100.00"), saldo_atual=D("-0.01"), executado="100,00%"),
        line("8-1", "0.00", saldo_total_gasto=None, saldo_atual=D("-5.00"), executado=None),
        line("?", "1.00"),
    ]
    return frame(spark, schemas.CONTRACTS, *contracts), frame(spark, schemas.LINES, *lines)


def test_contract_refresh_by_hand(spark):
    contracts, lines = contracts_and_lines(spark)
    out = balances.refresh_contracts(contracts, lines, AS_OF)
    got = by_key(out, "id_termo")
    assert out.columns == contracts.columns
    assert (got[7]["saldo_total_gasto"], got[7]["saldo_atual"], got[7]["dias_restantes"]) == (D("370.00"), D("-60.01"), 199)
    assert (got[8]["saldo_total_gasto"], got[8]["saldo_atual"]) == (D("0.00"), D("-5.00"))
    assert (got[9]["saldo_total_gasto"], got[9]["dias_restantes"], got[9]["data_atual"]) == (None, 999, None)
    log = balances.contract_change_log(contracts, lines, AS_OF).collect()
    assert [tuple(r)[1:] for r in log] == [(7, 999, 199, D("-60.01")), (8, 999, 199, D("-5.00"))]
    metrics = by_key(balances.contract_metrics(lines, AS_OF), "id_termo")
    assert (metrics[7]["data_fim_vigencia"], metrics[7]["dias_restantes"]) == (dt.date(2025, 7, 1), 16)


def test_consumed_income(spark):
    contracts, lines = contracts_and_lines(spark)
    got = by_key(balances.consumed_income(contracts, lines), "id_termo")
    assert {k: r["rendimento_financeiro_atual"] for k, r in got.items()} == {7: D("-60.00"), 8: D("0.00"), 9: D("100.00")}
    old = by_key(balances.consumed_income(contracts, lines, compat_text_pct=True), "id_termo")
    assert old[7]["rendimento_financeiro_atual"] == D("90.00")
    both = by_key(balances.refresh_contract_balances(contracts, lines, AS_OF), "id_termo")
    assert (both[7]["saldo_atual"], both[7]["rendimento_financeiro_atual"]) == (D("-60.01"), D("-60.00"))


# --- staffing -------------------------------------------------------------------------


def event(termo, cpf, cargo, day, name=None, kind=S.SALARY_PAYMENT):
    return {
        "termo": termo,
        "cpf": cpf,
        "cargo": cargo,
        "favorecido": name or f"P{cpf}",
        "tipo_evento": kind,
        "data_evento": dt.date.fromisoformat(day),
    }


def seat(id_vaga, termo, cargo):
    return {"id_vaga": id_vaga, "termo": termo, "cargo": cargo, "favorecido_atual": "old", "data_inicio": dt.date(2020, 1, 1), "status_vaga": "OCUPADA"}


def test_seat_assignment_by_hand(spark):
    seats = frame(
        spark, schemas.SEATS, seat(10, 1, "CUIDADORA"), seat(2, 1, "Cuidadora "), seat(30, 1, "CUIDADORA"), seat(4, 2, "CUIDADORA"), seat(5, 1, "MOTORISTA")
    )
    events = frame(
        spark,
        schemas.PAYEE_EVENTS,
        event(1, "222", "CUIDADORA", "2025-05-01"),
        event(1, "222", "MOTORISTA", "2025-01-01"),
        event(1, "111", "cuidadora", "2025-06-01"),
        event(1, "333", "CUIDADORA", "2025-04-30"),
        event(1, "444", "CUIDADORA", "2025-06-01", kind="FÉRIAS"),
        event(2, "555", "CUIDADORA", "2025-06-10"),
        event(2, "666", "CUIDADORA", "2025-06-10"),
    )
    out = staffing.assign_seats(seats, events, AS_OF)
    got = {r["id_vaga"]: (r["favorecido_atual"], str(r["data_inicio"]), r["status_vaga"]) for r in out.collect()}
    assert out.columns == seats.columns
    assert got == {
        2: ("P111", "2025-06-01", S.SEAT_TAKEN),
        10: ("P222", "2025-01-01", S.SEAT_TAKEN),
        30: (S.SEAT_FREE, "None", S.SEAT_FREE),
        4: ("P555", "2025-06-10", S.SEAT_TAKEN),
        5: (S.SEAT_FREE, "None", S.SEAT_FREE),
    }


def test_seat_assignment_against_brute_force_with_a_hot_job(spark):
    rng = random.Random(7)
    jobs = ["A", "B", "C"]
    events = [
        event(1 if rng.random() < 0.5 else rng.randrange(1, 5), f"{rng.randrange(400):011d}", rng.choice(jobs), f"2025-0{rng.randrange(3, 7)}-{rng.randrange(10, 28)}")
        for _ in range(1500)
    ]
    seats = [seat(i, 1 if i % 3 == 0 else i % 5, rng.choice(jobs)) for i in range(400)]
    last, first = {}, {}
    for e in events:
        who = (e["cpf"], e["termo"])
        stamp = (e["data_evento"], e["cargo"], e["favorecido"])
        last[who] = max(last.get(who, stamp), stamp)
        first[who] = min(first.get(who, e["data_evento"]), e["data_evento"])
    payees = defaultdict(list)
    for (cpf, termo), (day, cargo, name) in sorted(last.items()):
        if day >= dt.date(2025, 5, 1):
            payees[termo, cargo].append((name, first[cpf, termo]))
    want = {}
    places = defaultdict(list)
    for s in seats:
        places[s["termo"], s["cargo"]].append(s["id_vaga"])
    for group, ids in places.items():
        for id_vaga, who in itertools.zip_longest(sorted(ids), payees[group][: len(ids)]):
            want[id_vaga] = who or (S.SEAT_FREE, None)
    seat_df, event_df = frame(spark, schemas.SEATS, *seats), frame(spark, schemas.PAYEE_EVENTS, *events)
    out = staffing.assign_seats(seat_df, event_df, AS_OF)
    assert {r["id_vaga"]: (r["favorecido_atual"], r["data_inicio"]) for r in out.collect()} == want
    taken = [w[0] for w in want.values() if w[0] != S.SEAT_FREE]
    assert len(taken) > 50


def pay(name, text, day="2025-05-10", amount="10.00", **more):
    return {
        "favorecido": name,
        "descricao_despesa": text,
        "data_debito_convenio": dt.date.fromisoformat(day) if day else None,
        "data_pagamento": dt.date(2025, 5, 10),
        "valor": D(amount),
        "termo": "7",
        "rubrica": "3.1.90.11.99",
        "id_termo_rubrica": "7-3.1.90.11.99",
        "cpf_cnpj": name,
    } | more


def test_roster(spark):
    df = frame(
        spark,
        schemas.EXPENSES,
        pay("Z", "Pagamento salário cuidadora auxiliar", "2025-05-01"),
        pay("Z", "PAGAMENTO SALÁRIO CUIDADORA AUXILIAR", "2025-02-01"),
        pay("A", "SALÁRIO COORDENADORA", "2025-04-30"),
        pay("B", "SALÁRIO MOTORISTA", "2025-03-31"),
        pay("C", "SALÁRIO MOTORISTA", None),
        pay("D", "SALÁRIO ZELADOR"),
        pay("E", "FÉRIAS MOTORISTA"),
    )
    got = [(r["favorecido"], r["cargo"], str(r["data_primeiro_pagamento"]), r["status_funcional"]) for r in staffing.roster(df, AS_OF).collect()]
    assert got == [
        ("A", "COORDENADOR", "2025-04-30", S.UNDEFINED),
        ("B", "MOTORISTA", "2025-03-31", S.INACTIVE),
        ("C", "MOTORISTA", "None", S.UNDEFINED),
        ("Z", "CUIDADORA AUXILIAR", "2025-02-01", S.ACTIVE),
    ]


# --- payroll --------------------------------------------------------------------------


def test_month_spend_and_detail(spark):
    df = frame(
        spark,
        schemas.EXPENSES,
        pay("A", "x", "2025-09-01", "1000.50"),
        pay("A", "férias", "2025-09-30", "1.00", rubrica="9"),
        pay("A", "x", "2025-10-01", "5.00"),
        pay("A", "x", "2025-09-02", "7.00", rubrica="9"),
        pay("A", "x", "2025-09-02", "9.00", termo="8"),
    )
    month = ("2025-09-01", "2025-10-01")
    assert [tuple(r) for r in payroll.month_spend(df, "7", *month).collect()] == [("7", "1.001,50")]
    assert dict(map(tuple, payroll.month_spend(df, None, *month).collect())) == {"7": "1.001,50", "8": "9,00"}
    assert [r["valor"] for r in payroll.month_detail(df, "7", *month).collect()] == [D("1000.50")]


def test_spend_matrix(spark):
    df = frame(
        spark,
        schemas.EXPENSES,
        pay("A", "PAGAMENTO SALÁRIO COORDENADORA", amount="900.00"),
        pay("A", "PAGAMENTO SALÁRIO COORDENADORA", amount="200.00"),
        pay("B", "pagamento salário coordenador", amount="1.00"),
        pay("C", "PAGAMENTO SALÁRIO ZELADOR", amount="99.00"),
        pay("D", "FÉRIAS COZINHEIRA", amount="3.00"),
        pay("E", "RESCISÃO COZINHEIRA"),
        pay("F", "FÉRIAS COZINHEIRA", termo="8"),
    )
    month = ("2025-05-01", "2025-06-01")
    got = [tuple(r) for r in payroll.spend_matrix(df, *month, contracts=["7"]).collect()]
    assert got == [
        ("7", "FÉRIAS", "COZINHEIRA", 1, "3,00"),
        ("7", "SALÁRIO", "COORDENADOR(A)", 2, "1.101,00"),
        ("7", "SALÁRIO", None, 1, "99,00"),
    ]


def test_detail_reports(spark):
    texts = [
        "RESCISÃO X",
        "pagamento salário",
        "RECOLHIMENTO INSS",
        "RECOLHIMENTO INSS - 13º SALÁRIO",
        "RECOLHIMENTO IRRF",
        "REEMBOLSO RECOLHIMENTO FGTS",
        "REEMBOLSO RECOLHIMENTO FGTS 13º SALÁRIO",
        None,
    ]
    df = frame(spark, schemas.EXPENSES, *[pay(str(i), t) for i, t in enumerate(texts)], pay("z", "RESCISÃO", termo="8", id_termo_rubrica="8-1"))
    key = "7-3.1.90.11.99"

    def ids(out):
        return sorted(r["favorecido"] for r in out.collect())

    assert ids(payroll.terminations(df, key)) == ["0"]
    assert ids(payroll.terminations(df)) == ["0", "z"]
    assert ids(payroll.salaries(df, key)) == ["1"]
    assert ids(payroll.inss_on_13th(df, key)) == ["3"]
    assert ids(payroll.fgts_on_13th(df, "7")) == ["3", "6"]
    assert ids(payroll.inss(df, key)) == ["2"]
    assert ids(payroll.irrf(df, key)) == ["4"]
    assert ids(payroll.fgts(df, "7")) == ["5"]
    assert ids(payroll.payee_search(df, "Z")) == ["z"]
    assert payroll.detail_rows(df, contract="7").count() == 8


def test_vacations_and_instalments(spark):
    df = frame(
        spark,
        schemas.EXPENSES,
        pay("B", "FÉRIAS CUIDADORA - 30 DIAS GOZO DE 01/02/25 A 02/03/25"),
        pay("A", "férias professora regente"),
        pay("C", "FÉRIAS ZELADOR"),
        pay("B", "13º SALÁRIO 2ª PARCELA COZINHEIRA", amount="2.00"),
        pay("B", "13º salário 1ª parcela cozinheira", amount="1.00"),
        pay("B", "13º SALÁRIO COZINHEIRA"),
        pay("B", "13º SALÁRIO 1ª PARCELA PROFESSORA"),
    )
    got = [tuple(map(str, r)) for r in payroll.vacations(df).collect()]
    assert got == [
        ("A", "PROFESSORA", "None", "None", "None", "7"),
        ("B", "CUIDADORA", "30 DIAS", "2025-02-01", "2025-03-02", "7"),
    ]
    assert [(r["parcela"], r["valor"]) for r in payroll.instalments(df).collect()] == [("1ª PARCELA", D("1.00")), ("2ª PARCELA", D("2.00"))]


def test_line_history_is_sorted_by_debit_date(spark):
    df = frame(spark, schemas.EXPENSES, pay("A", "x", "2025-05-02"), pay("B", "x", "2025-05-01"), pay("C", "x", id_termo_rubrica="9"))
    assert [r["favorecido"] for r in payroll.line_history(df, "7-3.1.90").collect()] == ["B", "A"]


# --- what reaches the scan ------------------------------------------------------------


def physical(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    frame(spark, schemas.EXPENSES, pay("A", "x")).write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = physical(payroll.month_spend(stored, "7", "2025-05-01", "2025-06-01"))
    assert "EqualTo(termo,7)" in plan and "GreaterThanOrEqual(data_debito_convenio,2025-05-01)" in plan
    assert "favorecido" not in plan.split("ReadSchema:")[1].split("\n")[0]
    assert "In(rubrica" in physical(payroll.month_detail(stored, "7", "2025-05-01", "2025-06-01"))


def test_expenses_are_summed_before_the_join(spark, tmp_path):
    frame(spark, schemas.EXPENSES, paid("7-1", "2025-01-31", "10.00")).write.parquet(str(tmp_path / "d"))
    plan = physical(
        balances.line_metrics(
            frame(spark, schemas.LINES, line("7-1", "1.00")),
            frame(spark, schemas.CONTRACTS, contract(7)),
            spark.read.parquet(str(tmp_path / "d")),
            AS_OF,
        )
    )
    assert "partial_sum" in plan and "SortAggregate" not in plan
    read = plan.split("ReadSchema:")[1].split("\n")[0]
    assert "valor" in read and "favorecido" not in read


def test_line_metrics_shuffle_each_side_once_by_line(spark, tmp_path):
    frame(spark, schemas.EXPENSES, paid("7-1", "2025-01-31", "10.00")).write.parquet(str(tmp_path / "d"))
    frame(spark, schemas.LINES, line("7-1", "1.00")).write.parquet(str(tmp_path / "l"))
    frame(spark, schemas.CONTRACTS, contract(7)).write.parquet(str(tmp_path / "t"))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        lines, contracts, expenses = (spark.read.parquet(str(tmp_path / n)) for n in "ltd")
        plan = balances.line_metrics(lines, contracts, expenses, AS_OF)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    by_line = [x for x in plan.split("\n") if "Exchange hashpartitioning(__line" in x or "Exchange hashpartitioning(_groupingexpression" in x]
    # and one for each side of the join to the contracts
    assert len(by_line) == 2 and plan.count("Exchange hashpartitioning") == 4
    # and both inputs of the contract join once by contract
    assert plan.count("Exchange hashpartitioning(__contract") == 2
    assert "BroadcastExchange" not in plan and "Cartesian" not in plan


def test_line_keys_compare_without_case(spark):
    lines = frame(spark, schemas.LINES, line("7-3.1 Ajuda", "100.00"), line("7-Ómega", "50.00"))
    spent = frame(
        spark,
        schemas.EXPENSES,
        paid("7-3.1 AJUDA", "2025-01-31", "10.00"),
        paid("7-3.1 ajuda ", "2025-02-28", "5.00"),
        paid("7-ómega", "2025-02-28", "1.00"),
        paid("7-Omega", "2025-02-28", "9.00"),  # accents count
    )
    got = {r["id_termo_rubrica"]: r for r in balances.refresh_lines(lines, frame(spark, schemas.CONTRACTS, contract(7)), spent, AS_OF).collect()}
    assert {k: r["saldo_total_gasto"] for k, r in got.items()} == {"7-3.1 Ajuda": D("15.00"), "7-Ómega": D("1.00")}
    updates = spark.createDataFrame([("7-3.1 AJUDA", D("3.00"))], "id_termo_rubrica string, valor_estornado decimal(18,2)")
    after = {r["id_termo_rubrica"]: r["valor_estornado"] for r in apply.apply_refunds(lines, updates).collect()}
    assert after == {"7-3.1 Ajuda": D("3.00"), "7-Ómega": None}
