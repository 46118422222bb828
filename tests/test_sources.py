from __future__ import annotations

import datetime as dt
import os
import random
import tracemalloc
from pathlib import Path

import pytest
from conftest import D, write_xlsx
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantloom import schemas
from grantloom import settings as S
from grantloom.operators import changes
from grantloom.plans import extract
from grantloom.sources import landing, lookups, reports, staging, stored, workbooks
from grantloom.sources.buckets import Buckets

HEADER = [
    "Código",
    "Tipo de Despesa",
    "CPF/CNPJ",
    "Favorecido",
    "Tipo Documento Despesa",
    "Descrição da Despesa",
    "Tipo Documento Pagamento",
    "Data do Pagamento",
    "Data Débito Conta Convêvio",
    "Valor",
]
MAP = {"90001": "71", "90002": "72", "90003": "73", "90004": "74", "90005": "75", "90006": "76"}


def row(code="E1", kind="3.1.90.11.99 - Pessoal Civil", tax="123.456.789-01", day="03/02/2025", debit="04/02/2025", amount="10.50"):
    return [code, kind, tax, " Ana ", None, "PAGAMENTO SALÁRIO", "TED", day, debit, amount]


@pytest.fixture
def books(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    write_xlsx(
        folder / "Despesas_SIT_90001.xlsx",
        [
            HEADER,
            row(),
            row("E2", amount="1.234,56", tax="12.345.678/0001-90"),
            row("E3", amount="junk", day="2025-02-03 00:00:00", debit=None),
            row("E4", day="31/02/2025"),
            row("E5", kind="sem código"),
            row("E6", amount=1234.5, day=45691, debit=45692.25),
        ],
        date_columns=(7, 8),
    )
    other = ["Data Débito Conta Convênio" if h == HEADER[8] else h for h in HEADER if h not in ("Código", "Tipo Documento Despesa")]
    write_xlsx(folder / "Despesas_SIT_90002.xlsx", [other, [v for i, v in enumerate(row()) if i not in (0, 4)]], shared=True)
    write_xlsx(folder / "Despesas_SIT_90003.xlsx", [[h for h in HEADER if h != "Data do Pagamento"], ["x"]])
    (folder / "Despesas_SIT_90004.xlsx").write_bytes(b"no workbook")
    write_xlsx(folder / "Despesas_SIT_90005.xlsx", [HEADER])
    write_xlsx(folder / "Despesas_SIT_99999.xlsx", [HEADER, row()])
    write_xlsx(folder / "other.xlsx", [HEADER, row("never")])
    return folder


def test_consolidated_expenses(spark, books):
    raw = workbooks.read_workbooks(spark, str(books))
    out = extract.consolidate_expenses(raw, MAP)
    assert out.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.EXPENSES]
    got = {(r["termo"], r["id_codigo_sit"]): r for r in out.collect()}
    assert set(got) == {("71", "E1"), ("71", "E2"), ("71", "E3"), ("71", "E6"), ("72", "")}
    a = got["71", "E1"]
    assert (a["rubrica"], a["tipo_despesa"], a["cpf_cnpj"], a["favorecido"], a["tipo_doc_despesa"]) == (
        "3.1.90.11.99",
        "PESSOAL",
        "12345678901",
        "Ana",
        "",
    )
    assert (a["data_pagamento"], a["data_debito_convenio"]) == (dt.date(2025, 2, 3), dt.date(2025, 2, 4))
    assert (a["valor"], a["id_termo_rubrica"]) == (D("10.50"), "71-3.1.90.11.99")
    assert (got["71", "E2"]["valor"], got["71", "E2"]["cpf_cnpj"]) == (D("1234.56"), "12345678000190")
    assert (got["71", "E3"]["valor"], got["71", "E3"]["data_pagamento"], got["71", "E3"]["data_debito_convenio"]) == (
        D("0.00"),
        dt.date(2025, 2, 3),
        None,
    )
    # number cells with a date format
    assert (got["71", "E6"]["valor"], got["71", "E6"]["data_pagamento"], got["71", "E6"]["data_debito_convenio"]) == (
        D("1234.50"),
        dt.date(2025, 2, 3),
        dt.date(2025, 2, 4),
    )
    assert got["72", ""]["data_debito_convenio"] == dt.date(2025, 2, 4)


def test_workbook_summary_accounts_for_every_file(spark, books):
    raw = workbooks.read_workbooks(spark, str(books))
    got = {r["status"]: (r["arquivos"], r["linhas"]) for r in extract.workbook_summary(raw, MAP).collect()}
    assert got == {
        extract.OK: (3, 7),
        extract.NO_PAYMENT_DATE: (1, 1),
        extract.UNREADABLE: (1, 0),
        extract.UNKNOWN_CONTRACT: (1, 1),
    }
    assert [r["nro_sit"] for r in extract.missing_workbooks(raw, MAP).collect()] == ["90006"]


def test_rows_of_a_broken_file_are_not_used(spark, tmp_path):
    good = tmp_path / "Despesas_SIT_90001.xlsx"
    write_xlsx(good, [HEADER] + [row(f"E{i}") for i in range(20_000)])
    raw = workbooks.read_workbooks(spark, str(tmp_path))
    assert raw.filter("row_no > 0").count() == 20_000
    assert raw.filter("row_no > 0").select("row_no").distinct().count() == 20_000
    import zipfile

    with zipfile.ZipFile(good) as z:
        parts = {n: z.read(n) for n in z.namelist()}
    parts["xl/worksheets/sheet1.xml"] = parts["xl/worksheets/sheet1.xml"][:-400]
    with zipfile.ZipFile(good, "w") as z:
        for name, data in parts.items():
            z.writestr(name, data)
    got = workbooks.read_workbooks(spark, str(tmp_path)).collect()
    assert [(r["row_no"], r["file_status"]) for r in got] == [(0, workbooks.UNREADABLE)]


# --- reports --------------------------------------------------------------------------

REPORT = """Nº SIT;90001
ignored;x
Detalhes dos Rendimentos de Aplicações Financeiras
01/2025;R$ 10,00
T O T A L;R$ 1.250,50
Detalhe das Despesas
Despesa;Previsto;Pago;Saldo;Estornado
3.3.90.30.99 - MATERIAL;1.000,00;500,00;500,00;R$ 25,10
3.1.90.11.99 - PESSOAL;2.000,00;900,00;1.100,00;-
T O T A L;3.000,00;1.400,00;1.600,00;25,10
"""


def put(folder: Path, name: str, text: str, encoding="latin-1", age=0):
    path = folder / name
    path.write_bytes(text.encode(encoding))
    os.utime(path, (1_700_000_000 - age, 1_700_000_000 - age))


def parsed(spark, folder):
    texts = reports.read_texts(spark, str(folder))
    contracts = {r["nro_sit"]: r[1] for r in reports.contract_summary(texts).collect()}
    lines = {r["id_termo_rubrica"]: r["valor_estornado"] for r in reports.line_summary(texts).collect()}
    return contracts, lines, texts


def test_report(spark, tmp_path):
    put(tmp_path, "a.csv", REPORT)
    contracts, lines, texts = parsed(spark, tmp_path)
    assert contracts == {"90001": D("1250.50")}
    assert lines == {"90001-3.3.90.30.99": D("25.10"), "90001-3.1.90.11.99": D("0.00")}
    assert reports.contract_summary(texts).schema == schemas.CONTRACT_SUMMARY
    assert reports.line_summary(texts).schema == schemas.LINE_SUMMARY


def test_report_encodings_line_ends_and_order(spark, tmp_path):
    put(tmp_path, "utf8.csv", "﻿" + REPORT.replace("90001", "90002").replace("\n", "\r\n"), "utf-8")
    put(tmp_path, "old.csv", REPORT.replace("25,10", "99,99").replace("1.250,50", "1,00"), age=100)
    put(tmp_path, "new.csv", REPORT)
    put(tmp_path, "none.csv", REPORT.replace("Nº SIT", "Num"))
    put(tmp_path, "empty.csv", "")
    contracts, lines, texts = parsed(spark, tmp_path)
    assert contracts == {"90001": D("1250.50"), "90002": D("1250.50")}
    assert lines["90001-3.3.90.30.99"] == D("25.10") and lines["90002-3.3.90.30.99"] == D("25.10")
    # Spark does not list files of no length
    assert {r["status"]: r["arquivos"] for r in extract.report_summary(reports.parse(texts)).collect()} == {"ok": 3, "ignored": 1}


def section(spark, tmp_path, text):
    put(tmp_path, "r.csv", text)
    return parsed(spark, tmp_path)[:2]


def test_report_sections(spark, tmp_path):
    mark, spend = S.MARK_INCOME, S.MARK_EXPENSES
    contracts, lines = section(
        spark,
        tmp_path,
        # nothing counts before the number
        f"{mark}\nT O T A L;5,00\n{spend}\n1.1 - X;1;1;1;1,00\n"
        f"Nº SIT\nNº SIT; 7 ;x\n"
        # a total without a section, then two sections: the last total counts
        f"T O T A L;6,00\n  {mark}\nT O T A L;7,00\nT O T A L;8,00\n{mark}\nT O T A L;9,00\n{mark}\nT O T A L\n"
        f"{spend}\n\nDespesa;a;b;c;d\n2.2-A-B;1;1;1;2,00\n2.3;1;1;1\n - ;1;1;1;3,00\n"
        # the expense section has no end; a later number renames the file
        f"{mark}\n2.4 - Z;1;1;1;4,00;6\nT O T A L;1;1;1;5,00\n{spend};1;1;1;1\nNº SIT;8;1;1;1;1\n2.2;1;1;1;2,50\n",
    )
    # the total after the last income section stands in the expense section and still counts
    assert contracts == {"8": D("1.00")}
    assert lines == {"8-2.2": D("2.50"), "8-2.4": D("4.00")}


def test_report_with_a_blank_number_is_ignored(spark, tmp_path):
    assert section(spark, tmp_path, REPORT + "Nº SIT; \n3.3 - X;1;1;1;1,00\n") == ({}, {})


# --- staging, stored tables, lookups --------------------------------------------------


def test_csv_round_trip(spark, tmp_path):
    rows = [("1", "á;b", dt.date(2025, 2, 3), D("10.50")), ("2", None, None, None)]
    schema = "id_codigo_sit string, favorecido string, data_pagamento date, valor decimal(18,2)"
    df = spark.createDataFrame(rows, schema)
    staging.write_csv(df, str(tmp_path / "s"))
    text = staging.read_text_columns(spark, str(tmp_path / "s"), df.columns)
    assert {t for _, t in text.dtypes} == {"string"}
    assert sorted(map(tuple, staging.read_typed(spark, str(tmp_path / "s"), df.schema).collect())) == sorted(rows)


def test_typed_read_accepts_ids_with_a_decimal_point(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id_termo,nro_sit\n7.0,90001\nx,1\n")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id_termo", T.IntegerType()), T.StructField("nro_sit", T.StringType())])
    assert [tuple(r) for r in staging.read_typed(spark, str(tmp_path / "x.csv"), schema).collect()] == [(7, "90001"), (None, "1")]


def test_runs_are_kept_apart_and_repeatable(spark, tmp_path):
    base = str(tmp_path)
    staging.write_run(spark.range(3), base, "t", 1)
    staging.write_run(spark.range(5), base, "t", 2)
    staging.write_run(spark.range(4), base, "t", 2)
    assert staging.read_run(spark, base, "t", 1).count() == 3
    assert staging.read_run(spark, base, "t", 2).count() == 4
    empty = staging.write_run(spark.range(0), base, "t", 3)
    assert empty.count() == 0 and empty.columns == ["id"]


def test_stored_tables(spark, tmp_path):
    rows = [tuple("1" if c == "id_codigo_sit" else None for c in S.EXPENSE_COLUMNS), (None,) * 13]
    spark.createDataFrame(rows, schemas.EXPENSES).withColumn("id", F.lit(1)).write.parquet(str(tmp_path / "d"))
    out = stored.stored_expenses(stored.read_table(spark, str(tmp_path / "d")))
    assert out.columns == list(S.EXPENSE_COLUMNS) and out.count() == 1
    spark.createDataFrame([(1, 2, D("3.00"))], "id_termo int, nro_sit int, rendimento_financeiro_total decimal(18,2)").createOrReplaceTempView("termos_v")
    assert stored.contract_map(stored.read_table(spark, "termos_v")).first() == (1, 2)
    assert stored.stored_income(spark.table("termos_v")).first() == (2, D("3.00"))
    assert stored.run_query(spark, "SELECT nro_sit FROM termos_v WHERE id_termo = :id", {"id": 1}).first()[0] == 2
    assert stored.run_query(spark, "SELECT 1 AS x").first()[0] == 1
    assert stored.table_exists(spark, "termos_v") and not stored.table_exists(spark, "no_such_table")
    lines = spark.createDataFrame([("7-1", D("1.00"), 5)], "id_termo_rubrica string, valor_estornado decimal(18,2), x int")
    assert stored.stored_refunds(lines).columns == ["id_termo_rubrica", "valor_estornado"]


def test_bucketed_table_is_joined_without_a_shuffle_of_its_own(spark):
    spark.sql("DROP TABLE IF EXISTS ledger_b")
    stored.write_bucketed(spark.range(100).select(F.col("id").cast("string").alias("k")), "ledger_b", "k", 4)
    one, two = spark.table("ledger_b"), spark.range(50).select(F.col("id").cast("string").alias("k"))
    plan = one.join(two.hint("merge"), "k")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_jdbc_options():
    assert stored.jdbc_options("jdbc:x", table="t", user="u", split_by="id", lower=1, upper=9, splits=4) == {
        "url": "jdbc:x",
        "dbtable": "t",
        "user": "u",
        "batchsize": "10000",
        "fetchsize": "10000",
        "partitionColumn": "id",
        "lowerBound": "1",
        "upperBound": "9",
        "numPartitions": "4",
    }
    assert stored.jdbc_options("jdbc:x", query="select 1")["query"] == "select 1"
    for bad in ({}, {"table": "t", "query": "q"}, {"query": "q", "split_by": "id"}, {"table": "t", "split_by": "id"}):
        with pytest.raises(ValueError):
            stored.jdbc_options("jdbc:x", **bad)


def test_lookups_and_landing(spark, books):
    assert dict(map(tuple, lookups.contract_numbers(spark).collect())) == S.CONTRACT_BY_SIT
    assert [r["classe"] for r in lookups.class_rules(spark).orderBy("prioridade").collect()] == [c for _, c in S.EXPENSE_CLASSES]
    (books / "r.csv").write_text("x")
    (books / "old.xls").write_text("x")
    (books / "note.txt").write_text("x")
    files = landing.landed_files(spark, str(books))
    assert {r["extension"]: r["arquivos"] for r in landing.count_by_extension(files).collect()} == {"xlsx": 7, "csv": 1, "xls": 1}


def test_buckets_write_in_proportion_to_changes(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])

    def replace(old, new):
        last = new.groupBy("k").agg(F.max_by("v", "_step").alias("v"))
        return old.join(last.select("k"), "k", "left_anti").unionByName(last)

    table = Buckets(spark, str(tmp_path / "t"), "k", schema, replace, buckets=8, keep=2)
    rows = [(str(i), i) for i in range(400)] + [(None, -1)]
    assert table.write(spark.createDataFrame(rows, schema), 0).count() == 401

    def files():
        return {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet") if "manifest" not in str(p)}

    before = files()
    after = table.change(spark.createDataFrame([("7", 700), ("new", 1)], schema), 0, 1)
    want = {**dict(rows), "7": 700, "new": 1}
    assert {r["k"]: r["v"] for r in after.collect()} == want
    now = files()
    assert before.items() <= now.items()  # nothing that lay there was written again
    new = [p for p in now if p not in before]
    assert len(new) <= 2 and all("changes" in str(p) for p in new)
    assert sum(spark.read.parquet(str(p)).count() for p in new) == 2
    assert {r["k"]: r["v"] for r in table.read(0).collect()} == dict(rows)
    # an empty change set writes no rows; versions beyond the kept ones go
    table.change(spark.createDataFrame([], schema), 1, 2)
    assert table.versions() == [1, 2] and {r["k"]: r["v"] for r in table.read(2).collect()} == want
    # changes of several steps are folded in their order
    table.change(spark.createDataFrame([("7", 701)], schema), 2, 3)
    assert {r["k"]: r["v"] for r in table.read(3).collect()} == {**want, "7": 701}
    assert {r["k"]: r["v"] for r in table.read(2).collect()} == want
    # a step done again leaves the same behind
    again = table.change(spark.createDataFrame([("7", 701)], schema), 2, 3)
    assert {r["k"]: r["v"] for r in again.collect()} == {**want, "7": 701}
    # a bucket whose changes exceed the share of its rows is written whole; the others are not
    seven = next(b for b, h in table.manifest(3).items() if len(h.steps) == 2)
    keys = [r["k"] for r in table.read(3).filter(table.bucket() == seven).collect()]
    much = table.change(spark.createDataFrame([(k, 9) for k in keys], schema), 3, 4)
    assert {r["k"]: r["v"] for r in much.collect()} == {**want, **dict.fromkeys(keys, 9)}
    held = table.manifest(4)
    assert held[seven] == (4, (), len(keys), 0) and {h.version for b, h in held.items() if b != seven} <= {0}
    assert not [p for p in files() if f"bucket={seven}" in str(p) and "version=0" in str(p) and 0 in table.versions()]


def test_a_comparison_does_not_shuffle_a_clustered_ledger(spark):
    spark.sql("DROP TABLE IF EXISTS ledger_c")
    fields = ("valor", "termo")
    stored.write_bucketed(spark.range(500).selectExpr("cast(id as string) id_codigo_sit", "'a' termo", "1.0 valor"), "ledger_c", "id_codigo_sit", 4)
    new = spark.range(300, 700).selectExpr("cast(if(id % 3 = 0, 300, id) as string) id_codigo_sit", "if(id % 2 = 0, 'a', 'b') termo", "1.0 valor")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        how = {"fields": fields, "clustered": True}
        apart = changes.classify(new, spark.table("ledger_c"), **how)
        assert apart._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        hot = changes.hot_keys(new, share=0.1)
        assert hot == ["300"] and changes.hot_keys(new, share=0.9) == []
        split = changes.classify(new, spark.table("ledger_c"), hot=hot, **how)
        assert split._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        want = sorted(map(tuple, changes.classify(new, spark.table("ledger_c"), fields=fields).collect()))
        assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, split.collect())) == want
        assert {r[-1] for r in want} == {"INSERT", "UPDATE", "IGNORE"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")


def test_large_report_line_by_line(spark):
    """One report of 100,000 lines with 10,000 marks, against a plain state machine."""
    rng = random.Random(8)
    written = []
    for i in range(100_000):
        if i % 10:
            written.append(rng.choice([f"3.1.90.{i % 50} - X;1;2;3;{i % 7},50", "", f"3.3;1;2;3;R$ {i}", "curta;1"]))
        else:
            written.append(rng.choice([f"{S.MARK_SIT};{i}", f"{S.MARK_SIT}; ", S.MARK_INCOME, f"{S.MARK_TOTAL};R$ {i},00", f"x {S.MARK_EXPENSES}"]))
    written.append(f"{S.MARK_SIT};77")
    df = spark.createDataFrame([("f", None, "\n".join(written))], "source_file string, modified timestamp, content string")
    number, income, flowing, total, spending, tagged, rows = None, False, False, None, False, [], []
    for pos, line in enumerate(x.strip() for x in written):
        before, section = number, None
        if line.startswith(S.MARK_SIT):
            number = line.split(";")[1].strip() or None
        elif number and S.MARK_INCOME in line:
            income = flowing = True
        elif number and line.startswith(S.MARK_TOTAL):
            if flowing:
                total = D(line.split(";")[1].replace("R$ ", "").replace(",", "."))
            income = flowing = False
        elif number and S.MARK_EXPENSES in line:
            # the section begins below its mark, and ends the income
            income, section, spending = False, "expenses" if spending else "none", True
        elif number and spending and len(line.split(";")) >= 5:
            parts = line.split(";")
            rows.append((pos, parts[0].split("-")[0].strip(), D(parts[4].replace("R$ ", "").replace(",", "."))))
        if line:
            tagged.append((pos, before, section or ("expenses" if spending else "income" if income else "none"), line))
    parsed = reports.parse(df)
    assert sorted((r.pos, r.rubrica, r.valor_estornado) for r in reports.lines_of(parsed).collect()) == rows
    first = parsed.select("nro_sit", "rendimento_financeiro_total").first()
    assert tuple(first) == (number, total)
    assert sorted((r.pos, r.nro_sit, r.section, r.line) for r in reports.tagged_lines(df).collect()) == tagged


def test_damaged_lines_are_set_apart(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b,c\n1,2,3\n4,5\n"6, x",7,8\n1,2,3,4\n,,\n"9,1,2\n')
    good, damaged = staging.read_checked(spark, str(tmp_path / "x.csv"), ["a", "b", "c"])
    assert sorted(map(tuple, good.collect()), key=str) == [("1", "2", "3"), ("6, x", "7", "8"), (None, None, None)]
    assert sorted(r[staging.DAMAGED] for r in damaged.collect()) == ['"9,1,2', "1,2,3,4", "4,5"]
    assert good.select("b").count() == 3 and damaged.select(staging.DAMAGED, "a").count() == 3


def test_a_large_sheet_is_handed_out_in_constant_memory(tmp_path):
    peaks = {}
    for n in (20_000, 120_000):
        book = tmp_path / f"{n}.xlsx"
        write_xlsx(book, [["Código", "Valor"], *([f"E{i}", i] for i in range(n))])
        content = book.read_bytes()
        tracemalloc.start()
        rows = sum(len(part[2]) for part in workbooks.decoded(content, ["Código", "Valor"]))
        peaks[n] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == n + 1  # row 0 stands for the file
    assert peaks[120_000] < 1.3 * peaks[20_000]
