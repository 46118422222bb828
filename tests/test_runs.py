"""The full run, the landing stream and the registered queries."""

from __future__ import annotations

import datetime as dt
import os
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import D, write_xlsx
from pyspark.sql import functions as F
from test_sources import HEADER, MAP, REPORT, put, row

from grantloom import catalog, oracle, schemas
from grantloom.operators import changes, settle
from grantloom.plans import extract, full_run
from grantloom.sources import landed_source, reports, staging, stored
from grantloom.streaming import landing

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import check  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

SMALL = "/root/testdata/sf0.001"
AS_OF = dt.date(2025, 6, 15)


def empty(spark, schema, **columns):
    return spark.createDataFrame([tuple(columns.get(n) for n in schema.fieldNames())], schema)


@pytest.fixture
def ledger(spark):
    contract = empty(
        spark,
        schemas.CONTRACTS,
        id_termo=71,
        nro_sit=90001,
        data_inicio_vigencia=dt.date(2025, 1, 1),
        data_fim_vigencia=dt.date(2025, 12, 31),
        rendimento_financeiro_total=D("1.00"),
    )
    lines = empty(spark, schemas.LINES, id_termo_rubrica="71-3.1.90.11.99", saldo_inicial_previsto=D("15.00")).unionByName(
        empty(spark, schemas.LINES, id_termo_rubrica="71-3.3.90.30.99", saldo_inicial_previsto=D("100.00"), valor_estornado=D("0.00"))
    )
    return full_run.Ledger(spark.createDataFrame([], schemas.EXPENSES), contract, lines)


def landed(folder, amount="10.50"):
    folder.mkdir(exist_ok=True)
    lost = [row("E8", day=""), row("E9", day="31/02/2025"), row("E10", kind="sem código")]
    write_xlsx(folder / "Despesas_SIT_90001.xlsx", [HEADER, row("E1", amount=amount), row("E2"), row("", amount="1.00"), *lost])
    put(folder, "r.csv", REPORT)
    return str(folder)


def test_full_run(spark, ledger, tmp_path):
    folder, out = landed(tmp_path / "in"), str(tmp_path / "out")
    only = full_run.run(spark, folder, ledger, out, "0", AS_OF, approved=False, mapping=MAP)
    assert only.ledger is ledger and only.line_log is None
    assert {r["acao"]: r["registros"] for r in only.counts.collect()} == {"INSERT": 2}
    assert sorted({r["secao"] for r in only.preview.collect()}) == ["DESPESAS", "RUBRICAS", "TERMOS"]
    why = {(r["id_codigo_sit"], r["row_no"]): r["motivo"] for r in only.rejected.collect()}
    assert why == {("", 3): extract.NO_KEY, ("E8", 4): extract.NO_DATE, ("E9", 5): extract.BAD_DATE, ("E10", 6): extract.NO_CODE}
    read = {r["motivo"]: r["linhas"] for r in only.read.collect()}
    assert read == {extract.OK: 2, **dict.fromkeys(extract.REASONS, 1)}

    done = full_run.run(spark, folder, ledger, out, "1", AS_OF, approved=True, mapping=MAP)
    assert done.ledger.expenses.count() == 2
    lines = {r["id_termo_rubrica"]: r for r in done.ledger.lines.collect()}
    spent = lines["71-3.1.90.11.99"]
    assert (spent["saldo_total_gasto"], spent["saldo_atual"], spent["executado"]) == (D("21.00"), D("-6.00"), "140,00%")
    assert lines["71-3.3.90.30.99"]["valor_estornado"] == D("25.10")
    contract = done.ledger.contracts.first()
    assert contract["rendimento_financeiro_total"] == D("1250.50")
    assert contract["rendimento_financeiro_atual"] == D("1244.50")
    assert contract["saldo_atual"] == D("-6.00") + D("125.10") + D("1250.50")
    # money is conserved between lines and contract
    assert contract["saldo_total_gasto"] == sum(r["saldo_total_gasto"] for r in lines.values())
    assert done.line_log.count() == 2 and done.contract_log.count() == 1
    full_run.register_views(done.ledger, AS_OF)
    top = spark.sql("SELECT r.id_termo_rubrica FROM vw_rubricas_calc v JOIN rubricas r USING (id_termo_rubrica) ORDER BY v.saldo_total_gasto DESC")
    assert top.first()[0] == "71-3.1.90.11.99"
    assert spark.sql("SELECT saldo_total_gasto FROM vw_termos_calc").first()[0] == D("21.00")

    again = full_run.run(spark, folder, done.ledger, out, "2", AS_OF, approved=True, mapping=MAP)
    assert {r["acao"]: r["registros"] for r in again.counts.collect()} == {"IGNORE": 2}
    assert again.preview.count() == 0
    assert not again.changes.any() and done.changes.any()
    assert again.ledger.contracts.collect() == done.ledger.contracts.collect()

    landed(tmp_path / "in", "11.00")
    third = full_run.run(spark, folder, again.ledger, out, "3", AS_OF, approved=True, mapping=MAP)
    assert {r["acao"]: r["registros"] for r in third.counts.collect()} == {"IGNORE": 1, "UPDATE": 1}
    assert third.ledger.expenses.agg(F.sum("valor")).first()[0] == D("21.50")


def test_of_several_reports_the_latest_counts(spark, ledger, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, when, refund in (("a.csv", 2_000, "9,00"), ("b.csv", 1_000, "70,00")):
        put(folder, name, REPORT.replace("25,10", refund))
        os.utime(folder / name, (when, when))
    texts = reports.read_texts(spark, str(folder))
    found = full_run.find_changes(spark.createDataFrame([], schemas.EXPENSES), texts, ledger)
    assert {r["id_termo_rubrica"]: r["valor_estornado"] for r in found.refunds.collect()}["71-3.3.90.30.99"] == D("9.00")


def test_questions_leave_no_names_behind(spark, ledger):
    spark.range(3).createOrReplaceTempView("termos")
    before = {t.name for t in spark.catalog.listTables()}
    got = full_run.ask(spark, "SELECT nro_sit FROM {termos} WHERE id_termo = :id", ledger, {"id": 71})
    assert [r[0] for r in got.collect()] == [90001]
    assert {t.name for t in spark.catalog.listTables()} == before and spark.table("termos").count() == 3
    spark.catalog.dropTempView("termos")


def test_a_run_compares_with_a_clustered_ledger(spark, ledger, tmp_path):
    folder, out = landed(tmp_path / "in"), str(tmp_path / "out")
    done = full_run.run(spark, folder, ledger, out, "1", AS_OF, approved=True, mapping=MAP)
    spark.sql("DROP TABLE IF EXISTS ledger_run")
    stored.write_bucketed(done.ledger.expenses, "ledger_run", "id_codigo_sit", 4)
    there = full_run.Ledger(spark.table("ledger_run"), done.ledger.contracts, done.ledger.lines, clustered=True)
    again = full_run.run(spark, folder, there, out, "2", AS_OF, mapping=MAP)
    assert {r["acao"]: r["registros"] for r in again.counts.collect()} == {"IGNORE": 2}


def test_landing_stream_takes_each_file_once(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    folder.mkdir()

    def base(session):
        return session.createDataFrame([], schemas.EXPENSES)

    def take():
        landing.landing_stream(spark, str(folder), base, out, checkpoint, MAP).awaitTermination()

    write_xlsx(folder / "Despesas_SIT_90001.xlsx", [HEADER, row("E1"), row("E2"), row("")])
    take()
    first = staging.read_run(spark, out, "despesas", 0)
    assert first.count() == 2 and staging.read_run(spark, out, "rejeitadas", 0).count() == 1
    take()  # nothing new
    write_xlsx(folder / "Despesas_SIT_90002.xlsx", [HEADER, row("E1", amount="99.00"), row("E3")])
    take()
    got = {r["id_codigo_sit"]: (r["termo"], r["valor"]) for r in staging.read_run(spark, out, "despesas", 1).collect()}
    assert got == {"E1": ("72", D("99.00")), "E2": ("71", D("10.50")), "E3": ("72", D("10.50"))}
    # a repeated batch leaves the same version behind
    files = spark.read.format("binaryFile").load(str(folder / "Despesas_SIT_90002.xlsx"))
    landing.batch_writer(base, out, MAP)(files, 1)
    assert staging.read_run(spark, out, "despesas", 1).count() == 3
    assert changes.count_actions(staging.read_run(spark, out, "mudancas", 1)).count() == 2


def test_landing_stream_takes_a_recurring_name_again(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    folder.mkdir()
    book = folder / "Despesas_SIT_90001.xlsx"

    def base(session):
        return session.createDataFrame([], schemas.EXPENSES)

    def take():
        query = landing.landing_stream(spark, str(folder), base, out, checkpoint, MAP, recurring=True, rest=0.0)
        query.awaitTermination()
        return len([p for p in Path(out, "despesas").glob("run_id=*")])

    def amounts(batch):
        return {r["id_codigo_sit"]: r["valor"] for r in staging.read_run(spark, out, "despesas", batch).collect()}

    write_xlsx(book, [HEADER, row("E1"), row("E2")])
    (folder / "notes.txt").write_text("no workbook")
    os.utime(book, (1_000, 1_000))
    assert take() == 1 and amounts(0) == {"E1": D("10.50"), "E2": D("10.50")}
    assert take() == 1  # nothing new
    # the same name again, at a later time, in the same checkpoint, beside one with the time of the first
    write_xlsx(book, [HEADER, row("E1", amount="99.00"), row("E3")])
    os.utime(book, (2_000, 2_000))
    write_xlsx(folder / "Despesas_SIT_90002.xlsx", [HEADER, row("E4")])
    os.utime(folder / "Despesas_SIT_90002.xlsx", (1_000, 1_000))
    assert take() == 2
    assert amounts(1) == {"E1": D("99.00"), "E2": D("10.50"), "E3": D("10.50"), "E4": D("10.50")}
    assert take() == 2
    # a file removed after it was taken changes nothing
    book.unlink()
    write_xlsx(folder / "Despesas_SIT_90002.xlsx", [HEADER, row("E4", amount="7.00")])
    assert take() == 3 and amounts(2)["E4"] == D("7.00") and len(amounts(2)) == 4
    with pytest.raises(ValueError, match="one batch"):
        landing.landing_stream(spark, str(folder), base, out, checkpoint, MAP, files_per_batch=1, recurring=True)


def test_landed_source_plans_by_time_path_and_length(tmp_path):
    def put_file(name, when, size):
        (tmp_path / name).write_bytes(b"x" * size)
        os.utime(tmp_path / name, (when, when))

    reader = landed_source.LandedReader(str(tmp_path), "*.bin", 0.0)
    assert reader.latestOffset() == reader.initialOffset() and reader.partitions(reader.initialOffset(), reader.latestOffset()) == []
    put_file("b.bin", 100, 3)
    put_file("a.bin", 100, 5)
    put_file("c.bin", 50, 2)
    put_file("d.txt", 300, 2)
    end = reader.latestOffset()
    assert end == {"time": 100_000_000, "path": f"{tmp_path}/b.bin", "length": 3}
    files = [f for s in reader.partitions(reader.initialOffset(), end) for f in s.files]
    assert [f.path.rsplit("/", 1)[1] for f in files] == ["c.bin", "a.bin", "b.bin"]
    # replaced between planning and reading: no row now, and a place after the offset later
    put_file("a.bin", 200, 5)
    (tmp_path / "c.bin").unlink()
    batches = list(reader.read(landed_source.Share(tuple(files))))
    assert [(b.column("path")[0].as_py(), b.column("content")[0].as_py()) for b in batches] == [(f"{tmp_path}/b.bin", b"xxx")]
    later = reader.latestOffset()
    assert [f.path for s in reader.partitions(end, later) for f in s.files] == [f"{tmp_path}/a.bin"]
    # one not yet rested waits, and the offset does not go back when files go
    waiting = landed_source.LandedReader(str(tmp_path), "*.bin", 3600.0)
    (tmp_path / "new.bin").write_bytes(b"y")
    assert waiting.latestOffset() == later
    (tmp_path / "a.bin").unlink()
    assert waiting.latestOffset() == later
    # tasks hold neighbouring files up to a size, and a large file has one of its own
    sized = [landed_source.Landed(i, str(i), n) for i, n in enumerate((4, 4, 9, 30, 1, 1))]
    assert [[f.length for f in s.files] for s in landed_source.shares(sized, 10)] == [[4, 4], [9], [30], [1, 1]]


def test_a_file_that_lands_again_under_its_name_is_taken_again(spark, ledger, tmp_path):
    folder, out = landed(tmp_path / "in"), str(tmp_path / "out")

    def take():
        return landing.take_landed(spark, folder, ledger, out, AS_OF, MAP)

    first = take()
    assert first.ledger.expenses.count() == 2 and {r["status"] for r in first.reports.collect()}
    assert first.ledger.contracts.first()["rendimento_financeiro_total"] == D("1250.50")
    assert first.missing.count() == len(MAP) - 1
    assert take() is None
    landed(tmp_path / "in", "11.00")
    for name in ("Despesas_SIT_90001.xlsx", "r.csv"):
        os.utime(Path(folder) / name, (2_000_000_000, 2_000_000_000))
    second = take()
    assert second.ledger.expenses.agg(F.sum("valor")).first()[0] == D("21.50")
    assert take() is None
    number, now = landing.latest_ledger(spark, out, ledger)
    assert number == 1 and now.expenses.count() == 2


def test_settled_results_go_to_the_folder_the_session_names(spark):
    folder = Path(settle.shared_folder(spark))
    assert folder.name.startswith("shared-")
    before = set(folder.glob("settled-*"))
    out = settle.settle(spark.range(5))
    assert out.count() == 5 and len(set(folder.glob("settled-*")) - before) == 1


def test_settled_results_are_deleted(spark):
    folder = Path(settle.shared_folder(spark))
    before = set(folder.glob("settled-*"))
    settle.unsettle(settle.settle(spark.range(5)))
    assert set(folder.glob("settled-*")) == before


def test_a_shared_folder_must_be_named():
    context = SimpleNamespace(getConf=lambda: {})
    nameless = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        settle.shared_folder(nameless)


# the scans look into the files for their columns each time, or read files that they write first
SCANS = {"stored_scans", "staging_round_trip", "report_scan", "landed_files"}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - SCANS))
def test_building_a_query_runs_no_job_and_writes_nothing(spark, name):
    folder = Path(settle.shared_folder(spark))
    before = set(folder.glob("settled-*"))
    catalog.QUERIES[name](spark, SMALL)  # reads schemas, once
    spark.sparkContext.setJobGroup(f"build-{name}", name)
    try:
        catalog.QUERIES[name](spark, SMALL)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert set(folder.glob("settled-*")) == before


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["id_termo_rubrica", "data_atual", "dias_restantes", "saldo_total_gasto", "media_mensal_gastos"]
    assert df.count() > 0


@pytest.fixture(scope="module")
def duck():
    return check.connect(SMALL)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    ok, note = check.compare(spark, duck, SMALL, name)
    assert ok, note
