from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from conftest import D
from pyspark.sql import Window
from pyspark.sql import functions as F

from grantloom import catalog
from grantloom import settings as S
from grantloom.operators import apply, changes, checks, dedup, reconcile, skew
from grantloom.operators.once import compute_once
from grantloom.schemas import EXPENSES


def expense(key, valor="10.00", **more):
    row = dict.fromkeys(S.EXPENSE_COLUMNS, "") | {
        "id_codigo_sit": key,
        "termo": "6373",
        "data_pagamento": dt.date(2025, 2, 3),
        "data_debito_convenio": None,
        "valor": D(valor),
    }
    return tuple((row | more)[c] for c in S.EXPENSE_COLUMNS)


def expenses(spark, *rows):
    return spark.createDataFrame(list(rows), EXPENSES)


def actions(df):
    return sorted((r["id_codigo_sit"], str(r["valor"]), r["acao"]) for r in df.collect())


# --- change detection -----------------------------------------------------------------


def test_classify(spark):
    stored = expenses(spark, expense("same"), expense("changed", "1.00"), expense("gone"), expense(None))
    new = expenses(spark, expense("same"), expense("changed"), expense("new"), expense("new"), expense(""), expense(None))
    assert actions(changes.classify(new, stored)) == [
        ("changed", "10.00", "UPDATE"),
        ("new", "10.00", "INSERT"),
        ("new", "10.00", "INSERT"),
        ("same", "10.00", "IGNORE"),
    ]
    assert changes.split_keyless(new)[1].count() == 2
    assert [r["id_codigo_sit"] for r in changes.new_rows(new, stored).collect()] == ["new", "new"]
    assert {r["acao"]: r["registros"] for r in changes.count_actions(changes.classify(new, stored)).collect()} == {
        "INSERT": 2,
        "UPDATE": 1,
        "IGNORE": 1,
    }


def test_blank_and_null_are_no_change(spark):
    stored = expenses(spark, expense("1", favorecido=None, tipo_doc_despesa=None))
    assert changes.detect_changes(expenses(spark, expense("1")), stored).count() == 0


def test_empty_sides(spark):
    none = expenses(spark)
    assert actions(changes.classify(expenses(spark, expense("1")), none)) == [("1", "10.00", "INSERT")]
    assert changes.classify(none, expenses(spark, expense("1"))).count() == 0


def test_apply_updates_all_rows_of_a_key_last_update_wins(spark):
    stored = expenses(spark, expense("a", "1.00"), expense("a", "2.00"), expense("b", favorecido="X"), expense(None, "5.00"))
    found = expenses(
        spark,
        expense("a", "7.00"),
        expense("a", "3.00"),
        expense("b", favorecido=None),
        expense("n"),
        expense("n"),
    ).select(
        "*",
        F.when(F.col("id_codigo_sit") == "n", S.INSERT).otherwise(S.UPDATE).alias("acao"),
        F.when(F.col("valor") == 3, 2).otherwise(1).alias("seq"),
    )
    after = apply.apply_expense_changes(stored, found, order=("seq",))
    got = sorted((str(r["id_codigo_sit"]), str(r["valor"]), str(r["favorecido"])) for r in after.collect())
    assert got == [
        ("None", "5.00", ""),
        ("a", "3.00", ""),
        ("a", "3.00", ""),
        ("b", "10.00", "None"),
        ("n", "10.00", ""),
        ("n", "10.00", ""),
    ]
    assert after.columns == stored.columns and after.schema == stored.schema


def test_second_run_finds_nothing(spark):
    stored = expenses(spark, expense("a", "1.00"), expense("a", "2.00"), expense("c"))
    new = expenses(spark, expense("a"), expense("b"), expense("b"), expense("c"))
    after = apply.apply_expense_changes(stored, changes.detect_changes(new, stored))
    assert changes.detect_changes(new, after).count() == 0
    assert after.count() == 5


def test_preview_counts_and_samples(spark):
    new = expenses(spark, *[expense(str(i)) for i in range(5)])
    found = changes.detect_changes(new, expenses(spark))
    income = spark.createDataFrame([("9", D("1.00"))], "nro_sit string, rendimento_financeiro_total_csv decimal(18,2)")
    refunds = spark.createDataFrame([], "id_termo_rubrica string, valor_estornado decimal(18,2)")
    got = sorted((r["secao"], r["chave"], r["registros"]) for r in changes.preview_run(found, income, refunds).collect())
    assert got == [("DESPESAS", "0", 5), ("DESPESAS", "1", 5), ("DESPESAS", "2", 5), ("TERMOS", "9", 1)]
    assert changes.preview(found).count() == 3


# --- reconcile ------------------------------------------------------------------------

CONTRACTS = "id_termo int, nro_sit int, rendimento_financeiro_total decimal(18,2)"


def test_reconcile_and_apply_income(spark):
    contracts = spark.createDataFrame(
        [(1, 101, D("5.00")), (2, 102, D("5.00")), (3, 103, None), (4, 104, D("5.00")), (5, 105, D("1.00"))], CONTRACTS
    )
    reported = spark.createDataFrame(
        [("101.0", D("5.01"), 1), ("102", D("9.00"), 1), ("102.0", D("5.02"), 2), ("103", D("7.00"), 1), ("999", D("1.00"), 1)],
        "nro_sit string, rendimento_financeiro_total decimal(18,2), seq int",
    )
    updates = reconcile.reconcile_income(reported, contracts, order=("seq",))
    assert [tuple(r) for r in updates.collect()] == [("102", D("5.02"))]
    after = apply.apply_income(contracts, updates)
    assert {r["id_termo"]: r["rendimento_financeiro_total"] for r in after.collect()} == {
        1: D("5.00"),
        2: D("5.02"),
        3: None,
        4: D("5.00"),
        5: D("1.00"),
    }
    assert after.schema == contracts.schema


def test_reconcile_and_apply_refunds(spark):
    contracts = spark.createDataFrame([(11, 101, None), (12, 102, None)], CONTRACTS)
    lines = spark.createDataFrame(
        [("11-3.1", D("1.00")), ("11-3.2", D("1.00")), ("12-3.1", None), ("101-3.1", D("9.00"))],
        "id_termo_rubrica string, valor_estornado decimal(18,2)",
    )
    reported = spark.createDataFrame(
        [("101", "3.1", D("2.50")), ("101.0", "3.2", D("1.01")), ("102", "3.1", D("4.00")), ("999", "3.1", D("8.00"))],
        "nro_sit string, rubrica string, valor_estornado decimal(18,2)",
    )
    updates = reconcile.reconcile_lines(reported, contracts, lines)
    assert [tuple(r) for r in updates.collect()] == [("11-3.1", D("2.50"))]
    assert updates.columns == ["id_termo_rubrica", "valor_estornado"]
    after = {r[0]: r[1] for r in apply.apply_refunds(lines, updates).collect()}
    assert after == {"11-3.1": D("2.50"), "11-3.2": D("1.00"), "12-3.1": None, "101-3.1": D("9.00")}


def orders_of(spark, folder):
    """Two orders of one line, the later with a key divisible by eleven, and their customer."""
    spark.createDataFrame(
        [(1, 7, "F", 100.0, dt.datetime(1995, 1, 1), "1-URGENT"), (22, 7, "F", 900.0, dt.datetime(1996, 1, 1), "1-URGENT")],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
    ).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(
        [(7, "C", 3, 10.0, "BUILDING")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ).write.parquet(f"{folder}/customer.parquet")
    return str(folder)


def test_every_order_is_reported_to_reconcile_lines(spark, tmp_path):
    updates = catalog.QUERIES["reconcile_lines"](spark, orders_of(spark, tmp_path)).collect()
    assert [tuple(r) for r in updates] == [("7-1-URGENT", D("9.00"))]


def test_every_order_is_reported_to_apply_refunds(spark, tmp_path):
    after = catalog.QUERIES["apply_refunds"](spark, orders_of(spark, tmp_path)).collect()
    assert [(r["id_termo_rubrica"], r["valor_estornado"]) for r in after] == [("7-1-URGENT", D("9.00"))]


# --- de-duplication -------------------------------------------------------------------


def test_last_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", None, None), (None, 1, "n")], "k string, t int, v string")
    assert sorted(map(str, dedup.last_per_key(df, ["k"], ("t",)).collect())) == sorted(
        map(str, df.filter("t = 3 or k = 'b' or k is null").collect())
    )
    assert {r[0]: r[1] for r in dedup.last_value_map(df, "k", "v", ("t",)).collect()} == {"a": "y", "b": None}


# --- checks ---------------------------------------------------------------------------


def test_required_columns(spark):
    df = spark.range(1)
    assert checks.require_columns(df, ["id"]) is df
    with pytest.raises(checks.MissingColumns, match="a, b"):
        checks.require_columns(df, ["b", "id", "a"])


def test_header_spellings_and_union(spark):
    first = spark.createDataFrame([("1",)], "a string")
    second = spark.createDataFrame([("2", "q")], "b string, extra string")
    parts = [f.select(checks.first_spelling(f, ("a", "b")).alias("v"), checks.optional(f, "extra").alias("e")) for f in (first, second)]
    assert sorted(tuple(r) for r in checks.union_files(parts).collect()) == [("1", ""), ("2", "q")]
    assert sorted(str(tuple(r)) for r in checks.union_files([first, second]).collect()) == [
        "('1', None, None)",
        "(None, '2', 'q')",
    ]


def test_split_rejects(spark):
    rows = [
        ("1", "10.5", "2025-02-03", ""),
        ("", "1", "2025-02-03", None),
        ("2", "x", "2025-02-03", None),
        ("3", None, "2025-02-03", None),
        ("4", "1", "31/02/2025", None),
        ("5", "1", "", "03/02/2025"),
    ]
    df = spark.createDataFrame(rows, "id_codigo_sit string, valor string, data_pagamento string, data_debito_convenio string")
    good, bad = checks.split_rejects(df)
    assert sorted(tuple(r) for r in good.collect()) == [
        ("1", D("10.50"), dt.date(2025, 2, 3), None),
        ("5", D("1.00"), None, dt.date(2025, 2, 3)),
    ]
    assert sorted((r["id_codigo_sit"], r["reject_reason"]) for r in bad.collect()) == [
        ("", "missing key"),
        ("2", "bad amount: valor"),
        ("3", "bad amount: valor"),
        ("4", "bad date: data_pagamento"),
    ]


def test_clear_table_keeps_the_schema(spark):
    df = apply.clear_table(expenses(spark, expense("1")))
    assert df.count() == 0 and df.schema == EXPENSES


# --- hot keys -------------------------------------------------------------------------


def skewed(spark, rows=3000):
    """A third of the rows have one key, some have none."""
    key = F.when(F.col("id") < rows // 3, F.lit(0)).when(F.col("id") % 50 != 0, F.col("id") % 97 + 1)
    return spark.range(0, rows, 1, 7).select(key.cast("string").alias("k"), (F.col("id") % 10).alias("v"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_equals_plain_join(spark, how):
    facts = skewed(spark)
    dim = spark.range(0, 90).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("w"))
    plain = facts.join(dim, ["k"], how)
    split = skew.lookup_join(facts, dim, ["k"], how)
    assert split.columns == plain.columns
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, plain.collect()))


def test_lookup_join_on_two_columns(spark):
    facts = skewed(spark).withColumn("j", F.lit("x"))
    dim = spark.range(0, 90).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("j"), F.col("id").alias("w"))
    split = skew.lookup_join(facts, dim, ["k", "j"])
    plain = facts.join(dim, ["k", "j"], "left")
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, plain.collect()))


def test_both_sides_are_dealt_out_for_the_join(spark):
    """Only then may adaptive execution split a hot key; an aggregate's own partitioning is not taken over."""
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        facts = skewed(spark)
        dim = facts.groupBy("k").agg(F.max("v").alias("w"))
        plan = skew.lookup_join(facts, dim, ["k"], "inner")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    dealt = [x for x in plan.split("\n") if "Exchange hashpartitioning(k#" in x and "__key_hash" in x]
    assert len(dealt) == 2 and all("ENSURE_REQUIREMENTS" in x for x in dealt)


def test_row_numbers_by_bucket_equal_plain_ones(spark):
    rows = spark.range(0, 4000, 1, 5).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 41).cast("string")).alias("g"),
        ((F.col("id") * 7919) % 4001).alias("o"),
    )
    rows = rows.unionByName(spark.range(1500).select(F.lit(None).cast("string").alias("g"), F.col("id").alias("o")))
    rows = rows.unionByName(rows.limit(7)).unionByName(spark.range(3).select(F.lit("hot").alias("g"), F.lit(None).cast("long").alias("o")))
    plain = rows.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    cut = skew.row_number_in_groups(rows, ["g"], ["o"], F.floor(F.col("o") / F.lit(100)), "n")
    assert cut.columns == plain.columns and cut.schema["n"].dataType == plain.schema["n"].dataType
    assert Counter(map(tuple, cut.collect())) == Counter(map(tuple, plain.collect()))


def test_row_numbers_of_null_orders_come_first_and_once(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), ("a", 5), ("a", 7), ("a", 250_000)], "g string, o long")
    cut = skew.row_number_in_groups(rows, ["g"], ["o"], F.floor(F.col("o") / F.lit(100_000)), "n")
    assert sorted((r["n"], r["o"]) for r in cut.collect())[2:] == [(3, 5), (4, 7), (5, 250_000)]
    assert sorted(r["n"] for r in cut.collect()) == [1, 2, 3, 4, 5]


def test_sort_rows_orders_and_keeps_copies(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", 1), ("a", 1)], "k string, v int").repartition(3)
    assert [tuple(r) for r in skew.sort_rows(df, "k", F.desc("v")).collect()] == [("a", 2), ("a", 1), ("a", 1), ("b", 1)]


def test_compute_once_is_not_copied_into_filters(spark):
    df = compute_once(spark.createDataFrame([("a",), (None,), ("c",)], "s string"), "u", F.upper("s"))
    assert [r["u"] for r in df.collect()] == ["A", None, "C"]
    plan = df.filter("u like '%A%' or u like '%B%'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("upper(") == 1
