from __future__ import annotations

import datetime as dt
import hashlib

from conftest import D, column
from pyspark.sql import functions as F

from grantloom import settings as S
from grantloom.functions import dates, fingerprint, money, text

C = F.col("c")


def test_expense_class_takes_first_rule(spark):
    got = column(
        spark,
        ["3.1 - Pessoal Civil", "obrigações patronais", "SERVIÇOS DE TERCEIROS / PESSOAL CIVIL", "x", None, ""],
        text.expense_class(C),
    )
    assert got == ["PESSOAL", "ENCARGOS", "PESSOAL", "OUTROS", "OUTROS", "OUTROS"]


def test_tax_id_pads_to_person_or_company_and_keeps_longer(spark):
    got = column(
        spark,
        ["123.456.789-01", "12.345.678/0001-90", "123", "", None, "123456789012", "1234567890123456"],
        text.tax_id(C),
    )
    assert got == [
        "12345678901",
        "12345678000190",
        "00000000123",
        "00000000000",
        "00000000000",
        "00123456789012",
        "1234567890123456",
    ]


def test_line_code(spark):
    got = column(spark, ["3.3.90.30.99 - X", " 3.3", "abc", None, "3."], text.line_code(C))
    assert got == ["3.3.90.30.99", "", "", "", "3."]


def test_clean_id(spark):
    got = column(
        spark,
        ["67303.0", " 67303 ", "12.7", "-3.9", "1e3", "nan", "inf", "12d", " AB ", "", None, "1.5.2"],
        text.clean_id(C),
    )
    assert got == ["67303", "67303", "12", "-3", "1000", "nan", "inf", "12d", "AB", "", None, "1.5.2"]


def test_key_build_and_split(spark):
    df = spark.createDataFrame([("6373", "3.3-1"), (None, "x"), ("7", None)], "a string, b string")
    keys = [r[0] for r in df.select(text.line_key(F.col("a"), F.col("b"))).collect()]
    assert keys == ["6373-3.3-1", None, None]
    assert column(spark, ["6373-3.3-1", "abc-1", "6373", None, "-1"], text.contract_of(C)) == [
        6373,
        None,
        None,
        None,
        None,
    ]


def test_strip_equals_python(spark):
    raw = ["\t a b \r\n", " x ", "\x0b\x0cy\x85", "  ", ""]
    assert column(spark, raw, text.strip(C)) == [v.strip() for v in raw]


def test_fold_case_ignores_case_and_trailing_blanks_only(spark):
    assert column(spark, ["Psicóloga  ", "PSICÓLOGA", " PSICÓLOGA", "PSICOLOGA"], text.fold_case(C)) == [
        "PSICÓLOGA",
        "PSICÓLOGA",
        " PSICÓLOGA",
        "PSICOLOGA",
    ]


def test_parse_brl(spark):
    got = column(
        spark, ["R$ 1.200,50", "1.200,50", "-", "", None, "R$ 0,00", "abc", "-25,10", " R$7 ", "12"], money.parse_brl(C)
    )
    assert got == [D(v) for v in "1200.50 1200.50 0.00 0.00 0.00 0.00 0.00 -25.10 7.00 12.00".split()]


def test_parse_number_and_amount(spark):
    raw = ["1234.56", "1.234,56", "abc", None, " 7 ", "2.675", "1e2"]
    assert column(spark, raw, money.parse_number(C)) == [
        D(v) for v in "1234.56 0.00 0.00 0.00 7.00 2.68 100.00".split()
    ]
    assert column(spark, raw, money.parse_amount(C)) == [
        D(v) for v in "1234.56 1234.56 0.00 0.00 7.00 2.68 100.00".split()
    ]


def test_format_brl_rounds_half_up(spark):
    got = column(spark, ["1234567.895", "0.005", "-1234.5", "0", None, "2.675"], money.format_brl(C.cast("decimal(20,4)")))
    assert got == ["1.234.567,90", "0,01", "-1.234,50", "0,00", None, "2,68"]


def test_percent_round_trip_and_old_reading(spark):
    shown = ["1.234,56%", "99,99%", "100,00%", None, "x"]
    assert column(spark, shown, money.parse_percent(C)) == [D("1234.56"), D("99.99"), D("100.00"), None, None]
    assert column(spark, shown, money.parse_percent(C, compat_text=True)) == [None, 99.99, 100.0, None, None]


def test_quotient_is_exact_and_zero_safe(spark):
    df = spark.createDataFrame([(D("2.00"), 3), (D("1.00"), 0), (D("-2.00"), 3)], "a decimal(18,2), b int")
    got = [r[0] for r in df.select(money.quotient(F.col("a"), F.col("b"))).collect()]
    assert got == [D("0.666667"), None, D("-0.666667")]


def test_runway_text(spark):
    got = column(spark, ["30.5", "0", "12", "-1.5"], money.runway_text(C.cast("decimal(38,6)")))
    # half a month is 15.21875 days; negative months keep their sign and floor downwards
    assert got == [
        "2 anos, 6 meses e 15 dias",
        "0 anos, 0 meses e 0 dias",
        "1 anos, 0 meses e 0 dias",
        "-1 anos, -2 meses e -16 dias",
    ]


def test_tolerance_is_strict_and_null_never_differs(spark):
    rows = [("1.00", "1.01"), ("1.00", "1.02"), ("1.00", None), (None, None), ("1.02", "1.00")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    a, b = (F.col(x).cast("decimal(18,2)") for x in "ab")
    got = [r[0] for r in df.orderBy("i").select(money.differs(a, b)).collect()]
    assert got == [False, True, None, None, True]


def test_parse_day_first(spark):
    raw = ["03/02/2025", "3/2/2025", "2025-02-03", "2025-02-03 00:00:00", "2025-02-13 10:11:12", "31/02/2025", "x", "", None, "02/13/2025"]
    day = dt.date
    assert column(spark, raw, dates.parse_day_first(C)) == [
        day(2025, 2, 3),
        day(2025, 2, 3),
        day(2025, 2, 3),
        day(2025, 2, 3),
        day(2025, 2, 13),
        None,
        None,
        None,
        None,
        None,
    ]
    assert column(spark, ["13/02/2025", " "], dates.to_sql_date(C)) == ["2025-02-13", None]


def test_month_boundaries_counts_month_starts(spark):
    pairs = [("2025-01-31", "2025-02-01"), ("2024-12-31", "2025-01-01"), ("2025-03-01", "2025-03-31"), ("2025-05-01", "2025-03-31")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = [r[0] for r in df.orderBy("i").select(dates.month_boundaries(F.col("a").cast("date"), F.col("b").cast("date"))).collect()]
    assert got == [1, 1, 0, -2]


def test_first_of_previous_month(spark):
    got = column(spark, ["2025-03-31", "2025-01-05"], dates.first_of_previous_month(C.cast("date")))
    assert got == [dt.date(2025, 2, 1), dt.date(2024, 12, 1)]


def test_vacation_text(spark):
    raw = [
        "FÉRIAS CUIDADORA - 30 DIAS GOZO DE 01/02/25 A 02/03/25",
        "férias - 5 dias gozo de 31/02/25 a 01/03/25",
        "FÉRIAS CUIDADORA",
        "GOZO DE xx A yy",
    ]
    up = F.upper(C)
    assert column(spark, raw, text.days_phrase(C, up)) == ["30 DIAS", "5 dias", None, None]
    assert column(spark, raw, text.date_after(up, "GOZO DE ")) == [dt.date(2025, 2, 1), None, None, None]
    assert column(spark, raw, text.date_after(up, " A ")) == [dt.date(2025, 3, 2), dt.date(2025, 3, 1), None, None]


def expense(**changes):
    row = dict.fromkeys(S.EXPENSE_COLUMNS, "")
    row |= {
        "id_codigo_sit": "1",
        "termo": "6373",
        "rubrica": "3.1",
        "data_pagamento": dt.date(2025, 2, 3),
        "data_debito_convenio": None,
        "valor": D("10.50"),
        "id_termo_rubrica": "6373-3.1",
    }
    return row | changes


def test_fingerprint_is_md5_of_piped_fields(spark):
    from grantloom.schemas import EXPENSES

    rows = [expense(), expense(tipo_doc_despesa=None, favorecido=" "), expense(id_codigo_sit="2"), expense(valor=D("10.51"))]
    df = spark.createDataFrame([tuple(r[c] for c in S.EXPENSE_COLUMNS) for r in rows], EXPENSES)
    got = [r[0] for r in df.select(fingerprint.fingerprint()).collect()]
    plain = "|".join(["6373", "3.1", "", "", "", "", "", "", "2025-02-03", "", "10.50", "6373-3.1"])
    assert got[0] == hashlib.md5(plain.encode()).hexdigest()
    assert got[1] == got[0], "null and blank are the same"
    assert got[2] == got[0], "the key is no part of it"
    assert got[3] != got[0]
