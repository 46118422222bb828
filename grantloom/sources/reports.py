"""Summary reports: semi-structured text files with one contract each.

The sections of a report are found with array functions on the lines of the file, inside
one row. A file is therefore parsed where it was read; nothing is shuffled. Marks cut the lines
into stretches over which a number or a section is in force, and a stretch is laid out as an
array that repeats its value once a line. Work grows with the lines, however many marks there are.

:func:`parse` reads a report once; income, refund lines and status are all taken from its result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import money, text
from ..operators.dedup import last_per_key
from ..operators.once import compute_once

SIT, INCOME, TOTAL, EXPENSES = "sit", "income", "total", "expenses"
ORDER = ("modified", "source_file", "pos")


def read_texts(spark: SparkSession, path: str | Sequence[str], glob: str = "*.csv") -> DataFrame:
    """``(source_file, modified, content)`` of every report, one row per file.

    Text that is valid UTF-8 is read as such, all else as Latin-1.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load([path] if isinstance(path, str) else list(path))
    )
    return decode_files(files)


def decode_files(files: DataFrame) -> DataFrame:
    """Report text of ``binaryFile`` rows."""
    utf8 = F.try_validate_utf8(F.col("content").cast("string"))
    decoded = F.coalesce(utf8, F.decode(F.col("content"), "ISO-8859-1"))
    return files.select(
        F.col("path").alias("source_file"),
        F.col("modificationTime").alias("modified"),
        F.ltrim(decoded, F.lit("﻿")).alias("content"),
    )


def _kind(line: Column) -> Column:
    return (
        F.when(line.startswith(S.MARK_SIT), F.lit(SIT))
        .when(line.contains(S.MARK_INCOME), F.lit(INCOME))
        .when(line.startswith(S.MARK_TOTAL), F.lit(TOTAL))
        .when(line.contains(S.MARK_EXPENSES), F.lit(EXPENSES))
    )


def _sections(texts: DataFrame) -> DataFrame:
    """Add the lines of each report and its sections to the file columns.

    ``stretches`` are runs of lines with one contract number in force: the number, null at first,
    the first line and their count. ``live`` are the marks other than numbers that stand under a
    number, and ``last`` is the number that was given last.
    """
    lines = F.transform(F.split("content", "\r\n|\n|\r"), text.strip)

    def mark(line: Column, pos: Column) -> Column:
        kind, second = _kind(line), text.field(line, 1)
        found = F.struct(pos.alias("pos"), kind.alias("kind"), second.alias("second"))
        # a number's mark without a second field marks nothing
        return F.when(kind.isNotNull() & ((kind != SIT) | second.isNotNull()), found)

    marks = F.array_compact(F.transform("lines", mark))
    # numbers by their place among the marks, after one that stands for the lines before the first
    sits = F.array_compact(
        F.transform(
            "marks",
            lambda m, i: F.when(
                m["kind"] == SIT,
                F.struct(m["pos"].alias("pos"), i.alias("at"), text.blank_to_null(m["second"]).alias("number")),
            ),
        )
    )
    start = F.struct(F.lit(-1).alias("pos"), F.lit(-1).alias("at"), F.lit(None).cast("string").alias("number"))
    # a number holds from the line below its mark down to the next such mark
    stretches = F.transform(
        "sits",
        lambda m, i: F.struct(
            m["number"].alias("number"),
            (m["pos"] + 1).alias("first"),
            (F.coalesce(F.get(F.col("sits"), i + 1)["pos"], F.size("lines") - 1) - m["pos"]).alias("n"),
            (m["at"] + 2).alias("mark"),
            (F.coalesce(F.get(F.col("sits"), i + 1)["at"], F.size("marks")) - m["at"] - 1).alias("marks"),
        ),
    )
    live = F.flatten(
        F.transform(
            F.filter("stretches", lambda s: s["number"].isNotNull()), lambda s: F.slice("marks", s["mark"], s["marks"])
        )
    )
    out = compute_once(texts.select("source_file", "modified", "content"), "lines", lines).drop("content")
    out = compute_once(compute_once(out, "marks", marks), "sits", F.concat(F.array(start), sits))
    out = compute_once(out, "stretches", stretches).drop("sits")
    return compute_once(out, "live", live).withColumn("last", F.element_at("stretches", -1)["number"]).drop("marks")


def parse(texts: DataFrame) -> DataFrame:
    """Every report with its contract number, income and lines.

    The last contract number names the file; without one it is null and the file counts for
    nothing. An income section ends at its first total; of several totals the last counts. The
    expense section, once begun (``begun``), lasts to the end. Written once, the result serves
    income, refunds and status.
    """
    flow = F.filter("live", lambda m: m["kind"].isin(INCOME, TOTAL))
    totals = F.filter(
        "flow",
        lambda m, i: (m["kind"] == TOTAL) & (F.get(F.col("flow"), i - 1)["kind"] == INCOME) & m["second"].isNotNull(),
    )
    begins = F.filter("live", lambda m: m["kind"] == EXPENSES)
    known = F.struct(
        money.parse_brl(F.try_element_at(totals, F.lit(-1))["second"]).alias("total"),
        F.get(begins, F.lit(0))["pos"].alias("begun"),
    )
    return compute_once(compute_once(_sections(texts), "flow", flow), "known", known).select(
        "source_file",
        "modified",
        F.col("last").alias("nro_sit"),
        F.col("known.total").alias("rendimento_financeiro_total"),
        F.col("known.begun").alias("begun"),
        "stretches",
        "lines",
    )


def contracts_of(parsed: DataFrame) -> DataFrame:
    """``(nro_sit, rendimento_financeiro_total)`` with time and file, one row per valid report."""
    return parsed.filter(F.col("nro_sit").isNotNull()).select(
        "nro_sit", "rendimento_financeiro_total", "modified", "source_file"
    )


def lines_of(parsed: DataFrame) -> DataFrame:
    """Refund lines of every valid report: number, code, refund, key, time, file and position."""
    begun, line, fields = F.col("begun"), F.col("row.line"), F.col("fields")

    def below(stretch: Column) -> Column:
        """Lines of a stretch, from where the expenses begin."""
        first = F.greatest(stretch["first"], begun + 1)
        lines = F.slice("lines", first + 1, stretch["first"] + stretch["n"] - first)
        return F.transform(lines, lambda text_, i: F.struct((first + i).alias("pos"), text_.alias("line")))

    under = F.filter("stretches", lambda s: s["number"].isNotNull() & (s["first"] + s["n"] > begun + 1))
    # an outer explode: of the plain one the optimizer would work out the array once more, to see whether it is empty
    rows = (
        parsed.filter(F.col("nro_sit").isNotNull() & begun.isNotNull())
        .select("nro_sit", "modified", "source_file", F.explode_outer(F.flatten(F.transform(under, below))).alias("row"))
        .filter(
            (F.length(line) > 0)
            & ~line.contains(S.MARK_TOTAL)
            & ~line.startswith(S.MARK_HEADER)
            & _kind(line).isNull()
        )
    )
    code = text.strip(F.get(F.split(text.strip(F.get(fields, F.lit(0))), "-"), F.lit(0)))
    split = compute_once(rows, "fields", F.split(line, ";", -1)).filter(F.size(fields) >= 5)
    return (
        compute_once(split, "rubrica", code)
        .filter(F.length("rubrica") > 0)
        .select(
            "nro_sit",
            "rubrica",
            money.parse_brl(F.get(fields, F.lit(4))).alias("valor_estornado"),
            text.line_key(F.col("nro_sit"), F.col("rubrica")).alias("id_termo_rubrica"),
            "modified",
            "source_file",
            "row.pos",
        )
    )


def status_of(parsed: DataFrame) -> DataFrame:
    """``(source_file, status)``: ``ok`` or ``ignored`` for a file without a contract number."""
    status = F.when(F.col("nro_sit").isNull(), F.lit("ignored")).otherwise(F.lit("ok"))
    return parsed.select("source_file", status.alias("status"))


def report_contracts(texts: DataFrame) -> DataFrame:
    """:func:`contracts_of` report texts."""
    return contracts_of(parse(texts))


def report_lines(texts: DataFrame) -> DataFrame:
    """:func:`lines_of` report texts."""
    return lines_of(parse(texts))


def contract_summary(texts: DataFrame) -> DataFrame:
    """Reported income per contract number; the latest report counts."""
    return latest_income(parse(texts))


def line_summary(texts: DataFrame) -> DataFrame:
    """Reported refund per line; the latest report, and in it the last line, counts."""
    return latest_refunds(parse(texts)).drop(*ORDER)


def report_status(texts: DataFrame) -> DataFrame:
    """:func:`status_of` report texts."""
    return status_of(parse(texts))


def latest_income(parsed: DataFrame) -> DataFrame:
    """Income per contract number of parsed reports; the latest report counts."""
    return last_per_key(contracts_of(parsed), ["nro_sit"], ("modified", "source_file")).select(
        "nro_sit", "rendimento_financeiro_total"
    )


def latest_refunds(parsed: DataFrame) -> DataFrame:
    """Refund per line of parsed reports with where it stands (``ORDER``); the last one counts."""
    return last_per_key(lines_of(parsed), ["id_termo_rubrica"], ORDER).select(
        "nro_sit", "rubrica", "valor_estornado", "id_termo_rubrica", *ORDER
    )


def tagged_lines(texts: DataFrame) -> DataFrame:
    """Every non-blank line with its number in force and the section it stands in."""
    live, size = F.col("live"), F.size("lines")
    numbers = F.flatten(F.transform("stretches", lambda s: F.array_repeat(s["number"], s["n"])))
    before = F.array_repeat(F.lit(None).cast("string"), F.coalesce(F.get(live, F.lit(0))["pos"], size))
    spans = F.transform(
        live, lambda m, i: F.array_repeat(m["kind"], F.coalesce(F.get(F.col("live"), i + 1)["pos"], size) - m["pos"])
    )
    begun = F.get(F.filter(live, lambda m: m["kind"] == EXPENSES), F.lit(0))["pos"]
    # what is laid out by line is settled before lines become rows, so no row carries a whole report
    laid = F.arrays_zip("lines", numbers.alias("numbers"), F.flatten(F.concat(F.array(before), spans)).alias("open"))
    whole = compute_once(_sections(texts).withColumn("begun", begun), "laid", laid).select("source_file", "begun", "laid")
    rows = whole.select("source_file", "begun", F.posexplode("laid").alias("pos", "row"))
    section = (
        F.when(F.col("begun") < F.col("pos"), F.lit(EXPENSES))
        .when(F.col("row.open") == INCOME, F.lit(INCOME))
        .otherwise(F.lit("none"))
    )
    return rows.filter(F.length("row.lines") > 0).select(
        "source_file", "pos", F.col("row.numbers").alias("nro_sit"), section.alias("section"), F.col("row.lines").alias("line")
    )
