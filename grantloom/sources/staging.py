"""Staging files in CSV and the run-scoped outputs of a job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, text
from ..schemas import all_strings


#: Holds the raw text of a line that does not have the header's number of fields.
DAMAGED = "_linha"


def read_text_columns(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """CSV with a header, every column a string. Columns are matched by header name; damaged lines are left out."""
    return read_checked(spark, path, columns)[0]


def read_checked(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """``(lines as text columns, damaged lines)`` of CSV files with a header.

    A line with too few or too many fields is damaged: it comes as its raw text (``DAMAGED``) with
    the fields that could be read, and never passes for a row with nulls.
    """
    lines = (
        spark.read.option("header", True)
        .option("multiLine", False)
        .option("enforceSchema", False)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", DAMAGED)
        # a line is judged by all of its fields, whichever of them are asked for
        .option("columnPruning", False)
        .schema(all_strings(*columns, DAMAGED))
        .csv(path if isinstance(path, str) else list(path))
    )
    # Spark refuses a query of the raw text alone, so the condition looks at a field too
    broken = F.col(DAMAGED).isNotNull() | (F.coalesce(F.length(columns[0]), F.lit(0)) < 0)
    return lines.filter(~broken).drop(DAMAGED), lines.filter(broken)


def read_typed(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """CSV read as text and cast to a known schema; nothing is inferred, bad values are null, damaged lines left out."""
    return cast_to(read_text_columns(spark, path, schema.fieldNames()), schema)


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast to ``schema``; integers may carry a ``.0`` from an earlier tool."""

    def typed(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            return c
        if isinstance(f.dataType, T.DateType):
            return dates.parse_day_first(c)
        if isinstance(f.dataType, T.IntegerType):
            return text.clean_id(c).try_cast("int")
        return text.strip(c).try_cast(f.dataType)

    return df.select(*[typed(f).alias(f.name) for f in schema])


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a CSV directory: header, UTF-8, ISO dates."""
    df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def run_path(base: str, table: str, run_id: str | int) -> str:
    return f"{base.rstrip('/')}/{table}/run_id={run_id}"


def write_run(df: DataFrame, base: str, table: str, run_id: str | int) -> DataFrame:
    """Write one run's version of a table and return it as read back.

    Each run has a directory of its own, so a repeated run overwrites only itself, nothing
    stale is left behind and an empty change set is an empty table. Reading back cuts the
    lineage at files every executor can reach.
    """
    path = run_path(base, table, run_id)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_counted(
    df: DataFrame, base: str, table: str, run_id: str | int, counts: Mapping[str, Column], only: Column | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """As ``write_run``, with aggregates of the rows taken in the writing pass itself.

    ``only`` is a condition on the rows to write; the counts are of all of them. Spark adds up
    observed metrics once per finished task of the writing stage, so a lost task counts once.
    """
    seen = Observation()
    watched = df.observe(seen, *[c.alias(name) for name, c in counts.items()])
    written = write_run(watched if only is None else watched.filter(only), base, table, run_id)
    return written, {name: seen.get.get(name) or 0 for name in counts}


def read_run(spark: SparkSession, base: str, table: str, run_id: str | int) -> DataFrame:
    return spark.read.parquet(run_path(base, table, run_id))
