"""Stored tables: Parquet directories, catalog tables or a database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import settings as S


def read_table(spark: SparkSession, source: str | Mapping[str, str]) -> DataFrame:
    """A stored table.

    ``source`` is a path, the name of a catalog table, or the options of a JDBC read.
    """
    if not isinstance(source, str):
        return spark.read.format("jdbc").options(**source).load()
    if "/" in source:
        return spark.read.parquet(source)
    return spark.table(source)


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    split_by: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    splits: int | None = None,
    batch: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC read or write; ``split_by`` reads the table in parallel ranges."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = {"url": url, "batchsize": str(batch), "fetchsize": str(batch)}
    options |= {"dbtable": table} if table else {"query": query}
    options |= {k: v for k, v in {"user": user, "password": password, "driver": driver}.items() if v}
    if split_by:
        if query or None in (lower, upper, splits):
            raise ValueError("a parallel read needs a table, both bounds and the number of splits")
        options |= {
            "partitionColumn": split_by,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(splits),
        }
    return options


def stored_expenses(df: DataFrame) -> DataFrame:
    """The thirteen expense columns of keyed rows."""
    return df.select(*S.EXPENSE_COLUMNS).filter(F.col("id_codigo_sit").isNotNull())


def contract_map(df: DataFrame) -> DataFrame:
    return df.select("id_termo", "nro_sit")


def stored_income(df: DataFrame) -> DataFrame:
    return df.select("nro_sit", "rendimento_financeiro_total")


def stored_refunds(df: DataFrame) -> DataFrame:
    return df.select("id_termo_rubrica", "valor_estornado")


def run_query(
    spark: SparkSession, query: str, params: Mapping[str, Any] | None = None, **frames: DataFrame
) -> DataFrame:
    """A query with named parameters (``:name``) and frames (``{name}``), which get no name in the session."""
    return spark.sql(query, args=dict(params or {}), **frames)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def append_jdbc(df: DataFrame, options: Mapping[str, str]) -> None:
    """Append rows to a database table in batches, in parallel from the executors."""
    df.write.format("jdbc").mode("append").options(**options).save()


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Save a table clustered by ``key``; later joins on the key do not shuffle it again."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)
