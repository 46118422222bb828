"""Intermediate tables in the folder that ``spark.checkpoint.dir`` names, and what Python workers keep."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Hashable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def folder(spark: SparkSession) -> str:
    """The shared folder. On a cluster it must be set; tests set their own."""
    found = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not found:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that the driver and every executor can reach")
    return found.rstrip("/")


def keep(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back; a lost executor does not lose it."""
    path = f"{folder(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(*frames: DataFrame) -> None:
    """Deletes tables that :func:`keep` made and nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        base = folder(spark)
        for file in df.inputFiles():
            at = file.find("/kept-")
            if at >= 0:
                path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{file[at + 1 :].split('/')[0]}")
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
                break


def sweep(spark: SparkSession) -> None:
    """Has Spark delete the shuffle files of plans that are gone; else they stay until the driver needs memory."""
    gc.collect()
    spark._jvm.System.gc()


_table: dict[Hashable, Any] = {}


def one_table(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, kept by this Python worker until another key is asked for.

    Workers outlive stages; with a table for each stage their memory would add up.
    """
    if key not in _table:
        _table.clear()
        _table[key] = make()
    return _table[key]
