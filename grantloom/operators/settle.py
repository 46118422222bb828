"""Keep an intermediate result that several steps read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not folder:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    return folder.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and return it as read back.

    Steps that follow read columns they need from files any executor can reach, in place of
    working the result out again; a lost executor does not lose it. ``unsettle`` deletes it.
    """
    path = f"{shared_folder(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unsettle(df: DataFrame) -> None:
    """Delete what ``settle`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for name in {f.rsplit("/", 2)[-2] for f in df.inputFiles() if "/settled-" in f}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
