"""Discovery of landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GLOB = "*.{xlsx,xls,csv}"


def landed_files(spark: SparkSession, path: str, glob: str = GLOB) -> DataFrame:
    """``(source_file, file_name, extension, bytes, modified)`` of files waiting in a folder.

    Only the listing is read; the pruned ``content`` column is never opened.
    """
    name = F.element_at(F.split("path", "/"), -1)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(path)
        .select(
            F.col("path").alias("source_file"),
            name.alias("file_name"),
            F.lower(F.element_at(F.split(name, r"\."), -1)).alias("extension"),
            F.col("length").alias("bytes"),
            F.col("modificationTime").alias("modified"),
        )
    )


def count_by_extension(files: DataFrame) -> DataFrame:
    return files.groupBy("extension").agg(F.count(F.lit(1)).alias("arquivos"))
