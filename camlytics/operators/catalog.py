"""What lies under a base folder: datasets, partitions and files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def data_files(spark: SparkSession, base: str) -> DataFrame:
    """Dataset, partition folder, size and time of every file below ``base``.

    Only file names and sizes are read, not the contents.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(base)
        .select("path", "length", "modificationTime")
    )
    return files.withColumn("_inside", _below(base)).select(
        F.split_part("_inside", F.lit("/"), F.lit(1)).alias("dataset"),
        F.regexp_extract("_inside", r"^[^/]+/(.*)/[^/]+$", 1).alias("partition"),
        "path",
        "length",
        "modificationTime",
    )


def _below(base: str) -> Column:
    """The path after ``base``, whatever scheme and host either is written with."""
    folder = re.sub(r"^[A-Za-z0-9+.-]+:/*", "/", base).rstrip("/") + "/"
    return F.col("path").substr(F.instr("path", folder) + len(folder), F.length("path"))


def is_parquet() -> Column:
    return F.col("path").endswith(".parquet")


def dataset_stats(spark: SparkSession, base: str) -> DataFrame:
    """Parquet files and bytes used by each dataset."""
    return data_files(spark, base).groupBy("dataset").agg(
        F.count_if(is_parquet()).alias("parquet_files"), F.sum("length").alias("bytes")
    )


def dataset_listing(spark: SparkSession, base: str) -> DataFrame:
    """Files and bytes of each partition folder."""
    return data_files(spark, base).groupBy("dataset", "partition").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def recent_files(spark: SparkSession, base: str, n: int = 10, *, by_time: bool = False) -> DataFrame:
    """The last ``n`` Parquet files by path, or by modification time."""
    files = data_files(spark, base).where(is_parquet())
    order = [F.desc("modificationTime"), F.desc("path")] if by_time else [F.desc("path")]
    return files.orderBy(*order).limit(n)
