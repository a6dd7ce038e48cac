"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "camlytics", cores: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder named by the cluster.

    Only a local session may fall back to a temporary folder: on a cluster it
    would live on one machine and be lost with it.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named
    if current is not None:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="camlytics-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash on the keys over all shuffle partitions.

    For work that costs time per row rather than per byte: a given number of
    partitions keeps the small ones from being merged by their size.
    """
    number = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(number, *keys)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
