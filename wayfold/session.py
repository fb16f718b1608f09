"""Session settings and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", name: str = "wayfold", **conf: str) -> SparkSession:
    """A session for one machine; a cluster passes its own session to every operator."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Small inputs on one machine: keep shuffles spread over the cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local master gets a temporary folder when the session names none: on a cluster that
    folder would be visible to one machine only.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="wayfold-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, which cuts its lineage.

    A written table survives the loss of executors, is computed once, and keeps column statistics.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Removes the shuffle files of a query when it has ended, not when the driver happens to collect its garbage.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stepwise(df: DataFrame, label: str, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``df``, then the result of each step over the one before, written one after the other as ``durable`` does.

    Only one step's shuffle files and the table it reads are on disk beside its result, which alone stays.
    """
    spark, before, done = df.sparkSession, None, None
    kept = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        for step in (lambda rows: rows, *steps):
            rows = step(df)
            path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
            rows.write.parquet(path)
            df, before, done = spark.read.schema(rows.schema).parquet(path), done, path
            if before:
                folder = spark._jvm.org.apache.hadoop.fs.Path(before)
                folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    finally:
        spark.conf.unset(TIDY) if kept is None else spark.conf.set(TIDY, kept)
    return df
