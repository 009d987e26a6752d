"""Session and shared-storage helpers used by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only where the session names none (tests, one machine) a temporary folder is set.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="tilewright-")
        context.setCheckpointDir(named)
    elif not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named.rstrip("/")


def own_dir(spark: SparkSession) -> str:
    """This application's folder below the shared one."""
    return f"{shared_dir(spark)}/tilewright/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the application's folder."""
    return f"{own_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what materialize wrote, once nothing reads it any more."""
    for df in tables:
        path = getattr(df, "_scratch", None)
        if path:
            spark = df.sparkSession
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clean_up(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; results that were not written elsewhere can't be read afterwards."""
    target = spark._jvm.org.apache.hadoop.fs.Path(own_dir(spark))
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that one task takes where they are sorted or held by key.
ROWS_OF_TASK = 1 << 20


def dealt_by_size(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df dealt out by keys to as many tasks as ``rows``, its number of rows, needs: what a task holds doesn't grow with the table. What groups by these keys afterwards isn't dealt out again."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_OF_TASK)), *keys)


def spread(df: DataFrame) -> DataFrame:
    """A table read from files, dealt out if these give fewer partitions than there are cores (one file of one row group is one task); else as it is. Columns and filters still reach the scan."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
