"""Where tables are read from and where intermediate tables are kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession, path: str | None = None) -> str:
    """A fresh folder name below the shared work folder.

    The folder is the explicit `path`, else the cluster's `spark.checkpoint.dir`, else a
    checkpoint folder set on the context, else the warehouse; all are visible to every executor.
    """
    root = path or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/flowtables-{uuid.uuid4().hex}"


def cut(df: DataFrame, path: str | None = None) -> DataFrame:
    """`df` written to the work folder and read back: later stages do not recompute it."""
    spark = df.sparkSession
    target = work_dir(spark, path)
    df.write.parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder made by `work_dir` through the Hadoop file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
