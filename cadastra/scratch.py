"""Intermediate tables of the operators, written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a temporary folder only where a local master runs without one."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set; a cluster needs a folder that all its machines share")
    path = "file://" + tempfile.mkdtemp(prefix="cadastra-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written once and read back: later steps start from the table instead of running its plan again."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
