"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from kinlink.sources.scratch import shuffles_deleted

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, a local session gets one of its own; a cluster must name it."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="kinlink-")
        spark.conf.set(SETTING, folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, computed once and read back from the shared folder; what was shuffled for them is deleted."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
