"""Where written intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Lets Spark delete the shuffle files of a query as it ends, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder the cluster names; a temporary folder only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside are deleted as each of them ends."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before) if before else spark.conf.unset(CLEANUP)


def written(df: DataFrame, label: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back: a short plan that outlives executors. Its shuffles are deleted."""
    path = scratch_path(df.sparkSession, label)
    with shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
