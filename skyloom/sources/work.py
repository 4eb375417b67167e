"""Tables that cut a plan in two, in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares; a temporary one only where everything runs in one process."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        top = f"file://{tempfile.gettempdir()}"
    return f"{top.rstrip('/')}/skyloom-stores/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """df as a table that is written now and read from then on, so that what uses it twice doesn't compute it twice."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame, name: str) -> DataFrame:
    """cut(), and the shuffles behind df are deleted as soon as it is written."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        return cut(df, name)
    finally:
        spark.conf.set(_CLEANUP, before)
