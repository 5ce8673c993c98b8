"""The folder that driver and executors share, and cutting lineage by reliable checkpoints there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A folder of the context's own in spark.checkpoint.dir.

    Where that is unset, a temporary folder serves a local master, whose driver and executors are one process; a
    cluster gets an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None and not sc._jsc.sc().isLocal():
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(where or tempfile.mkdtemp(prefix="quarry-shared-"))
    return sc.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """df as a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
