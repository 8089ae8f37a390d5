"""Folders that driver and executors share, for what a job writes and reads again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; without that setting below the context's checkpoint folder,
    which on a local master is set to one in the warehouse if there is none."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows written into a new shared folder and read from there: computed once, and a side of a join that Spark can split."""
    path = workspace(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
