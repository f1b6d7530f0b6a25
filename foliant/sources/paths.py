"""Where tables that a query writes and reads again go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors see: ``spark.checkpoint.dir`` where it is set."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="foliant-"))
        folder = sc.getCheckpointDir()
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet and read again, and where it is."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again: what reads it starts from files, not from its plan."""
    return stored_at(df, name)[0]
