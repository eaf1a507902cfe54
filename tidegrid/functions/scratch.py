"""Where intermediate tables go: the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = str(Path(__file__).resolve().parents[2])


def workers_find_package(spark: SparkSession) -> None:
    """Python workers import functions of this package by name, so this checkout must be on their path."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if _ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, have)])


def shared_path(spark: SparkSession, name: str) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file:" + os.path.join(tempfile.gettempdir(), "checkpoints")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write and read back: cuts the lineage and fixes what was computed."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
