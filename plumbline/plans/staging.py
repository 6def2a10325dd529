"""Intermediate tables that several later jobs read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def staging_folder(spark: SparkSession, fallback: str | None) -> str:
    """Where intermediate tables go: the cluster's checkpoint folder, else ``fallback``, which must be shared."""
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if not (configured or fallback):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    return f"{(configured or fallback).rstrip('/')}/plumbline-{uuid.uuid4().hex}"


def stage(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table and read it back: later jobs start from files, with column pruning, on any executor."""
    path = f"{folder}/{name}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
