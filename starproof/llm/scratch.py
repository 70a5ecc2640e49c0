"""Intermediate tables of the corpus operators, on storage that every executor reaches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one of our own only where that is unset, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or _own.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="starproof-llm-"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet and read back: cuts lineage, survives the loss of executors."""
    spark = df.sparkSession
    path = f"{folder(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
