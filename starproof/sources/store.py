"""Intermediate tables on shared storage: they survive the loss of any executor."""

from __future__ import annotations

import uuid

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else the warehouse folder, which is shared as well."""
    return (
        spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir")
    )


def run_dir(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{shared_dir(spark).rstrip('/')}/starproof/{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Later plans start from columnar files (pruning and pushdown keep working)
    rather than from the whole lineage.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_counted(df: DataFrame, name: str, metrics: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """``materialise``, and the one row of ``metrics`` observed by the tasks that write: no second read of the table.

    The metrics belong to the last stage of the write, whose tasks count once each, however often they are tried.
    """
    spark, seen = df.sparkSession, Observation(f"{name}-{uuid.uuid4().hex}")
    written = materialise(df.observe(seen, *metrics), name)
    schema = df.limit(0).agg(*metrics).schema
    values = seen.get
    if set(values) != set(schema.names):  # a plan that is known to be empty is written without its observer
        return written, fixed(written.agg(*metrics))
    return written, spark.createDataFrame([tuple(values[n] for n in schema.names)], schema)


def fixed(row: DataFrame) -> DataFrame:
    """A one-row frame computed now: later plans hold its values and read nothing."""
    return row.sparkSession.createDataFrame([tuple(row.first())], row.schema)


def release(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application, at the end of a run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
