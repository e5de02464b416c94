"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); a local one only where the session names none and runs on this machine alone."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not found:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pagewright-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def spread(df: DataFrame) -> DataFrame:
    """df dealt over all cores where it has fewer partitions than there are; larger inputs are left as they are, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if not df.isStreaming and df.rdd.getNumPartitions() < cores else df


def stored(df: DataFrame) -> bool:
    """Whether all rows come from files or other stored relations, which may be read twice; a fetch or an RDD may not."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return all(leaves.apply(i).getClass().getSimpleName() == "LogicalRelation" for i in range(leaves.size()))


def dealt(df: DataFrame, size: Column, each: int) -> DataFrame:
    """df dealt into parts of some `each` of size, as many as there are cores at least: a task's work stays the same as the table grows.

    Files cannot say how much is in them (row groups of any length, texts that compress well), so stored rows are
    summed up in a pass of their own. Other rows are spread over the cores.
    """
    if df.isStreaming or not stored(df):
        return spread(df)
    total = df.agg(F.sum(size)).first()[0] or 0
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, ceil(total / each)))


def materialise(df: DataFrame, name: str = "t") -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/pagewright/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._pagewright_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes tables of materialise() that no plan still to run reads, so that iterations don't fill the shared folder."""
    for df in tables:
        if path := getattr(df, "_pagewright_path", None):
            spark = df.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
