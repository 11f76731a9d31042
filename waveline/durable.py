"""Results that are used several times, stored once in the shared checkpoint folder; broadcasts of measured size."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of at most this many rows of a few numbers and names is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the cluster's; a temporary one only where Spark runs in this process."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="waveline-checkpoint-"))
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` computed once, its lineage cut; lost executors re-read it rather than recompute it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back, so that columns prune."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, which is narrow and cheap or stored, hinted for a broadcast if its rows are counted to be few."""
    return F.broadcast(df) if df.count() <= limit else df


def spread(df: DataFrame, *by: str, rows: int = 250_000) -> DataFrame:
    """``df``, which is cheap to count, dealt by columns to tasks of so many rows on average, if these are more than the cores.

    Adaptive execution joins partitions up to a number of compressed bytes, and narrow rows that
    compress well are then millions to a task.
    """
    n = -(-df.count() // rows)
    if n <= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(n, *by)
