"""Where products live, how they are written once, and what is there already.

Every product is a partitioned Parquet table; a chunk's output overwrites only its own
partitions, so a repeated or interrupted run leaves one copy. What is complete is a table of
its own, since a chunk may rightly have no output at all.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waveline.durable import checkpoint
from waveline.schemas import COMPLETED
from waveline.sources.mseed import Trace, write_traces


@dataclass(frozen=True)
class Layout:
    """Table paths under one output root."""

    root: str

    @property
    def baseline(self) -> str:
        return f"{self.root}/baseline"

    @property
    def scores(self) -> str:
        return f"{self.root}/scores"

    @property
    def snr_parts(self) -> str:
        return f"{self.root}/snr_parts"

    @property
    def windows(self) -> str:
        return f"{self.root}/windows"

    @property
    def pairs(self) -> str:
        return f"{self.root}/pairs"

    @property
    def completed(self) -> str:
        return f"{self.root}/completed"

    def dataset(self, name: str) -> str:
        return f"{self.root}/datasets/{name}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table is there, on any file system."""
    return next(_names(spark, path), None) is not None


def _names(spark: SparkSession, path: str) -> Iterator[str]:
    """The names in a folder, on any file system; none if it isn't there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return (f.getPath().getName() for f in (fs.listStatus(p) or ())) if fs.exists(p) else iter(())


def _overwrite(df: DataFrame, path: str, by: list[str]) -> None:
    """Only the partitions that ``df`` has rows for are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_scores(df: DataFrame, layout: Layout) -> None:
    _overwrite(df, layout.scores, ["station", "arm", "chunk"])


def write_snr_parts(df: DataFrame, layout: Layout) -> None:
    _overwrite(df, layout.snr_parts, ["station", "chunk"])


def write_windows(df: DataFrame, layout: Layout) -> None:
    """A station's windows of a length and chunk replace what it had of them; ``df`` is read several times if the table is there.

    Partitions are of a length and a chunk: with a level of stations too, folders and files follow the stations,
    however few windows each has. Chunks of one name share a partition, so if anything in it is replaced,
    what other stations have there is written again with it; else rows are added and nothing is taken away.
    """
    spark, of, by = df.sparkSession, ["station", "length_s", "chunk"], ["length_s", "chunk"]
    rows, mode = df.withColumns({"station": F.col("station").cast("string"), "chunk": F.col("chunk").cast("string")}), "append"
    if exists(spark, layout.windows):
        if any(name.startswith("station=") for name in _names(spark, layout.windows)):
            raise ValueError(f"{layout.windows} is partitioned by station, as it was before: write it anew elsewhere")
        had = spark.read.schema(rows.schema).parquet(layout.windows)
        keys = kept(rows.select(*of).distinct())
        parts = keys.select(*by).distinct().collect()  # as many as the partitions that the write itself tells the driver of
        near = had.where(F.col("length_s").isin({r.length_s for r in parts}) & F.col("chunk").isin({r.chunk for r in parts}))
        if near.join(keys, of, "left_semi").head(1):
            others = near.join(keys.select(*by).distinct(), by, "left_semi").join(keys, of, "left_anti")
            rows, mode = rows.unionByName(kept(others)), "overwrite"
    # Without the hint each task has a file in each partition.
    rows.hint("rebalance", *by).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(layout.windows)


def export_windows(df: DataFrame, root: str, fs: float, comps: tuple[str, str, str] = ("HHZ", "HHN", "HHE")) -> DataFrame:
    """Cut windows as files of three traces, ``ROOT/<length>s/<station>/<eq|noise>/<tag>.mseed``; returns their paths.

    ``root`` is a folder that all executors share. A file appears whole or not at all, and a
    task that runs again writes the same one.
    """

    def work(batches):
        for batch in batches:
            paths = []
            for r in batch.to_pylist():
                path = f"{root}/{r['length_s']:g}s/{r['station']}/{r['kind']}/{r['tag']}.mseed"
                os.makedirs(os.path.dirname(path), exist_ok=True)
                traces = [Trace(r["station"], c, r["t0"], fs, np.asarray(x, np.int32)) for c, x in zip(comps, r["samples"], strict=True)]
                part = f"{path}.{uuid.uuid4().hex}.part"
                with open(part, "wb") as f:
                    f.write(write_traces(traces))
                os.replace(part, path)
                paths.append(path)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], ["path"])

    return df.select("station", "length_s", "kind", "tag", "t0", "samples").mapInArrow(work, "path string")


def write_baseline(df: DataFrame, layout: Layout) -> None:
    _overwrite(df, layout.baseline, ["station"])


def pair_key() -> Column:
    """A pair's key, which doesn't depend on the order of its two stations."""
    return F.concat(F.least("station_a", "station_b"), F.lit("-"), F.greatest("station_a", "station_b"))


def write_pairs(df: DataFrame, layout: Layout, arm: str | None = None) -> None:
    """Pair tables by pair and arm, the column if none is named; the rows still say the stations' order."""
    keyed = df.withColumn("pair", pair_key())
    _overwrite(keyed if arm is None else keyed.withColumn("arm", F.lit(arm)), layout.pairs, ["pair", "arm"])


def mark_completed(done: DataFrame, layout: Layout) -> None:
    """Add ``(station, chunk, product, outputs)`` rows; a row again is no harm."""
    done.select("station", "chunk", "product", F.col("outputs").cast("bigint")).write.mode("append").parquet(layout.completed)


def completed(spark: SparkSession, layout: Layout) -> DataFrame:
    """Distinct completed products; empty before the first run."""
    if not exists(spark, layout.completed):
        return spark.createDataFrame([], COMPLETED)
    return spark.read.schema(COMPLETED).parquet(layout.completed).groupBy("station", "chunk", "product").agg(F.max("outputs").alias("outputs"))


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once, before a table that it reads is written over."""
    return checkpoint(df)


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A product table, or a typed empty one before the first run."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
