"""Declarations from score files as they arrive: a streaming job that takes only new files.

Scored windows come as Parquet files, a row each of a station, a time and a score. Every run
reads the files that no run before has taken, continues the bursts that were open, and adds the
peak of each burst that the watermark has passed to a table partitioned by station and day.
Bursts that new windows may still continue stay in the checkpoint's state, until a later run.

    python -m jobs.alarms --source s3a://b/scores --output s3a://b/alarms --checkpoint s3a://b/state/alarms

A run without new files adds nothing; one that was stopped goes on where its last batch was
committed. What is read, how far, and what is written is Spark's: file stream, state and file sink.
"""

from __future__ import annotations

import argparse
import logging
import os
import tomllib
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from waveline.streaming.declarations import streaming_declarations

log = logging.getLogger("jobs.alarms")
OUTPUT = "t double, p double, station string, day date"
CONFIG = os.path.join(os.path.dirname(os.path.abspath(__file__)), "alarms.toml")


@dataclass(frozen=True)
class Settings:
    station: str = "station"  # columns of the score files
    time: str = "t"  # a time stamp, or seconds since 1970
    score: str = "p"  # a probability, or an SQL expression that makes one
    threshold: float = 0.5
    cluster_seconds: float = 60.0
    lateness: str = "1 hour"
    files_per_batch: int = 1000

    @classmethod
    def load(cls, path: str) -> Settings:
        with open(path, "rb") as f:
            given = tomllib.load(f)
        if unknown := set(given) - {x.name for x in fields(cls)}:
            raise ValueError(f"{path}: unknown settings {sorted(unknown)}")
        return cls(**given)


def seconds(column: str, kind: T.DataType) -> Column:
    """Seconds since 1970 of a time stamp with or without zone, or of a number that is that already."""
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"cast(cast(`{column}` - TIMESTAMP_NTZ'1970-01-01 00:00:00' as interval second) as decimal(20, 6))").cast("double")
    if isinstance(kind, T.TimestampType):
        return (F.unix_micros(column) / 1e6).cast("double")
    return F.col(column).cast("double")


def scores(frame: DataFrame, settings: Settings) -> DataFrame:
    """``(station, t, p)`` of the files' rows; rows that lack one of them are left out."""
    rows = frame.select(F.col(settings.station).cast("string").alias("station"), seconds(settings.time, frame.schema[settings.time].dataType).alias("t"), F.expr(settings.score).cast("double").alias("p"))
    return rows.where("station is not null and t is not null and p is not null")


def output(spark: SparkSession, path: str) -> DataFrame:
    """All declarations so far."""
    try:
        return spark.read.schema(OUTPUT).parquet(path)
    except AnalysisException:  # nothing has ever been written
        return spark.createDataFrame([], OUTPUT)


def run(spark: SparkSession, source: str, target: str, checkpoint: str, settings: Settings) -> DataFrame:
    """Take what is new in ``source``, a folder or a pattern; returns all declarations in ``target``."""
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", settings.files_per_batch).parquet(source)
    found = streaming_declarations(scores(stream, settings), settings.threshold, settings.cluster_seconds, settings.lateness)
    rows = found.select("station", F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("t") / 86400).cast("int")).alias("day"), "t", "p")
    before = output(spark, target).count()
    query = rows.writeStream.format("parquet").partitionBy("station", "day").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    read = sum(p["numInputRows"] for p in query.recentProgress)
    after = output(spark, target)
    log.info("read %d rows of %s in %d batches; wrote %d declarations to %s", read, source, len(query.recentProgress), after.count() - before, target)
    return after


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="jobs.alarms", description=__doc__.splitlines()[0])
    for name in ("source", "output", "checkpoint"):
        parser.add_argument(f"--{name}", required=True, help="a path on any store that Spark reaches")
    parser.add_argument("--config", default=CONFIG, help="settings as TOML")
    given = parser.parse_args(args)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    from waveline.session import session

    spark = session("alarms")
    try:
        run(spark, given.source, given.output, given.checkpoint, Settings.load(given.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
