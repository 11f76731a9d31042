"""Declarations from a stream of scored windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def streaming_declarations(scores: DataFrame, threshold: float, cluster_seconds: float = 60.0, lateness: str = "1 hour") -> DataFrame:
    """``(station, t, p)``: the peak of each burst over the threshold, once the watermark passes it.

    ``scores`` is a stream (or batch) of ``(station, t, p)``, t in epoch seconds. Session windows
    merge windows exactly ``cluster_seconds`` apart and part those further, as the batch
    operator does, at the resolution of a microsecond.
    """
    gap = f"{int(round(cluster_seconds * 1e6)) + 1} microseconds"
    hits = scores.where(F.col("p").cast("double") > threshold).withColumn("ts", F.timestamp_micros(F.rint(F.col("t") * 1e6).cast("long")))
    peak = F.max(F.struct(F.col("p").cast("double").alias("p"), (-F.col("t")).alias("minus_t"))).alias("peak")
    if hits.isStreaming:
        hits = hits.withWatermark("ts", lateness)
    found = hits.groupBy("station", F.session_window("ts", gap)).agg(peak)
    return found.select("station", (-F.col("peak.minus_t")).alias("t"), F.col("peak.p").alias("p"))
