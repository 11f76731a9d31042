"""How far out a station recovers catalogued events: signal over noise about the predicted P."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waveline.durable import checkpoint, spread, stored
from waveline.operators import blocks
from waveline.operators.segments import holding

NOISE, SIGNAL, BAND = (-60.0, -10.0), (-1.0, 12.0), (2.0, 20.0)


def ratio_of(signal: Column, noise: Column) -> Column:
    """A root mean square over another; null where the noise is silent or either is missing."""
    return F.when(noise > 0, signal / noise)


def measure(segments: DataFrame, events: DataFrame, keys: list[str], fs: float, band: tuple[float, float] | None = BAND, noise: tuple[float, float] = NOISE, signal: tuple[float, float] = SIGNAL, derived: Column | None = None) -> DataFrame:
    """``events`` with ``snr`` and ``dropped``: what straddles a gap, or is silent, has no ratio.

    Segments are the vertical component's, in blocks; events carry ``keys``, ``event_id`` and ``p_epoch``
    (those without a travel time aren't asked for and aren't counted as dropped). Which events have both
    parts is decided on headers, and samples are fetched of these. ``derived`` as in ``blocks.fetch``,
    without a band only: headers then go with the requests, and ``segments`` are headers with a block's number.
    """
    spans = {"noise": noise, "signal": signal}
    wants = {p: int(round((hi - lo) * fs)) for p, (lo, hi) in spans.items()}
    carry = blocks.header_columns(segments, keys) if derived is not None else []
    asked, ids = events.select(*keys, "event_id", "p_epoch"), [*keys, "event_id", "p_epoch", "_part", "want"]
    held = holding(asked, blocks.heads(segments), keys, fs, "p_epoch", wants, after={p: lo for p, (lo, _) in spans.items()}, carry=carry, deal=[*keys, "event_id"])
    # Of an event with several times each part may be held at another one.
    has = [F.max(F.col(p).isNotNull()).over(Window.partitionBy(*keys, "event_id")) for p in wants]
    held = held.withColumn("_both", has[0] & has[1]).where("_both")
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("_part"), F.lit(want).alias("want"), F.col(p).alias("_x")) for p, want in wants.items()]))
    requests = held.select(*keys, "event_id", "p_epoch", each.alias("_e")).where("_e._x is not null").select(*keys, "event_id", "p_epoch", "_e._part", "_e.want", "_e._x.*")
    if derived is None:
        requests = checkpoint(requests)
    if band:  # whole segments' filters, of the blocks that are asked for
        segments = stored(blocks.filtered(segments, keys, fs, *band, needed=blocks.needed_blocks(requests, keys, "at", "want")), "conditioned")
    got = blocks.squares(requests, segments, keys, "at", "want", derived)
    read = got.groupBy(*ids).agg(F.sum("squares").alias("_power")).withColumn("_rms", F.sqrt(F.col("_power") / F.col("want")))
    by = read.groupBy(*keys, "event_id").agg(*[F.max(F.when(F.col("_part") == p, F.col("_rms"))).alias(p) for p in ("noise", "signal")])
    # Its rows are at most the events' and narrower: a task's are hashed, and the events needn't be sorted.
    both = events.join(by.hint("shuffle_hash"), [*keys, "event_id"], "left")
    return both.withColumn("snr", ratio_of(F.col("signal"), F.col("noise"))).withColumn("dropped", F.col("snr").isNull()).drop("noise", "signal")


def largest(snr: DataFrame, keys: list[str] = ()) -> DataFrame:
    """``(keys, event_id, snr)``: of an event measured twice the larger reading."""
    return snr.groupBy(*keys, "event_id").agg(F.max("snr").alias("snr"))


def with_readings(events: DataFrame, readings: DataFrame, keys: list[str] = (), least: float | None = None) -> DataFrame:
    """``events`` with their ``snr``: those unmeasured too, with null, or with ``least`` only those that reach it."""
    on = [*keys, "event_id"]
    if least is None:
        return events.join(readings.select(*on, "snr"), on, "left")
    return events.join(readings.where(F.col("snr") >= least).select(*on, "snr"), on)


def roll_up(parts: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """All parts as one table: of an event measured twice the first in ``order``, sorted by time."""
    w = Window.partitionBy(*keys, "event_id").orderBy(*order)
    one = spread(parts, *keys, "event_id").withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
    return one.orderBy(*keys, "time")


def summary(snr: DataFrame, keys: list[str]) -> DataFrame:
    """Events measured, their median and the share at three or over."""
    return snr.groupBy(*keys).agg(F.count("*").alias("events"), F.median("snr").alias("median_snr"), F.avg((F.col("snr") >= 3).cast("double")).alias("share_over_3"))

