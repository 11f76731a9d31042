"""Arrival-anchored windows: an event window and a paired noise window, at every length or none."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waveline.functions.names import event_tag, magnitude_band
from waveline.operators import blocks
from waveline.operators.segments import holding

PRE, NOISE_OFFSET, LENGTHS, TAIL = 2.0, 300.0, (6.0, 10.0, 20.0), 60.0


def candidates(events: DataFrame, heads: DataFrame, keys: list[str], fs: float, noise_offset: float = NOISE_OFFSET) -> DataFrame:
    """Events whose noise window and a minute after P lie inside the record of any component."""
    extent = heads.groupBy(*keys).agg(F.min("t0").alias("_lo"), F.max(F.col("t0") + F.col("n") / F.lit(fs)).alias("_hi"))
    near = events.join(extent, keys)
    return near.where((F.col("p_epoch") >= F.col("_lo") + noise_offset) & (F.col("p_epoch") <= F.col("_hi") - TAIL)).drop("_lo", "_hi")


def cut(events: DataFrame, segments: DataFrame, keys: list[str], fs: float, lengths: tuple[float, ...] = LENGTHS, pre: float = PRE, noise_offset: float = NOISE_OFFSET, derived: Column | None = None) -> DataFrame:
    """One row of each event, length and kind (``eq``, ``noise``) with whole-number samples Z, N, E.

    An event is kept only if all components hold it whole at every length, so that the lengths
    hold the same events: that is decided on headers, and samples are fetched of what is kept.
    Events carry ``keys``, ``event_id``, ``p_epoch`` and ``cut_epoch``. ``derived`` as in ``blocks.fetch``.
    """
    heads = blocks.heads(segments)
    kinds = F.explode(F.array(F.struct(F.lit("eq").alias("kind"), (F.col("cut_epoch") - pre).alias("start")), F.struct(F.lit("noise").alias("kind"), (F.col("p_epoch") - noise_offset).alias("start"))))
    asked = candidates(events, heads, keys, fs, noise_offset).select(*keys, "event_id", kinds.alias("x")).select(*keys, "event_id", "x.*")
    wanted = [(f"_{k}{role}", role, float(x), int(np.rint(x * fs))) for role in "ZNE" for k, x in enumerate(lengths)]
    held = holding(asked, heads, keys, fs, "start", {c: want for c, *_, want in wanted}, {c: role for c, role, *_ in wanted})
    held = held.where(" and ".join(f"{c} is not null" for c, *_ in wanted))
    n = F.count("*").over(Window.partitionBy(*keys, "event_id"))
    kept = held.withColumn("_n", n).where(F.col("_n") == 2)
    each = F.explode(F.array(*[F.struct(F.lit(role).alias("role"), F.lit(x).alias("length_s"), F.lit(want).alias("want"), F.col(f"{c}.seg_id").alias("seg_id"), F.col(f"{c}.at").alias("at")) for c, role, x, want in wanted]))
    requests = kept.select(*keys, "event_id", "kind", "start", each.alias("x")).select(*keys, "event_id", "kind", "start", "x.*")
    got = blocks.values(blocks.fetch(requests, segments, [*keys, "role"], "at", "want", derived))
    whole = got.groupBy(*keys, "event_id", "length_s", "kind", "start").agg(F.map_from_entries(F.collect_list(F.struct("role", "samples"))).alias("by"))
    samples = F.transform(F.array(*map(F.lit, "ZNE")), lambda r: F.transform(F.element_at("by", r), lambda v: v.cast("int")))
    tag = F.concat(F.when(F.col("kind") == "noise", "noise_").otherwise(""), event_tag("event_id"), F.lit("_raw"))
    return whole.select(*keys, "event_id", "length_s", "kind", tag.alias("tag"), F.col("start").alias("t0"), samples.alias("samples"))


def kept_by_band(windows: DataFrame, events: DataFrame, keys: list[str]) -> DataFrame:
    """Kept events by half-magnitude band."""
    kept = windows.select(*keys, "event_id").distinct().join(events.select(*keys, "event_id", "mag"), [*keys, "event_id"])
    return kept.groupBy(*keys, magnitude_band("mag").alias("band")).agg(F.count("*").alias("kept"))
