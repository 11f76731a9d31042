"""Station noise statistics from conditioned pieces of segments."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waveline.operators import blocks
from waveline.operators.signal import clean_block

SAMPLE_CHUNKS, PIECE_SECONDS, TRIM, LEAST_SECONDS = 6, 3600.0, 0.1, 10.0


def even_sample(chunks: DataFrame, keys: list[str], order: str, k: int = SAMPLE_CHUNKS) -> DataFrame:
    """At most ``k`` rows of each key, spread evenly over their order, both ends included."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = chunks.withColumn("_i", F.row_number().over(w) - 1).withColumn("_n", F.count("*").over(Window.partitionBy(*keys)))
    steps = F.greatest(F.least(F.col("_n"), F.lit(k)) - 1, F.lit(1))
    places = F.transform(F.sequence(F.lit(0), F.least(F.col("_n"), F.lit(k)) - 1), lambda j: F.rint(j * (F.col("_n") - 1) / steps).cast("int"))
    return rows.where(F.array_contains(places, F.col("_i"))).drop("_i", "_n")


def piece_moments(segments: DataFrame, fs: float, low: float = 1.0, high: float = 45.0, piece_seconds: float = PIECE_SECONDS, keys: list[str] = ("station", "chunk", "role")) -> DataFrame:
    """``(station, role, s, ss, n)`` of each conditioned piece of at least ten seconds.

    Segments are in blocks. Pieces are found on headers and each is read by itself, so memory
    doesn't grow with a segment.
    """
    piece, least = int(round(piece_seconds * fs)), LEAST_SECONDS * fs
    begin = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(piece).cast("long"))).alias("at")
    asked = blocks.heads(segments).select(*keys, "seg_id", "n", begin)
    asked = asked.select(*keys, "seg_id", "at", F.least(F.lit(piece), F.col("n") - F.col("at")).cast("int").alias("want")).where(F.col("want") >= least)

    def work(batches):
        for batch in batches:
            rows = []
            data = blocks.packed_arrays(batch.column(2))
            for n in sorted({len(x) for x in data}):  # pieces of one length at once, a few million samples at a time
                some = [i for i, x in enumerate(data) if len(x) == n]
                step = max(1, 4_000_000 // n)
                for k in range(0, len(some), step):
                    c = clean_block(np.stack([data[i] for i in some[k : k + step]]), fs, low, high)
                    rows += zip(some[k : k + step], c.sum(1).tolist(), (c * c).sum(1).tolist(), [n] * len(c), strict=True)
            at = batch.select(["station", "role"]).take(pa.array([r[0] for r in rows], pa.int64()))
            cols = [pa.array([r[k] for r in rows], t) for k, t in ((1, pa.float64()), (2, pa.float64()), (3, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*at.columns, *cols], ["station", "role", "s", "ss", "n"])

    rows = blocks.fetch(asked, segments, list(keys), "at", "want").select("station", "role", "samples")
    return rows.mapInArrow(work, "station string, role string, s double, ss double, n bigint")


def _sigma(ss, s, n):
    return F.sqrt(F.greatest(F.try_divide(ss, n) - F.pow(F.try_divide(s, n), 2), F.lit(0.0)))


def _between(lo: pd.Series, hi: pd.Series, share: pd.Series) -> pd.Series:
    """``lo * (1 - share) + hi * share``, the first product and the sum rounded once, as the SQL's engine has it."""
    return pd.Series([float(Fraction(a) * Fraction(1 - x) + Fraction(b * x)) for a, b, x in zip(lo.tolist(), hi.tolist(), share.tolist(), strict=True)], dtype="float64")


def _limits(per: DataFrame, keys: list[str], q: float) -> DataFrame:
    """``(keys, _limit)``: the linearly interpolated quantile ``q`` of ``sd``.

    To the last digit: deviations of short pieces are often equal but for that, and a limit among
    them takes some in and leaves others out. One row of each group passes Python.
    """
    mine = Window.partitionBy(*keys)
    ranked = per.groupBy(*keys, "sd").agg(F.count("*").alias("_c")).withColumns({"_end": F.sum("_c").over(mine.orderBy("sd")), "_pos": F.lit(q) * (F.sum("_c").over(mine) - 1)})
    at = lambda p: F.max(F.when((F.col("_end") - F.col("_c") <= p) & (p < F.col("_end")), F.col("sd")))
    ends = ranked.groupBy(*keys).agg(at(F.floor("_pos")).alias("_lo"), at(F.ceil("_pos")).alias("_hi"), F.first(F.col("_pos") - F.floor("_pos")).alias("_share"))
    return ends.select(*keys, F.pandas_udf(_between, "double")("_lo", "_hi", "_share").alias("_limit"))


def noise_statistics(pieces: DataFrame, keys: list[str] = ("station", "role"), trim: float = TRIM) -> DataFrame:
    """``(keys, mu, sigma, sigma_trimmed, sigma_median, n_samples, n_pieces, loud)`` from piece moments.

    The trimmed deviation pools the pieces whose own is at most the ``1 - trim`` quantile. A
    single piece counts only if its deviation isn't zero. ``loud``: over twice the trimmed one.
    """
    per = pieces.withColumn("sd", _sigma(F.col("ss"), F.col("s"), F.col("n")))
    whole = per.groupBy(*keys).agg(
        F.sum("s").alias("_s"), F.sum("ss").alias("_ss"), F.sum("n").alias("n_samples"), F.count("*").alias("n_pieces"),
        F.median("sd").alias("sigma_median"),
    )
    whole = whole.join(_limits(per, list(keys), 1.0 - trim), list(keys), "left")
    kept = per.join(whole.select(*keys, "_limit", "n_pieces"), list(keys))
    kept = kept.where(F.when(F.col("n_pieces") > 1, F.col("sd") <= F.col("_limit")).otherwise(F.col("sd") > 0))
    quiet = kept.groupBy(*keys).agg(F.sum("s").alias("_qs"), F.sum("ss").alias("_qss"), F.sum("n").alias("_qn"))
    out = whole.join(quiet, list(keys), "left")
    out = out.withColumns({"mu": F.try_divide("_s", "n_samples"), "sigma": _sigma(F.col("_ss"), F.col("_s"), F.col("n_samples")), "sigma_trimmed": F.coalesce(_sigma(F.col("_qss"), F.col("_qs"), F.col("_qn")), F.lit(0.0))})
    return out.select(*keys, "mu", "sigma", "sigma_trimmed", "sigma_median", "n_samples", "n_pieces", (F.col("sigma") > 2 * F.col("sigma_trimmed")).alias("loud"))


def made_of(segments: DataFrame) -> DataFrame:
    """``(station, chunk, band)`` of the chunks that pieces were made of."""
    band = F.expr("upper(substring(channel, 1, length(channel) - 1))")
    return segments.where("block = 0").groupBy("station", "chunk").agg(F.min(band).alias("band"))


def station_baseline(pieces: DataFrame, made: DataFrame, fs: float, low: float = 1.0, high: float = 45.0, piece_seconds: float = PIECE_SECONDS, trim: float = TRIM) -> DataFrame:
    """Every station's statistics from its pieces (``piece_moments``), with what they were made by (``made_of``)."""
    stats = noise_statistics(pieces, ["station", "role"], trim)
    by = made.groupBy("station").agg(F.map_from_entries(F.collect_list(F.struct("chunk", "band"))).alias("chunks"), F.array_sort(F.collect_set("band")).alias("bands"))
    fixed = {"fs": fs, "freqmin": low, "freqmax": high, "piece_seconds": piece_seconds, "trim": trim}
    return stats.join(by, "station").withColumns({k: F.lit(float(v)) for k, v in fixed.items()}).withColumn("several_bands", F.size("bands") > 1)


def passband_fits(baseline: DataFrame, low: float, high: float) -> DataFrame:
    """Stations with whether their baseline serves a scan at this passband, and why not."""
    fits = (F.col("freqmin").isNull()) | ((F.col("freqmin") == low) & (F.col("freqmax") == high))
    return baseline.select("station", "freqmin", "freqmax").distinct().withColumn("fits", fits).withColumn("reason", F.when(~fits, "another passband"))

