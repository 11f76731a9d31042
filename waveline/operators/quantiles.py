"""Exact quantiles at positions that differ by group and are only known at run time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waveline.durable import checkpoint, measured_broadcast

#: Parts that a bucket is divided into at each level, a power of two so that digits are exact; values
#: of one bucket that are ranked by sorting; levels, which are as many digits as a double has.
BUCKETS, SORTED, LEVELS = 1024, 10_000, 6


def quantiles_at(values: DataFrame, keys: list[str], value: str, wanted: DataFrame, q: str = "q", out: str = "quantile", sorted_at_once: int = SORTED) -> DataFrame:
    """``wanted`` with the linearly interpolated quantile ``q`` of its group's values.

    By selection: values are counted by bucket, and only the buckets that a wanted position falls
    into are counted by their parts, and so on, until what is left of a bucket is few enough to
    sort. However values crowd (nearly all under a thousandth), no task orders more. Values are
    meant to lie in [0, 1]; others share the end buckets, which aren't divided.
    """
    rows = values.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    asked = wanted.join(rows.groupBy(*keys).agg(F.count("*").alias("_all")), keys).withColumn("_pos", F.col(q) * (F.col("_all") - 1))
    asked = checkpoint(asked.withColumns({"_lo": F.floor("_pos"), "_hi": F.ceil("_pos")}))
    targets = asked.select(*keys, F.explode(F.array("_lo", "_hi")).alias("_t")).distinct()
    targets = targets.withColumns({"_path": F.lit("").cast("string"), "_base": F.lit(0).cast("long")})
    digit = F.least(F.greatest(F.floor(F.col("_r") * BUCKETS), F.lit(-1)), F.lit(BUCKETS))
    left = rows.withColumns({"_path": F.lit("").cast("string"), "_r": F.col("_v"), "_n": F.lit(1).cast("long")})
    for level in range(LEVELS):
        dealt = left.withColumn("_d", digit)
        sums = dealt.groupBy(*keys, "_path", "_d").agg(F.sum("_n").alias("_bn"))
        over = Window.partitionBy(*keys, "_path").orderBy("_d")
        sums = sums.withColumn("_before", F.sum("_bn").over(over) - F.col("_bn"))
        place = F.col("_t") - F.col("_base") - F.col("_before")
        met = targets.join(sums, [*keys, "_path"]).where((place >= 0) & (place < F.col("_bn")))
        deeper = F.concat_ws("/", "_path", "_d")
        met = checkpoint(met.select(*keys, "_t", "_path", "_d", deeper.alias("_next"), (F.col("_base") + F.col("_before")).alias("_base"), "_bn"))
        some = measured_broadcast(met.select(*keys, "_path", "_d", "_next").distinct())
        left = dealt.join(some, [*keys, "_path", "_d"]).select(*keys, "_v", "_n", F.col("_next").alias("_path"), (F.col("_r") * BUCKETS - F.col("_d")).alias("_r"))
        if not level:  # equal values are counted once, of the buckets that are wanted
            left = left.groupBy(*keys, "_v", "_path", "_r").agg(F.sum("_n").alias("_n"))
        left = checkpoint(left)
        targets = met.select(*keys, "_t", F.col("_next").alias("_path"), "_base")
        inside = (F.col("_r") >= 0) & (F.col("_r") < 1)  # the end buckets aren't divided
        most = left.where(inside).groupBy(*keys, "_path").agg(F.count("*").alias("_k")).agg(F.max("_k")).head()[0]
        if (most or 0) <= sorted_at_once:
            break
    within = Window.partitionBy(*keys, "_path").orderBy("_v")
    ranked = left.withColumn("_end", F.sum("_n").over(within)).select(*keys, "_path", "_v", (F.col("_end") - F.col("_n")).alias("_from"), "_end")
    place = F.col("_t") - F.col("_base")
    found = targets.join(ranked, [*keys, "_path"]).where((place >= F.col("_from")) & (place < F.col("_end"))).select(*keys, "_t", "_v")
    for name in ("lo", "hi"):
        side = found.select(*keys, F.col("_t").alias(f"_{name}"), F.col("_v").alias(f"_v{name}"))
        asked = asked.join(side, [*keys, f"_{name}"])
    return asked.select(*wanted.columns, (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * (F.col("_pos") - F.col("_lo"))).alias(out))
