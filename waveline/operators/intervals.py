"""Interval algebra and range joins.

Times are epoch seconds as doubles. Everything that would be an inequality join carries an
equi key, the number of a time bucket, and the inequality as a residual condition, so that it
plans as a shuffled or broadcast hash join instead of a nested loop. Gap-and-island operators
work in two levels: islands inside a bucket of time first, then the islands of a key, so that
no task sorts all rows of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86400.0


def _bucket(t: Column | str, width: float) -> Column:
    return F.floor((F.col(t) if isinstance(t, str) else t) / F.lit(width)).cast("long")


def _buckets(lo: Column, hi: Column, width: float) -> Column:
    return F.explode(F.sequence(_bucket(lo, width), _bucket(hi, width)))


def fitted_bucket(*intervals: DataFrame, lo: str = "lo", hi: str = "hi", most: float = DAY) -> float:
    """Twice the intervals' average length, at most ``most``: in buckets of it an interval lies one and
    a half times on average, and few lie in one however many there are. Intervals should be stored."""
    parts = [x.agg(F.sum(F.col(hi) - F.col(lo)), F.count("*")).head() for x in intervals]
    total, n = sum(x[0] or 0.0 for x in parts), sum(x[1] for x in parts)
    return min(most, max(2 * total / n, 1e-3)) if n else most


def _islands(rows: DataFrame, keys: list[str], lo: str, hi: str, gap: Column, aggs: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(lo, hi)
    ahead = F.max(hi).over(w.rowsBetween(Window.unboundedPreceding, -1))
    cut = F.when(ahead.isNull() | (F.col(lo) - ahead > gap), 1).otherwise(0)
    numbered = rows.withColumn("_cut", cut).withColumn("_island", F.sum("_cut").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_island").agg(*aggs).drop("_island")


def coalesce_intervals(intervals: DataFrame, keys: list[str], lo: str = "lo", hi: str = "hi", tolerance: float = 0.0, bucket: float = DAY) -> DataFrame:
    """Disjoint intervals that cover the same times; those that touch, or lie at most ``tolerance`` apart, become one."""
    aggs = [F.min(lo).alias(lo), F.max(hi).alias(hi)]
    rows = intervals.select(*keys, lo, hi).withColumn("_b", _bucket(lo, bucket))
    inner = _islands(rows, [*keys, "_b"], lo, hi, F.lit(tolerance), aggs).drop("_b")
    return _islands(inner, keys, lo, hi, F.lit(tolerance), aggs)


def gap_islands(points: DataFrame, keys: list[str], t: str, gap: str | float, aggs: dict[str, tuple[str, str]] | None = None, bucket: float = DAY) -> DataFrame:
    """``(keys, first, last, n, ...)``: runs of points whose neighbours are at most ``gap`` apart.

    ``gap`` is a number, or a column that is the same for all rows of a key. ``aggs`` names
    further results: name to (column, SQL function that is its own merge, such as ``max``).
    """
    aggs = aggs or {}
    gap_name = gap if isinstance(gap, str) else None
    carried = [gap_name] if gap_name and gap_name not in keys else []
    limit = F.col(gap_name) if gap_name else F.lit(float(gap))
    rows = points.select(*keys, *carried, F.col(t).alias("first"), F.col(t).alias("last"), F.lit(1).cast("long").alias("n"), *[F.col(c).alias(name) for name, (c, _) in aggs.items()])
    merge = [F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"), *[getattr(F, f)(name).alias(name) for name, (_, f) in aggs.items()]]
    inner = _islands(rows.withColumn("_b", _bucket("first", bucket)), [*keys, *carried, "_b"], "first", "last", limit, merge).drop("_b")
    return _islands(inner, [*keys, *carried], "first", "last", limit, merge).drop(*carried)


def predecessors(points: DataFrame, keys: list[str], t: str = "t", bucket: float = DAY) -> DataFrame:
    """``(keys, t, before)``: every point with the one before it of its key, null for a key's first.

    Points are ordered inside a bucket of time; a bucket's first one follows the last of the bucket before.
    """
    rows = points.where(F.col(t).isNotNull()).select(*keys, t, _bucket(t, bucket).alias("_b"))
    inner = rows.withColumn("before", F.lag(t).over(Window.partitionBy(*keys, "_b").orderBy(t))).where("before is not null")
    ends = rows.groupBy(*keys, "_b").agg(F.min(t).alias(t), F.max(t).alias("_last"))
    firsts = ends.withColumn("before", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_b")))
    return inner.select(*keys, t, "before").unionByName(firsts.select(*keys, t, "before"))


def coverage_spans(scores: DataFrame, keys: list[str], step: str | float, t: str = "t", slack: float = 2.5, bucket: float = DAY) -> DataFrame:
    """``(keys, lo, hi)``: what was scored, broken where windows are over ``slack`` steps apart."""
    s = F.col(step) if isinstance(step, str) else F.lit(float(step))
    by = [*keys, step] if isinstance(step, str) and step not in keys else keys
    rows = scores.withColumn("_gap", s * slack)
    found = gap_islands(rows, [*by, "_gap"], t, "_gap", bucket=bucket)
    return found.select(*keys, F.col("first").alias("lo"), (F.col("last") + s).alias("hi"))


def points_in(points: DataFrame, spans: DataFrame, keys: list[str], t: str = "t", lo: str = "lo", hi: str = "hi", how: str = "left_semi", bucket: float = DAY) -> DataFrame:
    """The points inside any span, both ends included; those inside none with ``how='left_anti'``.

    Only spans are put into several buckets, so a point is compared once and comes once.
    """
    left = points.withColumn("_b", _bucket(t, bucket))
    right = spans.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col(lo).alias("_lo"), F.col(hi).alias("_hi"), _buckets(F.col(lo), F.col(hi), bucket).alias("_rb"))
    on = (F.col("_b") == F.col("_rb")) & F.col(t).between(F.col("_lo"), F.col("_hi"))
    for k in keys:
        on &= F.col(k) == F.col(f"_r_{k}")
    return left.join(right, on, how).drop("_b")


def within(a: DataFrame, b: DataFrame, keys: list[str], window: str | float, t: str = "t", how: str = "left_semi", bucket: float = 600.0) -> DataFrame:
    """The rows of ``a`` with a row of ``b`` at most ``window`` away, both ends included.

    A window given by name is a column of ``b``.
    """
    w = F.col(window) if isinstance(window, str) else F.lit(float(window))
    spans = b.select(*keys, (F.col(t) - w).alias("lo"), (F.col(t) + w).alias("hi"))
    return points_in(a, spans, keys, t, how=how, bucket=bucket)


def unexplained(scores: DataFrame, arrivals: DataFrame, keys: list[str], win_s: float, guard_pre: float = 10.0, guard_post: float = 60.0, how: str = "left_anti") -> DataFrame:
    """Windows that no arrival's guard touches (the touched ones with ``how='left_semi'``)."""
    guards = arrivals.select(*keys, (F.col("p_epoch") - guard_pre - win_s).alias("lo"), (F.col("p_epoch") + guard_post).alias("hi"))
    return points_in(scores, guards, keys, how=how, bucket=3600.0)


def intersect(a: DataFrame, b: DataFrame, keys: list[str], bucket: float = DAY, closed: bool = False, carry: tuple[list[str], list[str]] = ((), ())) -> DataFrame:
    """``(keys, lo, hi, ...)``: the common parts of two sets of intervals, ``hi > lo``.

    Each pair is found in every bucket both touch and kept in the first of their common part,
    so no duplicates need dropping. ``carry`` names columns of either side to keep.
    """
    left = a.select(*keys, F.col("lo").alias("_alo"), F.col("hi").alias("_ahi"), *carry[0], _buckets(F.col("lo"), F.col("hi"), bucket).alias("_b"))
    right = b.select(*keys, F.col("lo").alias("_blo"), F.col("hi").alias("_bhi"), *carry[1], _buckets(F.col("lo"), F.col("hi"), bucket).alias("_b"))
    lo, hi = F.greatest("_alo", "_blo"), F.least("_ahi", "_bhi")
    met = left.join(right, [*keys, "_b"]).where((hi >= lo if closed else hi > lo) & (_bucket(lo, bucket) == F.col("_b")))
    return met.select(*keys, lo.alias("lo"), hi.alias("hi"), *carry[0], *carry[1])


def common_spans(segments: DataFrame, keys: list[str], fs: float, min_samples: int, bucket: float = DAY) -> DataFrame:
    """``(keys, t0, seg_z, off_z, seg_n, off_n, seg_e, off_e, n)``: where all three roles are unbroken.

    Segments are ``(keys, role, seg_id, t0, n)``. Offsets are samples into each segment, halves
    to the even one; a span shorter than ``min_samples`` is no span.
    """
    ends = segments.withColumns({"lo": F.col("t0"), "hi": F.col("t0") + F.col("n") / F.lit(fs)})
    side = {r: ends.where(F.col("role") == r).select(*keys, "lo", "hi", F.col("seg_id").alias(f"seg_{r.lower()}"), F.col("lo").alias(f"_s{r.lower()}")) for r in "ZNE"}
    least = F.lit(min_samples / fs)
    two = intersect(side["Z"], side["N"], keys, bucket, carry=(["seg_z", "_sz"], ["seg_n", "_sn"])).where(F.col("hi") - F.col("lo") >= least)
    three = intersect(two, side["E"], keys, bucket, carry=(["seg_z", "_sz", "seg_n", "_sn"], ["seg_e", "_se"])).where(F.col("hi") - F.col("lo") >= least)
    offset = lambda r: F.rint((F.col("lo") - F.col(f"_s{r}")) * fs).cast("long").alias(f"off_{r}")
    return three.select(*keys, F.col("lo").alias("t0"), "seg_z", offset("z"), "seg_n", offset("n"), "seg_e", offset("e"), ((F.col("hi") - F.col("lo")) * fs).cast("long").alias("n"))


def clip_spans(spans: DataFrame, near: DataFrame | None, keys: list[str], fs: float, win: int, step: int, bucket: float = DAY) -> DataFrame:
    """Spans cut down to what overlaps ``near``, window starts staying on the span's own lattice.

    ``near`` is ``(keys, lo, hi)``, disjoint; None leaves the spans as they are. Offsets move
    with the start: a column ``shift`` says by how many samples.
    """
    if near is None:
        return spans.withColumn("shift", F.lit(0).cast("long"))
    carried = [c for c in spans.columns if c not in keys]
    a = spans.withColumns({"lo": F.col("t0"), "hi": F.col("t0") + F.col("n") / F.lit(fs)})
    met = intersect(a, near, keys, bucket, carry=([*carried], [])).where(F.col("hi") - F.col("lo") >= win / fs)
    k0 = F.ceil((F.col("lo") - F.col("t0")) * fs / step).cast("long")
    room = ((F.col("hi") - F.col("t0")) * fs - k0 * step - win).cast("long")
    out = met.withColumns({"_k0": k0, "_n": F.floor(room / F.lit(step)).cast("long") + 1}).where("_n >= 1")
    moved = {"t0": F.col("t0") + F.col("_k0") * step / fs, "n": F.col("_n") * step + win - step, "shift": F.col("_k0") * step}
    moved |= {c: F.col(c) + F.col("_k0") * step for c in carried if c.startswith("off_")}
    return out.withColumns(moved).select(*keys, *carried, "shift")


def window_times(spans: DataFrame, fs: float, win: int, step: int) -> DataFrame:
    """One row of each window start inside the spans: the span's columns and ``t``."""
    n = F.floor((F.col("n") - win) / F.lit(step)).cast("long") + 1
    rows = spans.withColumn("_n", n).where("_n >= 1").withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    return rows.withColumn("t", F.col("t0") + F.col("_k") * step / fs).drop("_n", "_k")


def whole_days(lo: Column | str, hi: Column | str) -> Column:
    """Whole days from lo to hi (epoch seconds), cut down for each interval."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (lo, hi))
    return F.floor((b - a) / DAY).cast("long")
