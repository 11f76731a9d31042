"""What requiring two stations to agree costs and buys, for all pairs and budgets in one plan.

Only the spans both stations recorded count; catalogued events are taken out of both streams;
recall is asked of events that both stations recorded well enough.

A station's scores serve all its pairs, and are not copied for each. What a pair leaves of them is
worked out as intervals, which are few; then the scores meet the intervals by station and day, and
are counted by level where they meet. Thresholds, declarations and recall need a pair's highest
scores only: by these counts each station's tail is taken so deep that every pair's thresholds lie in it.
Buckets in which intervals meet follow their lengths, which get shorter as windows get denser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waveline.durable import checkpoint, measured_broadcast
from waveline.operators.alarms import DAY, declarations, independent_per_day, tail_thresholds
from waveline.operators.intervals import coalesce_intervals, fitted_bucket, intersect, points_in, predecessors, within

BUDGETS = (100.0, 30.0, 10.0, 3.0, 1.0, 0.1)
VP, SNR_MIN, SIGNAL_POST, GUARD_PRE, GUARD_POST, CLUSTER, LEAST_DAYS = 6.0, 3.0, 20.0, 10.0, 60.0, 60.0, 1.0
_PAIR = ["station_a", "station_b"]
_BY = [*_PAIR, "side"]
#: Steps of the score by which a pair's scores are counted and a station's tail is taken.
LEVELS = 10_000


def joint_spans(scores: DataFrame, pairs: DataFrame, steps: DataFrame, slack: float = 2.5) -> DataFrame:
    """``(station_a, station_b, lo, hi)``: recorded at both. The first station's step rules both coverages.

    A station needs a coverage for each step that a partner rules it with, however little they
    differ. Its windows are ordered once: what its least step breaks has the breaks of all its steps.
    """
    asked = pairs.join(steps.select(F.col("station").alias("station_a"), "step"), "station_a")
    sides = {s: asked.select(*_PAIR, "step", F.col(f"station_{s}").alias("station")) for s in "ab"}
    needed = checkpoint(sides["a"].select("station", "step").unionByName(sides["b"].select("station", "step")).distinct())
    least = needed.groupBy("station").agg(F.min("step").alias("_least"))
    gap = F.col("t") - F.col("before")
    breaks = predecessors(scores, ["station"]).join(F.broadcast(least), "station").where(F.col("before").isNull() | (gap > F.col("_least") * slack)).drop("_least")
    last = scores.groupBy("station").agg(F.max("t").alias("_last"))
    own = checkpoint(breaks).join(needed, "station").where(F.col("before").isNull() | (gap > F.col("step") * slack)).join(last, "station")
    end = F.coalesce(F.lead("before").over(Window.partitionBy("station", "step").orderBy("t")), F.col("_last"))
    cover = checkpoint(own.select("station", "step", F.col("t").alias("lo"), (end + F.col("step")).alias("hi")))
    a, b = (sides[s].join(cover, ["station", "step"]).select(*_PAIR, "lo", "hi") for s in "ab")
    return intersect(a, b, _PAIR, fitted_bucket(cover))


def quiet_spans(spans: DataFrame, seen: DataFrame, window_seconds: float, guard_pre: float = GUARD_PRE, guard_post: float = GUARD_POST) -> DataFrame:
    """``(pair, side, station, lo, lo_open, hi, hi_open)``: what no event's guard touches of the spans.

    ``spans`` is ``(pair, side, station, lo, hi)``, ``seen`` ``(pair, side, p_epoch)``. Spans and
    guards are closed, so a piece is open where a guard ends or begins.
    """
    guards = seen.select(*_BY, (F.col("p_epoch") - guard_pre - window_seconds).alias("lo"), (F.col("p_epoch") + guard_post).alias("hi"))
    guards = coalesce_intervals(guards, _BY)
    whole = spans.withColumns({"slo": F.col("lo"), "shi": F.col("hi")})
    guards = checkpoint(guards)
    cut = checkpoint(intersect(whole, guards, _BY, fitted_bucket(spans, guards), closed=True, carry=(["station", "slo", "shi"], [])))
    w = Window.partitionBy(*_BY, "slo").orderBy("lo")
    before, after = F.lag("hi").over(w), F.lead("lo").over(w)
    cut = cut.withColumns({"_before": before, "_after": after})
    head = cut.select(*_BY, "station", F.coalesce("_before", "slo").alias("lo"), F.col("_before").isNotNull().alias("lo_open"), F.col("lo").alias("hi"), F.lit(True).alias("hi_open"))
    tail = cut.where("_after is null").select(*_BY, "station", F.col("hi").alias("lo"), F.lit(True).alias("lo_open"), F.col("shi").alias("hi"), F.lit(False).alias("hi_open"))
    free = whole.join(cut.select(*_BY, "slo").distinct(), [*_BY, "slo"], "left_anti").select(*_BY, "station", "lo", F.lit(False).alias("lo_open"), "hi", F.lit(False).alias("hi_open"))
    return head.unionByName(tail).unionByName(free).where("lo < hi or (lo = hi and not lo_open and not hi_open)")


def in_pieces(scores: DataFrame, pieces: DataFrame) -> DataFrame:
    """Scores ``(station, t, p)`` with the ``(pair, side)`` whose pieces they lie in, by station and time. ``pieces`` should be stored."""
    width = F.lit(fitted_bucket(pieces))
    parts = F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))).alias("_d")
    few = measured_broadcast(checkpoint(pieces.select(*_BY, "station", "lo", "lo_open", "hi", "hi_open", parts)))
    t = F.col("t")
    inside = ((t > F.col("lo")) | ((t == F.col("lo")) & ~F.col("lo_open"))) & ((t < F.col("hi")) | ((t == F.col("hi")) & ~F.col("hi_open")))
    return scores.withColumn("_d", F.floor(t / width)).join(few, ["station", "_d"]).where(inside).select(*_BY, "station", "t", "p")


def tails(scores: DataFrame, counts: DataFrame, needs: DataFrame, level: Column) -> DataFrame:
    """The scores of each station from the level on that holds the ``need`` highest of every ``(pair, side)``.

    ``counts`` is ``(pair, side, station, level, n)``, ``needs`` ``(pair, side, need)``.
    """
    above = F.sum("n").over(Window.partitionBy(*_BY).orderBy(F.desc("level")))
    deep = counts.withColumn("_above", above).join(needs, _BY).where(F.col("_above") >= F.col("need"))
    floor = deep.groupBy(*_BY, "station").agg(F.max("level").alias("_level")).groupBy("station").agg(F.min("_level").alias("_floor"))
    return scores.where("p is not null").join(measured_broadcast(checkpoint(floor)), "station").where(level >= F.col("_floor")).drop("_floor")


def measure(scores: DataFrame, pairs: DataFrame, steps: DataFrame, arrivals: DataFrame, snr: DataFrame | None, window_seconds: float, budgets: tuple[float, ...] = BUDGETS, vp: float = VP, coincidence_seconds: float | None = None, snr_min: float = SNR_MIN, cluster_seconds: float = CLUSTER, guard_pre: float = GUARD_PRE, guard_post: float = GUARD_POST, signal_post: float = SIGNAL_POST) -> DataFrame:
    """The coincidence table of every pair and budget, in the fixed column order.

    ``scores`` (station, t, p), ``pairs`` (station_a, station_b, separation_km), ``steps``
    (station, step), ``arrivals`` (station, event_id, p_epoch), ``snr`` (station, event_id, snr)
    or None, which leaves recall null. A pair that overlaps for less than a day has no rows.
    """
    spans = checkpoint(joint_spans(scores, pairs, steps))
    w = F.lit(float(coincidence_seconds)) if coincidence_seconds is not None else F.col("separation_km") / vp
    days = spans.groupBy(*_PAIR).agg((F.sum(F.col("hi") - F.col("lo")) / DAY).alias("days")).where(F.col("days") >= LEAST_DAYS)
    facts = checkpoint(days.join(pairs, _PAIR).withColumn("w", w))
    length = fitted_bucket(spans)
    spans = spans.join(facts.select(*_PAIR), _PAIR)
    sided = facts.select(*_PAIR, F.explode(F.array(F.struct(F.lit("a").alias("side"), F.col("station_a").alias("station")), F.struct(F.lit("b").alias("side"), F.col("station_b").alias("station")))).alias("x")).select(*_PAIR, "x.*")
    by = _BY
    joint = checkpoint(spans.join(sided, _PAIR).select(*by, "station", "lo", "hi"))
    near = arrivals.select("station", "event_id", "p_epoch").dropDuplicates(["station", "event_id"]).join(sided, "station")
    seen = checkpoint(points_in(near, spans, _PAIR, t="p_epoch", bucket=length))
    pieces = checkpoint(quiet_spans(joint, seen, window_seconds, guard_pre, guard_post))
    level = F.floor(F.least(F.greatest(F.col("p").cast("double"), F.lit(0.0)), F.lit(1.0)) * LEVELS)
    counts = checkpoint(in_pieces(scores, pieces).groupBy(*by, "station", level.alias("level")).agg(F.count("*").alias("n")))
    n = counts.groupBy(*by).agg(F.sum("n").alias("n"))
    asked = n.join(sided, by).join(facts.select(*_PAIR, "days"), _PAIR).withColumn("budget", F.explode(F.array(*[F.lit(float(x)) for x in budgets])))
    asked = asked.where(F.col("budget") * F.col("days") < F.col("n")).withColumn("pos", (1 - F.col("budget") * F.col("days") / F.col("n")) * (F.col("n") - 1))
    asked = checkpoint(asked.withColumn("need", F.col("n") - F.floor("pos")))
    tail = checkpoint(tails(scores, counts, asked.groupBy(*by).agg(F.max("need").alias("need")), level))
    quiet = checkpoint(in_pieces(tail, pieces))
    limits = checkpoint(tail_thresholds(quiet, by, asked))
    thr = limits.groupBy(*_PAIR, "budget").agg(F.max(F.when(F.col("side") == "a", F.col("thr"))).alias("thr_a"), F.max(F.when(F.col("side") == "b", F.col("thr"))).alias("thr_b")).where("thr_a is not null and thr_b is not null")
    of_side = thr.select(*_PAIR, "budget", F.explode(F.array(F.struct(F.lit("a").alias("side"), F.col("thr_a").alias("thr")), F.struct(F.lit("b").alias("side"), F.col("thr_b").alias("thr")))).alias("x")).select(*_PAIR, "budget", "x.*")
    declared = checkpoint(declarations(quiet.join(of_side, by), [*by, "budget"], F.col("thr"), cluster_seconds))
    a, b = (declared.where(F.col("side") == s).drop("side") for s in "ab")
    both = within(a, b.join(facts.select(*_PAIR, "w"), _PAIR), [*_PAIR, "budget"], "w")
    count = lambda df, name: df.groupBy(*_PAIR, "budget").agg(F.count("*").alias(name))
    out = thr.join(facts, _PAIR)
    for df, name in ((a, "na"), (b, "nb"), (both, "n2")):
        out = out.join(count(df, name), [*_PAIR, "budget"], "left")
    out = out.fillna(0, ["na", "nb", "n2"])
    seconds = F.col("days") * DAY
    indep = independent_per_day(F.col("na"), F.col("nb"), seconds, F.col("w"))
    out = out.withColumns({"_indep": indep, "_both": F.col("n2") / F.col("days")})
    if snr is None:
        out = out.withColumn("recall_both", F.lit(None).cast("double"))
    else:
        whole = joint.withColumns({"lo_open": F.lit(False), "hi_open": F.lit(False)})
        least = checkpoint(of_side.join(sided, by).groupBy("station").agg(F.min("thr").alias("_thr")))
        high = tail.join(measured_broadcast(least), "station").where(F.col("p").cast("double") > F.col("_thr")).drop("_thr")
        out = out.join(recall(in_pieces(high, whole), seen, snr, of_side, window_seconds, snr_min, signal_post), [*_PAIR, "budget"], "left")
    return out.select(
        F.col("budget").alias("budget_per_day"), "separation_km", F.col("days").alias("joint_days"), F.col("w").alias("coincidence_seconds"), *_PAIR, "thr_a", "thr_b",
        (F.col("na") / F.col("days")).alias("a_per_day"), (F.col("nb") / F.col("days")).alias("b_per_day"), F.col("_both").alias("both_per_day"), F.col("_indep").alias("independent_per_day"),
        F.when(F.col("_indep") > 0, F.col("_both") / F.col("_indep")).alias("excess_over_independent"), "recall_both",
    )


def good_events(seen: DataFrame, snr: DataFrame, snr_min: float = SNR_MIN) -> DataFrame:
    """``(pair, side, station, event_id, p_epoch)`` of the events at ``snr_min`` or over at both stations."""
    strong = checkpoint(seen.join(snr.where(F.col("snr") >= snr_min).select("station", "event_id"), ["station", "event_id"]))
    both = strong.groupBy(*_PAIR, "event_id").agg(F.count_distinct("side").alias("n")).where("n = 2").drop("n")
    return strong.join(both, [*_PAIR, "event_id"])


def highest_near(in_span: DataFrame, events: DataFrame, before: float, after: float) -> DataFrame:
    """``(pair, side, event_id, best)``: the highest score from ``before`` seconds before each event to ``after`` after it, both ends included.

    A score isn't met with every event near it, of which there are more the denser both are. Buckets
    are half as long as what is asked, so an event asks for the end of one, the beginning of another and
    what lies between: highest scores so far, along a bucket's scores and events in order. ``before + after`` is positive.
    """
    lo, hi, width = F.col("p_epoch") - before, F.col("p_epoch") + after, (before + after) / 2
    b0, b1 = F.floor(lo / width), F.floor(hi / width)
    end = lambda b, t, back: F.struct(b.alias("_b"), t.alias("t"), F.lit(back).alias("_back"))
    between = F.when(b1 - b0 > 1, F.transform(F.sequence(b0 + 1, b1 - 1), lambda b: end(b, F.lit(float("inf")), False)))
    ends = F.explode(F.concat(F.array(end(b0, lo, True), end(b1, hi, False)), F.coalesce(between, F.array().cast("array<struct<_b: bigint, t: double, _back: boolean>>"))))
    asked = events.select(*_BY, "event_id", ends.alias("_x")).select(*_BY, "event_id", "_x.*")
    scored = in_span.select(*_BY, F.floor(F.col("t") / width).alias("_b"), "t", F.col("p").cast("double").alias("_p"))
    w = Window.partitionBy(*_BY, "_b")
    so_far, from_here = (F.max("_p").over(w.orderBy(o).rangeBetween(Window.unboundedPreceding, Window.currentRow)) for o in (F.asc("t"), F.desc("t")))
    met = scored.unionByName(asked, allowMissingColumns=True).withColumns({"_so_far": so_far, "_from": from_here}).where("event_id is not null")
    return met.groupBy(*_BY, "event_id").agg(F.max(F.when(F.col("_back"), F.col("_from")).otherwise(F.col("_so_far"))).alias("best"))


def recall(in_span: DataFrame, seen: DataFrame, snr: DataFrame, of_side: DataFrame, window_seconds: float, snr_min: float = SNR_MIN, signal_post: float = SIGNAL_POST) -> DataFrame:
    """``(pair, budget, recall_both)``: the share of good events with a window over the threshold at
    both. ``in_span`` must have all scores over any threshold; others don't matter."""
    good = checkpoint(good_events(seen, snr, snr_min))
    best = highest_near(in_span, good, window_seconds, signal_post)
    fired = good.join(best, [*_PAIR, "side", "event_id"], "left").join(of_side, [*_PAIR, "side"])
    fired = fired.groupBy(*_PAIR, "budget", "event_id").agg(F.bool_and(F.coalesce(F.col("best") > F.col("thr"), F.lit(False))).alias("both"))
    return fired.groupBy(*_PAIR, "budget").agg(F.avg(F.col("both").cast("double")).alias("recall_both"))


def arrival_differences(good: DataFrame) -> DataFrame:
    """Least, greatest and median difference of an event's P times at a pair's stations."""
    two = good.groupBy(*_PAIR, "event_id").agg((F.max("p_epoch") - F.min("p_epoch")).alias("d"))
    return two.groupBy(*_PAIR).agg(F.count("*").alias("events"), F.min("d").alias("least"), F.max("d").alias("greatest"), F.median("d").alias("median"))
