import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from waveline.operators import alarms, intervals, quantiles

KEYS = ["k"]


def random_intervals(seed, n=200, keys=3, span=1000.0):
    rng = random.Random(seed)
    return [(rng.randrange(keys), lo := round(rng.uniform(0, span), 1), round(lo + rng.uniform(0.1, 20), 1)) for _ in range(n)]


def merge(rows, tolerance=0.0):
    out = {}
    for k, lo, hi in sorted(rows):
        have = out.setdefault(k, [])
        if have and lo - have[-1][1] <= tolerance:
            have[-1][1] = max(have[-1][1], hi)
        else:
            have.append([lo, hi])
    return sorted((k, lo, hi) for k, v in out.items() for lo, hi in v)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, lo double, hi double")


@pytest.mark.parametrize("bucket", [7.0, 86400.0])
def test_coalesce(spark, bucket):
    rows = random_intervals(1) + [(9, 0.0, 1.0), (9, 1.0, 2.0), (9, 2.5, 3.0)]
    got = sorted(map(tuple, intervals.coalesce_intervals(frame(spark, rows), KEYS, bucket=bucket).select("k", "lo", "hi").collect()))
    assert got == merge(rows)
    got = sorted(map(tuple, intervals.coalesce_intervals(frame(spark, rows), KEYS, tolerance=0.6, bucket=bucket).select("k", "lo", "hi").collect()))
    assert got == merge(rows, 0.6)


def test_intersect_is_the_two_pointer_merge(spark):
    a, b = merge(random_intervals(2)), merge(random_intervals(3))
    want = sorted((k, max(lo, x), min(hi, y)) for k, lo, hi in a for j, x, y in b if j == k and min(hi, y) > max(lo, x))
    got = sorted(map(tuple, intervals.intersect(frame(spark, a), frame(spark, b), KEYS, bucket=13.0).collect()))
    assert got == want


def test_points_and_bands(spark):
    rng = random.Random(4)
    spans = merge(random_intervals(5, 60))
    points = [(rng.randrange(3), round(rng.uniform(-5, 1050), 1)) for _ in range(500)] + [(k, lo) for k, lo, _ in spans[:5]] + [(k, hi) for k, _, hi in spans[:5]]
    df = spark.createDataFrame(points, "k int, t double")
    inside = sorted(p for p in points if any(k == p[0] and lo <= p[1] <= hi for k, lo, hi in spans))
    assert sorted(map(tuple, intervals.points_in(df, frame(spark, spans), KEYS, bucket=11.0).collect())) == inside
    out = intervals.points_in(df, frame(spark, spans), KEYS, how="left_anti", bucket=11.0)
    assert out.count() == len(points) - len(inside)
    other = [(rng.randrange(3), round(rng.uniform(0, 1000), 1)) for _ in range(60)]
    near = sorted(p for p in points if any(k == p[0] and abs(round(t - p[1], 6)) <= 7.5 for k, t in other))
    assert sorted(map(tuple, intervals.within(df, spark.createDataFrame(other, "k int, t double"), KEYS, 7.5, bucket=10.0).collect())) == near


def test_no_nested_loops(spark):
    spans, points = frame(spark, random_intervals(6)), spark.createDataFrame([(1, 2.0)], "k int, t double")
    for df in (intervals.points_in(points, spans, KEYS), intervals.intersect(spans, spans, KEYS), intervals.within(points, points, KEYS, 1.0)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def coverage(t, step, slack=2.5):
    cuts = [0, *[i + 1 for i in range(len(t) - 1) if t[i + 1] - t[i] > slack * step], len(t)]
    return [(t[a], t[b - 1] + step) for a, b in zip(cuts, cuts[1:]) if b > a]


def test_coverage_and_declarations(spark):
    rng = random.Random(7)
    t = sorted({round(rng.uniform(0, 5000), 1) for _ in range(400)})
    p = [rng.choice([0.1, 0.6, 0.9, 0.9]) for _ in t]
    df = spark.createDataFrame([("s", x, y) for x, y in zip(t, p)], "k string, t double, p double")
    got = sorted((r.lo, r.hi) for r in intervals.coverage_spans(df, KEYS, 6.0, bucket=100.0).collect())
    assert np.array(got) == pytest.approx(np.array(coverage(t, 6.0)))
    hits = [(x, y) for x, y in zip(t, p) if y > 0.5]
    groups = [[hits[0]]]
    for a, b in zip(hits, hits[1:]):
        groups.append([b]) if b[0] - a[0] > 20 else groups[-1].append(b)
    want = [max(g, key=lambda h: (h[1], -h[0])) for g in groups]
    assert sorted((r.t, r.p) for r in alarms.declarations(df, KEYS, 0.5, 20.0).collect()) == want
    assert alarms.declarations(df, KEYS, 2.0).collect() == []


def test_common_and_clipped_spans(spark):
    fs, rows = 10.0, []
    rng = random.Random(8)
    for role in "ZNE":
        at = 0.0
        for i in range(12):
            n = rng.randrange(50, 300)
            rows.append(("s", role, i, round(at, 1), n))
            at += n / fs + rng.choice([0.5, 3.0])
    df = spark.createDataFrame(rows, "k string, role string, seg_id int, t0 double, n bigint")
    spans = intervals.common_spans(df, KEYS, fs, 30, bucket=9.0)
    by = {r: [(t, n, i) for _, q, i, t, n in rows if q == r] for r in "ZNE"}
    want = []
    for tz, nz, iz in by["Z"]:
        for tn, nn, i_n in by["N"]:
            for te, ne, ie in by["E"]:
                lo, hi = max(tz, tn, te), min(tz + nz / fs, tn + nn / fs, te + ne / fs)
                if hi - lo >= 3.0:
                    want.append((lo, iz, round((lo - tz) * fs), i_n, round((lo - tn) * fs), ie, round((lo - te) * fs), int((hi - lo) * fs)))
    got = sorted(tuple(r)[1:] for r in spans.select("k", "t0", "seg_z", "off_z", "seg_n", "off_n", "seg_e", "off_e", "n").collect())
    assert got == sorted(want) and len(got) > 5
    near = [(10.25, 30.0), (55.0, 80.5)]
    clipped = intervals.clip_spans(spans, spark.createDataFrame([("s", *x) for x in near], "k string, lo double, hi double"), KEYS, fs, 20, 5)
    want_clip = []
    for t0, _, oz, *_rest, n in want:
        for a, b in near:
            lo, hi = max(t0, a), min(t0 + n / fs, b)
            if hi - lo >= 2.0:
                k0 = math.ceil((lo - t0) * fs / 5)
                count = int((hi - t0) * fs - k0 * 5 - 20) // 5 + 1
                if count >= 1:
                    want_clip.append((t0 + k0 * 5 / fs, oz + k0 * 5, count * 5 + 15))
    assert np.array(sorted((r.t0, r.off_z, r.n) for r in clipped.collect())) == pytest.approx(np.array(sorted(want_clip)))
    lattice = [(t0 + k * 5 / fs) for t0, _, n in want_clip for k in range((n - 20) // 5 + 1)]
    assert sorted(r.t for r in intervals.window_times(clipped, fs, 20, 5).collect()) == pytest.approx(sorted(lattice))


def test_quantiles_are_numpys(spark):
    rng = np.random.default_rng(1)
    values = {"a": rng.random(1000).round(2), "b": rng.random(7), "c": np.array([0.5])}
    df = spark.createDataFrame([(k, float(v)) for k, vs in values.items() for v in vs], "k string, p double")
    asked = spark.createDataFrame([(k, q) for k in values for q in (0.0, 0.123, 0.5, 0.999, 1.0)], "k string, q double")
    for r in quantiles.quantiles_at(df, ["k"], "p", asked).collect():
        assert r.quantile == pytest.approx(np.quantile(values[r.k], r.q), abs=1e-12)


def test_thresholds_leave_out_budgets_beyond_the_windows(spark):
    df = spark.range(100).select(F.lit("s").alias("k"), (F.col("id") / 100).alias("p"))
    days = spark.createDataFrame([("s", 10.0)], "k string, days double")
    got = {r.budget: r.thr for r in alarms.thresholds(df, ["k"], [10.0, 9.0, 1.0], days).collect()}
    assert got == {b: pytest.approx(np.quantile(np.arange(100) / 100, 1 - b * 10 / 100)) for b in (9.0, 1.0)}


def test_quantiles_of_crowded_values(spark):
    """Nearly all values under a thousandth: buckets are divided until few are left to sort."""
    import numpy as np

    from waveline.operators.quantiles import quantiles_at

    rng = np.random.default_rng(8)
    sets = {"crowded": rng.random(4000) ** 2 * 1e-4, "equal": np.full(3000, 0.25), "wide": rng.normal(size=500) * 3, "two": np.array([0.1, 0.7]), "one": np.array([1.0])}
    values = spark.createDataFrame([(k, float(v)) for k, x in sets.items() for v in x] + [("crowded", None)], "k string, v double")
    qs = [0.0, 0.1, 0.5, 0.731, 0.999, 1.0]
    wanted = spark.createDataFrame([(k, q) for k in sets for q in qs] + [("nobody", 0.5)], "k string, q double")
    got = {(r.k, r.q): r.quantile for r in quantiles_at(values, ["k"], "v", wanted, sorted_at_once=20).collect()}
    assert got == {(k, q): pytest.approx(np.quantile(x, q), rel=1e-12, abs=1e-15) for k, x in sets.items() for q in qs}


def test_joint_days_have_no_constant_key(spark):
    """Pairs are formed once, under a key of month and blocks; days as by all pairs."""
    import random

    from waveline.plans.inventory import joint_days

    rng = random.Random(3)
    rows = [(f"S{k:02d}", lo := rng.randrange(400) * 43_200.0, lo + rng.randrange(1, 80) * 43_200.0) for k in range(40) for _ in range(3)]
    spans = {}
    for s, lo, hi in rows:
        spans.setdefault(s, []).append((lo, hi))
    want = {}
    for a in spans:
        for b in spans:
            days = [int((min(y, v) - max(x, u)) // 86400) for x, y in spans[a] for u, v in spans[b] if min(y, v) > max(x, u)]
            if a < b and days:
                want[a, b] = sum(days)
    out = joint_days(spark.createDataFrame(rows, "station string, lo double, hi double"))
    assert {(r.station_a, r.station_b): r.joint_days for r in out.collect()} == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "0 AS _k" not in plan and "Cartesian" not in plan


def test_median_step_is_of_all_windows(spark):
    """More windows than any first ones: the later, wider steps count, across days and inside them."""
    wide = F.when(F.col("id") < 100_001, F.col("id") * 6.0).otherwise(600_000.0 + (F.col("id") - 100_000) * 8.0)
    rows = spark.range(250_000).select(F.lit("A").alias("station"), wide.alias("t"))
    rows = rows.unionByName(spark.createDataFrame([("B", 5.0), ("C", 1.0), ("C", 1.0), ("D", 0.0), ("D", 3 * 86400.0), ("D", 3 * 86400.0 + 1)], "station string, t double"))
    assert {r.station: r.step for r in alarms.median_step(rows, ["station"]).collect()} == {"A": 8.0, "C": 0.0, "D": (3 * 86400 + 1) / 2}
    assert {r.station: r.step for r in alarms.median_step(rows, ["station"], first=100_000).collect()}["A"] == 6.0
