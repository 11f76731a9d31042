import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_sources import make_archive

from waveline import cli
from waveline.functions import names
from waveline.functions.names import Arm
from waveline.operators import alarms, arrivals, baseline, blocks, coincidence, intervals, snr, windows
from waveline.plans import adopt, inventory, run
from waveline.sources import archive, mseed, store, tables

FS, T0 = 100.0, 1714521600.0


def test_survey_and_pairs(spark):
    day = 86400.0
    ledger = spark.createDataFrame([("A", "fetched", 0.0, 100 * day, "x"), ("A", "fetched", 50 * day, 120.5 * day, "y"), ("B", "fetched", 30 * day, 200 * day, "x"), ("B", "pending", 0.0, 10 * day, "x"), ("C", "submitted", 0.0, 9 * day, "x"), ("D", "fetched", 500 * day, 700 * day, "x")], "station string, state string, lo double, hi double, source string")
    chunks = spark.createDataFrame([("A", "a1", 10), ("A", "a2", 20), ("E", "e1", 5)], "station string, chunk string, bytes long")
    rows = inventory.survey(ledger, chunks).collect()
    assert [(r.station, r.chunks, r.bytes, r.fetched_days, r.pending_days, r.sources) for r in rows] == [("A", 2, 30, 120, 0, ["x", "y"]), ("E", 1, 5, 0, 0, None), ("B", 0, 0, 170, 10, ["x"]), ("D", 0, 0, 200, 0, ["x"])]
    places = spark.createDataFrame([("A", 37.0, 30.0), ("B", 37.0, 31.0), ("D", 38.0, 30.0)], "station string, lat double, lon double")
    (pair,) = inventory.station_pairs(tables.spans_in_state(ledger, ("fetched",)), places).collect()
    assert (pair.station_a, pair.station_b, pair.joint_days) == ("A", "B", 90) and pair.separation_km == pytest.approx(88.8, abs=0.1)
    order = spark.createDataFrame([("A", 2), ("B", 1)], "station string, rank int")
    assert inventory.station_pairs(tables.spans_in_state(ledger, ("fetched",)), places, order).head().station_a == "B"
    assert inventory.usable(inventory.survey(ledger, chunks)).count() == 1


def test_work_matrix(spark):
    chunks = spark.createDataFrame([("A", "1"), ("A", "2"), ("B", "1")], "station string, chunk string")
    done = spark.createDataFrame([("A", "1", "range"), ("A", "2", "range"), ("A", "1", "scores")], "station string, chunk string, product string")
    base = spark.createDataFrame([("A",)], "station string")
    got = [tuple(r) for r in inventory.work_matrix(chunks, done, ["scores", "range"], base).select("station", "missing_scores", "missing_range", "decode", "naive", "baseline").collect()]
    assert got == [("A", 1, 0, 1, 2, True), ("B", 1, 1, 1, 2, False)]


def test_even_places():
    assert names.even_places(10, 4) == [0, 3, 6, 9] and names.even_places(2, 6) == [0, 1] and names.even_places(5, 1) == [0] and names.even_places(0, 3) == []


def test_arm():
    a = Arm.parse("6s:6.0:dir:cnn-lstm")
    assert (a.win, a.step) == (600, 600) and Arm.parse("d:6:dir:cnn:0.5").step == 50
    for bad in ("a:b", "a:1:c:d:1:2"):
        with pytest.raises(ValueError):
            Arm.parse(bad)


def test_noise_statistics(spark):
    rng = np.random.default_rng(0)
    pieces = [rng.normal(0, s, 500) for s in (1, 1.1, 0.9, 1, 1.05, 0.95, 1, 1, 1, 50)]
    df = spark.createDataFrame([("s", "Z", float(p.sum()), float((p**2).sum()), len(p)) for p in pieces] + [("one", "Z", 5.0, 5.0, 5)], "station string, role string, s double, ss double, n bigint")
    got = {r.station: r for r in baseline.noise_statistics(df).collect()}
    every = np.concatenate(pieces)
    sd = np.array([p.std() for p in pieces])
    quiet = np.concatenate([p for p, s in zip(pieces, sd) if s <= np.quantile(sd, 0.9)])
    r = got["s"]
    assert (r.mu, r.sigma, r.sigma_trimmed, r.sigma_median) == pytest.approx((every.mean(), every.std(), quiet.std(), np.median(sd))) and r.loud
    assert got["one"].sigma_trimmed == 0.0


def test_travel_times(spark):
    d, z = np.arange(0, 505, 5.0), np.array([0.0, 10.0, 50.0])
    p, s = (arrivals.first_arrivals(d, z, ph) for ph in "PS")
    assert np.isfinite(p[:, :]).all() and (np.diff(p, axis=1) >= 0).all() and (s[:, 1:] > p[:, 1:] * 1.5).all()
    assert p[0, 10] == pytest.approx(50 / 5.8, abs=0.2) and 45 < p[0, 80] < 60 and p[1, 0] == pytest.approx(10 / 5.8, abs=0.1)
    table = arrivals.straight_table(spark)
    events = spark.createDataFrame([(1, 100.0, 37.0, 30.0, None, 3.0), (2, 100.0, 37.0, 30.0, -3.0, 3.0), (3, 100.0, 47.0, 30.0, 5.0, 3.0)], "event_id long, t double, lat double, lon double, depth double, mag double")
    places = spark.createDataFrame([("A", 37.1, 30.0)], "station string, lat double, lon double")
    got = {r.event_id: r for r in arrivals.predicted_arrivals(events, places, table).collect()}
    assert sorted(got) == [1, 2] and got[1].tt_p == pytest.approx(np.hypot(10, 10) / 6) and got[2].tt_p == pytest.approx(10 / 6)


@pytest.mark.parametrize("seed", range(8))
def test_rays_against_every_crossing_point(seed):
    """A direct ray is the quickest of all broken lines; head waves go down, along a boundary and up at their angles."""
    rng = np.random.default_rng(seed)
    h1, h2 = rng.uniform(5, 30, 2)
    v1 = rng.uniform(3, 6)
    v2, v3 = v1 + rng.uniform(0.2, 1.5), 9.0
    x = np.array([0.0, 3.0, 20.0, 77.0, 200.0])
    depths = np.array([0.0, h1 * 0.5, h1, h1 + h2 * 0.7, h1 + h2 + 4])
    got = arrivals.first_arrivals(x, depths, "P", [(0.0, v1, 1.0), (h1, v2, 1.0), (h1 + h2, v3, 1.0)])
    share = np.linspace(0, 1, 1001)
    for i, z in enumerate(depths):
        up = np.array([min(z, h1), np.clip(z - h1, 0, h2), max(z - h1 - h2, 0)])
        for j, far in enumerate(x):
            a, b = (g.ravel() for g in np.meshgrid(share, share if up[2] else [1.0]))
            at = [0 * a, a * b * far, b * far, far + 0 * a] if up[2] else [0 * a, a * far if up[1] else far + 0 * a, far + 0 * a, far + 0 * a]
            ways = [sum(np.hypot(at[k + 1] - at[k], up[k]) / v for k, v in enumerate((v1, v2, v3)) if up[k]).min() if z else far / v1]
            for k, (top, v) in enumerate(((h1, v2), (h1 + h2, v3)), 1):
                if z <= top:
                    down = [2 * h - u for h, u in zip((h1, h2)[:k], up, strict=False)]
                    sines = [w / v for w in (v1, v2)[:k]]
                    along = far - sum(g * s / np.sqrt(1 - s * s) for g, s in zip(down, sines, strict=True))
                    if along >= 0:
                        ways.append(along / v + sum(g / np.sqrt(1 - s * s) / w for g, s, w in zip(down, sines, (v1, v2), strict=False)))
            assert got[i, j] == pytest.approx(min(ways), abs=2e-4), (z, far)


def test_times_of_the_public_model_are_smooth():
    """No distance is left without its own ray: apparent speeds stay within the model's."""
    for phase, slowest in (("P", 5.8), ("S", 3.36)):
        t = arrivals.first_arrivals(np.arange(0, 505, 5.0), np.array([5.0, 20.0, 35.0, 50.0, 105.0]), phase)
        steps = np.diff(t, axis=1)
        assert (steps >= 0).all() and (steps <= 5 / slowest + 1e-9).all()


def test_deep_events_have_arrivals(spark):
    """Through the table that the commands make; straight rays at the least and greatest speeds bound the times."""
    events = spark.createDataFrame([(k, 100.0, 37.0, 30.0, z, 3.0) for k, z in enumerate([150.0, 405.0, 600.0, 690.0, None, 10.0, 9000.0])], "event_id long, t double, lat double, lon double, depth double, mag double")
    places = spark.createDataFrame([("A", 38.0, 30.0), ("B", 37.0, 30.0)], "station string, lat double, lon double")
    got = {(r.event_id, r.station): r for r in arrivals.predicted_arrivals(events, places, arrivals.catalogue_table(events)).collect()}
    assert sorted(got) == [(k, s) for k in range(6) for s in "AB"]
    for k, z in enumerate([150.0, 405.0, 600.0, 690.0]):
        for s, x in (("A", 110.0), ("B", 0.0)):
            r, path = got[k, s], np.hypot(x, z)
            assert path / 10.8 < r.tt_p < path / 5.8 and path / 5.96 < r.tt_s < path / 3.36, (k, s)
        assert got[k, "A"].tt_p > got[k, "B"].tt_p
    assert got[0, "B"].tt_p == pytest.approx(20 / 5.8 + 15 / 6.5 + 115 / 8.06, abs=0.2)  # straight up through the layers
    assert got[4, "A"].tt_p == got[5, "A"].tt_p
    fixed = {(r.phase, r.di, r.zi): r.tt for r in arrivals.iasp91_table(spark, max_depth=10.0).collect()}
    assert fixed["P", 22, 2] == pytest.approx(got[5, "A"].tt_p, abs=0.05)


def segments_of(spark, n=60_000, gap_at=None):
    rng, rows = np.random.default_rng(1), []
    for role in "ZNE":
        data = rng.normal(size=n)
        data[30_000:31_000] *= 20
        parts = [(0, data)] if gap_at is None else [(0, data[:gap_at]), (gap_at + 100, data[gap_at + 100 :])]
        rows += [("S", "c", role, i, at / FS, len(d), d.tolist()) for i, (at, d) in enumerate(parts)]
    return blocks.pack(spark.createDataFrame(rows, "station string, chunk string, role string, seg_id int, t0 double, n bigint, data array<double>"))


def test_snr(spark):
    segs = segments_of(spark, gap_at=45_000).where("role = 'Z'")
    events = spark.createDataFrame([("S", "c", i, p) for i, p in enumerate((301.0, 200.0, 448.0, 30.0))], "station string, chunk string, event_id long, p_epoch double")
    got = {r.event_id: (r.snr, r.dropped) for r in snr.measure(segs, events, ["station", "chunk"], FS).collect()}
    assert got[0][0] > 5 and 0.5 < got[1][0] < 2 and got[2] == (None, True) == got[3]


def test_roll_up_and_largest(spark):
    rows = spark.createDataFrame([("S", "c2", 1, 9.0, 2), ("S", "c1", 1, 5.0, 2), ("S", "c1", 2, 1.0, 1)], "station string, chunk string, event_id long, snr double, time long")
    assert [(r.event_id, r.snr) for r in snr.roll_up(rows, ["station"], ["chunk"]).collect()] == [(2, 1.0), (1, 5.0)]
    assert {r.event_id: r.snr for r in snr.largest(rows).collect()} == {1: 9.0, 2: 1.0}
    assert snr.roll_up(rows.limit(0), ["station"], ["chunk"]).schema == rows.schema


def test_cut_every_length_or_none(spark):
    segs = segments_of(spark, gap_at=45_000)
    events = spark.createDataFrame([("S", "c", i, p, p, m) for i, (p, m) in enumerate(((301.0, 2.9), (445.0, 6.7), (435.0, 3.0), (299.0, 1.0), (541.0, 1.0)))], "station string, chunk string, event_id long, p_epoch double, cut_epoch double, mag double")
    out = windows.cut(events, segs, ["station", "chunk"], FS)
    got = out.collect()
    assert {r.event_id for r in got} == {0} and len(got) == 6
    assert {r.tag for r in got} == {"event_0_raw", "noise_event_0_raw"}
    first = next(r for r in got if r.kind == "eq" and r.length_s == 6.0)
    z = np.frombuffer(segs.where("role = 'Z' and seg_id = 0 and block = 0").head().data)
    assert first.samples[0] == np.trunc(z[29_900:30_500]).astype(int).tolist() and len(first.samples) == 3
    assert [(r.band, r.kept) for r in windows.kept_by_band(out, events, ["station", "chunk"]).collect()] == [(2.5, 1)]


def scores(spark, seed, extra=()):
    rng = np.random.default_rng(seed)
    t = np.arange(0, 3 * 86400, 60.0)
    p = rng.random(len(t)) * 0.9
    for e in extra:
        p[int(e // 60)] = 0.95
    return [(float(a), float(b)) for a, b in zip(t, p)]


def test_coincidence_of_equal_and_independent_streams(spark):
    rows = [("A", *x) for x in scores(spark, 1)] + [("B", *x) for x in scores(spark, 1)] + [("C", *x) for x in scores(spark, 2)] + [("D", 0.0, 0.1), ("D", 60.0, 0.1)]
    df = spark.createDataFrame(rows, "station string, t double, p double")
    pairs = spark.createDataFrame([("A", "B", 60.0), ("A", "C", 60.0), ("A", "D", 60.0)], "station_a string, station_b string, separation_km double")
    steps = spark.createDataFrame([(s, 60.0) for s in "ABCD"], "station string, step double")
    none = spark.createDataFrame([], "station string, event_id long, p_epoch double")
    out = coincidence.measure(df, pairs, steps, none, None, 6.0, budgets=(100.0, 1e9)).collect()
    assert {(r.station_a, r.station_b, r.budget_per_day) for r in out} == {("A", "B", 100.0), ("A", "C", 100.0)}
    same, other = sorted(out, key=lambda r: r.station_b)
    assert same.both_per_day == same.a_per_day and same.excess_over_independent > 20 and same.recall_both is None
    assert other.excess_over_independent < 5 and same.coincidence_seconds == 10.0 and same.joint_days == pytest.approx(3.0, abs=0.01)


def test_coincidence_recall_and_guard(spark):
    at = [40_000.0, 120_000.0, 200_000.0]
    rows = [("A", *x) for x in scores(spark, 1, at)] + [("B", *x) for x in scores(spark, 2, at[:2])]
    df = spark.createDataFrame(rows, "station string, t double, p double")
    pairs = spark.createDataFrame([("A", "B", 60.0)], "station_a string, station_b string, separation_km double")
    steps = spark.createDataFrame([("A", 60.0), ("B", 60.0)], "station string, step double")
    known = spark.createDataFrame([(s, i, t) for s in "AB" for i, t in enumerate(at)], "station string, event_id long, p_epoch double")
    strong = spark.createDataFrame([(s, i, 5.0) for s in "AB" for i in range(3)] + [("A", 9, 9.0)], "station string, event_id long, snr double")
    (r,) = coincidence.measure(df, pairs, steps, known, strong, 60.0, budgets=(0.5,), signal_post=60.0).collect()
    assert r.recall_both == pytest.approx(2 / 3) and r.thr_a < 0.9
    weak = strong.where("not (station = 'B' and event_id = 2)")
    (r,) = coincidence.measure(df, pairs, steps, known, weak, 60.0, budgets=(0.5,), signal_post=60.0).collect()
    assert r.recall_both == 1.0


def stub(block):
    return np.minimum(np.abs(block).mean(axis=(1, 2)) / 2, 1)


def big_archive(root):
    import zipfile

    rng = np.random.default_rng(3)
    for s in ("AAA", "BBB"):
        (root / s).mkdir(parents=True)
        for i, d in enumerate(("2024-05-01", "2024-05-22")):
            base = T0 + i * 21 * 86400
            tr = [mseed.Trace(s, f"HH{c}", base, FS, rng.normal(size=90_000) * 100) for c in "ZNE"[: 3 if (s, i) != ("BBB", 1) else 2]]
            with zipfile.ZipFile(root / s / f"{s}_{d}.zip", "w") as z:
                z.writestr("x.mseed", mseed.write_traces(tr))
    return root


def test_run_resumes(spark, tmp_path):
    chunks = archive.find_chunks(archive.list_files(spark, str(big_archive(tmp_path / "a"))))
    layout = store.Layout(str(tmp_path / "out"))
    places = spark.createDataFrame([("AAA", 37.0, 30.0), ("BBB", 37.2, 30.0)], "station string, lat double, lon double")
    events = spark.createDataFrame([(i, T0 + t, 37.0, 30.1, 10.0, 3.0, "x") for i, t in enumerate((400.0, 500.0, 880.0))], "event_id long, t double, lat double, lon double, depth double, mag double, location string").withColumn("time", F.timestamp_seconds("t"))
    arm = Arm("6s", 6.0, "", "", 6.0)
    settings = run.Settings(snr_min=0.0, lengths=(6.0, 10.0), scorers={"6s": stub})
    run.build_baseline(spark, chunks, layout, settings)
    assert spark.read.parquet(layout.baseline).count() == 6
    travel = arrivals.straight_table(spark)
    first = run.run(spark, chunks, layout, places, events, travel, [arm], settings)
    made = {(r.station, r.chunk[-5:], r.product): r.outputs for r in first.collect()}
    assert made["AAA", "05-01", "scores:6s"] == 150 and made["AAA", "05-01", "range"] == 3 and made["AAA", "05-22", "range"] == 0
    assert made["BBB", "05-22", "scores:6s"] == 0 and not any(p.startswith("windows") for *_, p in made)
    second = run.run(spark, chunks, layout, places, events, travel, [arm], settings)
    made = {(r.station, r.chunk[-5:], r.product): r.outputs for r in second.collect()}
    assert {p for *_, p in made} == {"windows:6", "windows:10"} and made["AAA", "05-01", "windows:6"] == 4
    assert run.run(spark, chunks, layout, places, events, travel, [arm], settings).count() == 0
    assert run.snr_table(spark, layout).count() == 6
    pairs = inventory.separations(places)
    assert run.measure_pairs(spark, layout, chunks, pairs, places, events, travel, arm).count() == 0  # BBB is half scored
    assert run.measure_pairs(spark, layout, chunks, pairs, places, events, travel, arm, allow_partial=True).count() == 0  # under a day


class Stop(Exception):
    pass


def tables_of(spark, layout):
    out = {}
    for name in ("scores", "snr_parts", "windows"):
        df = store.read_table(spark, getattr(layout, name), {"scores": "station string, arm string, chunk string, t double, p float", "snr_parts": run.SNR_PARTS, "windows": "station string, chunk string, length_s double, tag string, t0 double, samples array<array<int>>"}[name])
        out[name] = sorted(str(r) for r in df.collect())
    out["completed"] = sorted(str(r) for r in store.completed(spark, layout).collect())
    return out


def test_run_resumes_wherever_it_stops(spark, tmp_path, monkeypatch):
    """Stopped right after each single write, then run again: the tables are those of a run in one go."""
    chunks = archive.find_chunks(archive.list_files(spark, str(big_archive(tmp_path / "a"))))
    places = spark.createDataFrame([("AAA", 37.0, 30.0), ("BBB", 37.2, 30.0)], "station string, lat double, lon double")
    events = spark.createDataFrame([(i, T0 + t, 37.0, 30.1, 10.0, 3.0, "x") for i, t in enumerate((400.0, 500.0, 880.0))], "event_id long, t double, lat double, lon double, depth double, mag double, location string").withColumn("time", F.timestamp_seconds("t"))
    arm, travel = Arm("6s", 6.0, "", "", 6.0), arrivals.straight_table(spark)
    settings = run.Settings(snr_min=0.0, lengths=(6.0,), scorers={"6s": stub}, standardize="perwindow", group_chunks=2)
    go = lambda layout: run.run(spark, chunks, layout, places, events, travel, [arm], settings)
    whole = store.Layout(str(tmp_path / "whole"))
    while go(whole).count():
        pass
    want = tables_of(spark, whole)
    assert len(want["scores"]) == 450 and len(want["windows"]) == 8 and len(want["snr_parts"]) == 6
    for stop_at in ("write_scores", "write_snr_parts", "write_windows", "mark_completed"):
        layout = store.Layout(str(tmp_path / f"{stop_at}"))
        left, real = [2], getattr(store, stop_at)

        def write(df, to, real=real, left=left):
            real(df, to)
            left[0] -= 1
            if left[0] >= 0:
                raise Stop

        monkeypatch.setattr(store, stop_at, write)
        for _ in range(12):
            try:
                if not go(layout).count():
                    break
            except Stop:
                pass
        monkeypatch.setattr(store, stop_at, real)
        assert left[0] < 0 and tables_of(spark, layout) == want, stop_at


def generates_below(df, column):
    """Whether any Generate of the plan has the column among what it carries."""
    plan = df._jdf.queryExecution().optimizedPlan()

    def walk(node):
        if node.nodeName() == "Generate" and f"{column}#" in "".join(str(node.child().output().apply(i)) for i in range(node.child().output().size())):
            return True
        return any(walk(node.children().apply(i)) for i in range(node.children().size()))

    return walk(plan)


def test_samples_are_never_copied_by_hours(spark):
    segs = segments_of(spark, gap_at=45_000)
    events = spark.createDataFrame([("S", "c", 1, 301.0, 301.0, 3.0)], "station string, chunk string, event_id long, p_epoch double, cut_epoch double, mag double")
    for df in (windows.cut(events, segs, ["station", "chunk"], FS), snr.measure(segs.where("role = 'Z'"), events, ["station", "chunk"], FS, band=None)):
        assert not generates_below(df, "data")
        assert "BroadcastNestedLoop" not in df._jdf.queryExecution().executedPlan().toString()


def test_separations_have_no_nested_loop(spark):
    rng = np.random.default_rng(4)
    places = [(f"S{i:02d}", float(36 + 3 * rng.random()), float(28 + 4 * rng.random())) for i in range(30)]
    df = spark.createDataFrame(places, "station string, lat double, lon double")
    every, near = inventory.separations(df), inventory.separations(df, 80.0)
    for plan in (every, near):
        assert "NestedLoop" not in plan._jdf.queryExecution().executedPlan().toString()
    whole = {(r.station_a, r.station_b): r.separation_km for r in every.collect()}
    assert len(whole) == 30 * 29 // 2
    assert {(r.station_a, r.station_b): r.separation_km for r in near.collect()} == {k: v for k, v in whole.items() if v <= 80.0}


def test_windows_are_in_as_many_folders_as_lengths_and_chunks(spark, tmp_path):
    """Stations don't make folders or files; a station's windows are replaced, and what others have in the same folder stays."""
    def made(stations, mark, lengths=(6.0, 10.0), chunk="c"):
        rows = [(s, chunk, k, x, "eq", f"event_{k}_raw", 0.0, [[mark]] * 3) for s in stations for x in lengths for k in (1, 2)]
        return spark.createDataFrame(rows, "station string, chunk string, event_id long, length_s double, kind string, tag string, t0 double, samples array<array<int>>")

    def there(layout):
        found = spark.read.parquet(layout.windows).collect()
        marks = {(r.station, r.length_s, r.chunk): r.samples[0][0] for r in found}
        assert len(found) == 2 * len(marks)
        return marks

    layout, many = store.Layout(str(tmp_path / "out")), [f"S{k}" for k in range(50)]
    store.write_windows(made(many, 1), layout)
    folders = sorted(str(p.relative_to(layout.windows)) for p in tmp_path.glob("out/windows/*/*") if p.is_dir())
    assert folders == ["length_s=10.0/chunk=c", "length_s=6.0/chunk=c"]
    assert len(list(tmp_path.glob("out/windows/**/*.parquet"))) <= 8
    want = {(s, x, "c"): 1 for s in many for x in (6.0, 10.0)}
    store.write_windows(made(["S1", "T"], 2, (6.0,)), layout)  # one is there, one is new
    store.write_windows(made(["T"], 3, (6.0,), "d"), layout)
    want |= {("S1", 6.0, "c"): 2, ("T", 6.0, "c"): 2, ("T", 6.0, "d"): 3}
    assert there(layout) == want
    before = {p.name for p in tmp_path.glob("out/windows/**/*.parquet")}
    store.write_windows(made(["U"], 4), layout)  # nothing is replaced: files are only added
    assert there(layout) == want | {("U", 6.0, "c"): 4, ("U", 10.0, "c"): 4}
    assert before < {p.name for p in tmp_path.glob("out/windows/**/*.parquet")}
    old = store.Layout(str(tmp_path / "old"))
    made(["S1"], 1).write.partitionBy("station", "length_s", "chunk").parquet(old.windows)
    with pytest.raises(ValueError, match="partitioned by station"):
        store.write_windows(made(["S1"], 2), old)


def test_exported_windows_are_files_that_read_back(spark, tmp_path):
    segs = segments_of(spark)
    events = spark.createDataFrame([("S", "c", 7, 301.0, 301.0, 2.9)], "station string, chunk string, event_id long, p_epoch double, cut_epoch double, mag double")
    cut = windows.cut(events, segs, ["station", "chunk"], FS, lengths=(6.0,))
    paths = sorted(r.path for r in store.export_windows(cut, str(tmp_path), FS).collect())
    assert [p.removeprefix(f"{tmp_path}/") for p in paths] == ["6s/S/eq/event_7_raw.mseed", "6s/S/noise/noise_event_7_raw.mseed"]
    back = mseed.read_traces(open(paths[0], "rb").read())
    assert [(t.channel, t.t0, len(t.data)) for t in back] == [(c, 299.0, 600) for c in ("HHZ", "HHN", "HHE")]
    assert [t.data.astype(int).tolist() for t in back] == next(r.samples for r in cut.collect() if r.kind == "eq")


def test_adopted_files_become_rows(spark, tmp_path):
    src, out = tmp_path / "old", tmp_path / "out"
    layout = store.Layout(str(out))
    for folder in ("scores_aaa/6s", "scores_dense/6s", "raw/continuous_windows/6s/AAA/eq", "runs_coinc"):
        (src / folder).mkdir(parents=True)
    (src / "aaa_baseline.json").write_text(json.dumps({"Z": {"mu": 1.0, "sigma": 2.0, "sigma_trimmed": 1.5, "sigma_median": 1.4, "n_samples": 10, "n_pieces": 2}, "_conditioning": {"freqmin": 1.0, "freqmax": 45.0}}))
    head = "event_id,time,mag,dist_km,depth,snr,location\n"
    (src / "aaa_range_full.csv").write_text(head + "1,2024-05-01 00:00:05,3.5,10.0,,8.25,x\n2,2024-05-02 00:00:05,3.0,11.0,5.0,nan,y\n")
    (src / "aaa_range.csv").write_text(head + "1,2024-05-01 00:00:05,3.5,10.0,,7.0,x\n")
    for folder, n in (("scores_aaa", 5), ("scores_dense", 9)):
        np.savez_compressed(src / folder / "6s" / "c1.npz", t=np.arange(n, dtype=float), p=np.linspace(0, 1, n).astype(np.float32))
    (src / "raw/continuous_windows/6s/AAA/eq/event_12_raw.mseed").write_bytes(mseed.write_traces([mseed.Trace("AAA", f"HH{c}", 50.0, FS, np.arange(600)) for c in "ZNE"]))
    (src / "runs_coinc/bbb_aaa_6s_coincidence.csv").write_text("budget_per_day,separation_km,joint_days,coincidence_seconds,station_a,station_b,thr_a,thr_b,a_per_day,b_per_day,both_per_day,independent_per_day,excess_over_independent,recall_both\n10.0,88.0,70.0,14.0,BBB,AAA,0.9,0.8,10.0,9.0,1.0,0.1,10.0,\n")
    (src / "runs_coinc/notes.csv").write_text("x")
    loose, order = tmp_path / "loose", list(adopt.KINDS)
    (loose / "deep").mkdir(parents=True)
    (loose / "deep" / "ccc_baseline.json").write_text("{}")
    (loose / "aaa_baseline.json").write_text(json.dumps({"Z": {"mu": 9.0}}))  # the first folder's counts
    found = adopt.find(spark, str(src), (str(loose), str(tmp_path / "missing")), {"dense": ("AAA", "dense.")})
    assert [(f.kind, f.station, f.arm) for f in sorted(found.where("at = 0").collect(), key=lambda f: (order.index(f.kind), f.path))] == [("baseline", "AAA", None), ("snr", "AAA", None), ("snr_partial", "AAA", None), ("scores", "AAA", "6s"), ("scores", "AAA", "dense.6s"), ("windows", "AAA", None), ("pairs", None, "6s")]
    assert [(f.kind, f.station) for f in found.where("at = 1").collect()] == [("baseline", "AAA")]
    assert {f.station for f in adopt.find(spark, str(src)).where("arm = 'dense.6s'").collect()} == {"MANT"}
    assert adopt.find(spark, str(tmp_path / "missing")).count() == 0
    assert adopt.convert(spark, found, layout) == {"baseline": 1, "snr": 2, "snr_partial": 1, "scores": 14, "windows": 1, "pairs": 1}
    assert [(r.sigma_trimmed, r.freqmin, r.trim) for r in spark.read.parquet(layout.baseline).collect()] == [(1.5, 1.0, None)]
    assert {r.event_id: r.snr for r in run.snr_table(spark, layout).collect()} == {1: 8.25, 2: None}
    assert [r.t for r in tables.read_scores(spark, layout.scores, "AAA", "6s").collect()] == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert {(r.product, r.outputs) for r in store.completed(spark, layout).collect()} == {("scores:6s", 5), ("scores:dense.6s", 9)}
    (w,) = spark.read.parquet(layout.windows).collect()
    assert (w.event_id, w.kind, w.length_s, w.t0, w.samples[2][:3]) == (12, "eq", 6.0, 50.0, [0, 1, 2])
    assert [(r.pair, r.station_a, r.recall_both) for r in spark.read.parquet(layout.pairs).collect()] == [("AAA-BBB", "BBB", None)]
    assert set(adopt.convert(spark, found, layout).values()) == {0} and len(tables_of(spark, layout)["scores"]) == 14


def test_many_files_are_adopted_in_one_plan(spark, tmp_path):
    """Two hundred stations' readings and pairs: a plan whose size doesn't follow the number of files."""
    src = tmp_path / "many files"  # a blank in a path is no harm
    (src / "runs_coinc").mkdir(parents=True)
    for k in range(200):
        head = "event_id,snr,time,location\n" if k % 2 else "\ufefflocation, Event_ID ,time,snr,extra\n"
        line = f'{k},1.5,2024-05-01 00:00:05,"a, ""b"""\n' if k % 2 else f'"a, ""b""",{k},2024-05-01 00:00:05,1.5,x\n'
        (src / f"s{k}_range_full.csv").write_text(head + line + "\n")
        (src / f"s{k}_baseline.json").write_text(json.dumps({"Z": {"mu": float(k), "sigma": float("nan"), "n_samples": 10}}))
    for a, b in (("aaa", "bbb"), ("bbb", "aaa"), ("ccc", "aaa")):
        (src / f"runs_coinc/{a}_{b}_6s_coincidence.csv").write_text(f"budget_per_day,recall_both\n10.0,0.5\n{len(a)},\n")
    (src / "empty_range_full.csv").write_text("")
    layout = store.Layout(str(tmp_path / "out"))
    found = adopt.find(spark, str(src))
    assert adopt.convert(spark, found, layout) == {"baseline": 200, "snr": 200, "pairs": 4}
    rows = spark.read.parquet(layout.snr_parts).collect()
    assert {(r.station, r.event_id, r.snr, r.location, r.mag) for r in rows} == {(f"S{k}", k, 1.5, 'a, "b"', None) for k in range(200)}
    assert {(r.station, r.mu, r.n_samples, r.freqmin) for r in spark.read.parquet(layout.baseline).collect()} == {(f"S{k}", float(k), 10, None) for k in range(200)}
    pairs = {(r.pair, r.station_a, r.budget_per_day, r.recall_both) for r in spark.read.parquet(layout.pairs).collect()}
    assert pairs == {(p, a, b, r) for p, a in (("AAA-BBB", "AAA"), ("AAA-CCC", "CCC")) for b, r in ((10.0, 0.5), (3.0, None))}
    assert set(adopt.convert(spark, found, layout).values()) == {0}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("binaryFile") <= 2, plan


def test_coincidence_command(spark, capsys, tmp_path):
    """From files to a table: what is measured equals the operator on the same scores, and what isn't is said."""
    archived, layout = tmp_path / "a", store.Layout(str(tmp_path / "out"))
    for s, n in (("AAA", 1), ("BBB", 1), ("CCC", 1), ("DDD", 2), ("EEE", 1)):
        (archived / s).mkdir(parents=True)
        for k in range(n):
            (archived / s / f"{s}_2024-05-0{k + 1}.zip").write_bytes(b"PK")
    (tmp_path / "s.csv").write_text("Code,Latitude,Longitude\n" + "".join(f"{s},37.{k},30\n" for k, s in enumerate(("AAA", "BBB", "CCC", "DDD", "EEE"))))
    (tmp_path / "c.csv").write_text("EventID,Date,Latitude,Longitude,Depth,Magnitude,Location\n7,01/05/2024 06:00:00,37.0,30.1,10,3.5,x\n")
    base = F.lit(1714521600.0) + F.col("id") * 6
    scores = spark.range(3 * 14400).select(base.alias("t"), (F.pmod(F.xxhash64("id"), F.lit(10007)) / 10007.0).cast("float").alias("p"))
    some = scores.limit(100)
    rows = [x.select(F.lit(s).alias("station"), F.lit("6s").alias("arm"), F.lit(f"{s}_2024-05-01").alias("chunk"), "t", "p") for s, x in (("AAA", scores), ("BBB", scores), ("DDD", scores), ("EEE", some))]
    for r in rows:
        store.write_scores(r, layout)
    asked = [x for other in ("AAA", "CCC", "DDD", "EEE") for x in ("--pair", "BBB", other)]
    call = ["coincidence", "--archive", str(archived), "--stations", str(tmp_path / "s.csv"), "--catalog", str(tmp_path / "c.csv"), "--out", layout.root, *asked]
    assert cli.main(call) == 0
    said = capsys.readouterr().out
    assert "CCC has no 6s scores" in said and "DDD is scored in 1 of 2 chunks" in said and "too short" in said and "1 of 4 pairs measured, 1 wait" in said
    got = spark.read.parquet(layout.pairs)
    assert {(r.pair, r.arm) for r in got.select("pair", "arm").distinct().collect()} == {("AAA-BBB", "6s")}
    both = spark.read.parquet(layout.scores).where("station in ('AAA', 'BBB')").select("station", "chunk", "t", "p")
    places, events = tables.read_stations(spark, str(tmp_path / "s.csv")), tables.read_events(spark, str(tmp_path / "c.csv"))
    pairs = inventory.separations(places).where("station_a = 'AAA' and station_b = 'BBB'").selectExpr("'BBB' as station_a", "'AAA' as station_b", "separation_km")
    known = arrivals.predicted_arrivals(events, places, arrivals.catalogue_table(events))
    want = coincidence.measure(both, pairs, alarms.median_step(both, ["station"]), known, None, 6.0)
    plain = lambda df: sorted(str([getattr(r, c) for c in want.columns]) for r in df.collect())
    assert plain(got) == plain(want) and got.count() > 0
    assert cli.main(call) == 0 and "measured before" in capsys.readouterr().out
    assert cli.main([*call[:9], "--pair", "AAA", "ZZZ"]) == 1 and "no pair" in capsys.readouterr().err


def test_command_line(capsys, tmp_path):
    assert cli.main([]) == 0 and "inventory" in capsys.readouterr().out
    assert cli.main(["cov"]) == 2 and cli.main(["co"]) == 2
    assert "coincidence" in capsys.readouterr().err
    with pytest.raises(NotImplementedError):
        cli.main(["encode"])
    a = cli.parser().parse_args(["run", "--station", "A", "--station", "B", "--constant-sigma", "7", "--near", "1:2"])
    assert a.station == ["A", "B"] and a.constant_sigma == 7.0 and a.near == ["1:2"] and a.command == "run"
    with pytest.raises(ValueError, match="archive"):
        cli.main(["plan", "--all"])


def test_baseline_command_passes_its_flags_on(spark, capsys, tmp_path):
    root = big_archive(tmp_path / "a")
    assert cli.main(["baseline", "--archive", str(root), "--out", str(tmp_path / "out"), "--station", "AAA", "--piece-seconds", "300", "--sample-chunks", "1"]) == 0
    rows = spark.read.parquet(str(tmp_path / "out" / "baseline")).collect()
    assert {(r.role, r.n_pieces, r.piece_seconds) for r in rows} == {(c, 3, 300.0) for c in "ZNE"}
    assert cli.main(["plan", "--archive", str(root), "--out", str(tmp_path / "out"), "--all"]) == 0
    assert "missing_scores:6s" in capsys.readouterr().out
    assert cli.main(["plan", "--archive", str(root), "--out", str(tmp_path / "out")]) == 1


def test_inventory_command(spark, capsys, tmp_path):
    root = make_archive(tmp_path / "a")
    (tmp_path / "s.csv").write_text("Code,Latitude,Longitude\nAAA,37,30\nBBB,37,31\n")
    (tmp_path / "l.jsonl").write_text("".join('{"station": "%s", "state": "fetched", "start": "2024-01-01", "end": "2024-06-01"}\n' % s for s in ("AAA", "BBB")))
    assert cli.main(["inventory", "--archive", str(root), "--stations", str(tmp_path / "s.csv"), "--ledger", str(tmp_path / "l.jsonl")]) == 0
    out = capsys.readouterr().out
    assert "duplicate delivery" in out and "|152" in out.replace(" ", "")


def test_coverage_keeps_steps_as_they_are(spark):
    """A gap of just under two and a half steps doesn't break a coverage, whatever the step's seventh digit."""
    step = 6.0000004
    rows = [(s, t) for s in "AB" for t in (0.0, 6.0, 12.0, 27.0000005, 86400.0, 86406.0)]
    df = spark.createDataFrame(rows, "station string, t double")
    pairs = spark.createDataFrame([("A", "B")], "station_a string, station_b string")
    steps = spark.createDataFrame([("A", step), ("B", 6.0)], "station string, step double")
    got = sorted((r.lo, r.hi) for r in coincidence.joint_spans(df, pairs, steps).collect())
    assert got == [(0.0, 27.0000005 + step), (86400.0, 86406.0 + step)]


def test_rolled_up_parts_are_dealt_by_their_number(spark):
    from waveline.durable import spread

    rows = spark.range(4000).selectExpr("id % 1000 as event_id")
    assert spread(rows, "event_id", rows=100).rdd.getNumPartitions() == 40
    assert spread(rows, "event_id", rows=4000) is rows


def test_the_highest_scores_near_events_without_meeting_all_of_them(spark):
    """Dense scores and events: each score is a row of its bucket once, whatever the number of events near it."""
    rng = random.Random(3)
    pair = ["A", "B"]
    rows = [(*pair, side, float(rng.randrange(4000)), rng.random()) for side in "ab" for _ in range(1500)]
    asked = [(*pair, side, k, float(rng.randrange(-400, 4400)) + rng.choice([0.0, 0.5])) for side in "ab" for k in range(300)]
    scores = spark.createDataFrame(rows, "station_a string, station_b string, side string, t double, p double")
    events = spark.createDataFrame(asked, "station_a string, station_b string, side string, event_id int, p_epoch double")
    for before, after in ((300.0, 600.0), (6.0, 20.0), (0.0, 1.0)):
        out = coincidence.highest_near(scores, events, before, after)
        assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
        got = {(r.side, r.event_id): r.best for r in out.collect()}
        want = {(side, k): max((p for *_, s, t, p in rows if s == side and e - before <= t <= e + after), default=None) for *_, side, k, e in asked}
        assert got == want


def test_buckets_follow_the_length_of_dense_intervals(spark):
    rows = [(float(k), k + 0.5) for k in range(86_400)]
    dense = spark.createDataFrame(rows, "lo double, hi double")
    assert intervals.fitted_bucket(dense) == pytest.approx(1.0)
    assert intervals.fitted_bucket(dense.limit(0)) == intervals.DAY == intervals.fitted_bucket(spark.createDataFrame([(0.0, 1e7)], "lo double, hi double"))
    key = dense.withColumn("k", F.lit(1))
    met = intervals.intersect(key, key.withColumns({"lo": F.col("lo") + 0.25, "hi": F.col("hi") + 0.25}), ["k"], intervals.fitted_bucket(dense))
    assert met.agg(F.count("*"), F.min(F.col("hi") - F.col("lo")), F.max(F.col("hi") - F.col("lo"))).head()[:] == (86_400, 0.25, 0.25)


def _noise_and_signal(spark, events):
    """Segments of a sample a second in short blocks, in part overlapping, and what signal over noise is of them."""
    rng, rows = np.random.default_rng(3), []
    for s in "AB":
        at = 0
        for k in range(40):
            n = int(rng.integers(5, 400))
            rows.append((s, k, float(at), n, rng.integers(0, 1000, n).astype(float).tolist()))
            at += int(rng.integers(1, 2 * n))
    segs = spark.createDataFrame(rows, "station string, seg_id int, t0 double, n long, data array<double>")

    def part(s, start, want):
        for station, _, t0, n, data in rows:
            at = round(start - t0)
            if station == s and at >= 0 and at + want <= n:
                return float(np.sqrt(np.mean(np.square(data[at : at + want]))))
        return None

    want = {}
    for s, i, p in events:
        for name, lo, n in (("noise", -60.0, 50), ("signal", -1.0, 13)):
            v = p is not None and part(s, p + lo, n)
            have = want.setdefault((s, i), {})
            have[name] = max(have.get(name) or 0.0, v or 0.0)
    return segs, {k: v["signal"] / v["noise"] if v["noise"] and v["signal"] else None for k, v in want.items()}


@pytest.mark.parametrize("size", [16, 64, 1 << 17])
def test_snr_is_that_of_every_range(spark, monkeypatch, size):
    """Parts in one bucket or in two, over blocks, of events with several times or none; stored samples and derived ones."""
    monkeypatch.setattr(blocks, "BLOCK", size)
    rng = np.random.default_rng(4)
    events = [(s, int(i), float(rng.integers(0, 16_000) / 2)) for s in "ABC" for i in range(400)] + [("A", 1, 700.0), ("A", 1, 900.0), ("B", 7, None)]
    segs, want = _noise_and_signal(spark, events)
    asked = spark.createDataFrame(events, "station string, event_id long, p_epoch double")
    packed = blocks.pack(segs)
    numbers = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / size).cast("int"))).alias("block")
    heads = segs.select("station", "seg_id", "t0", "n", numbers, F.col("data").alias("made_of"))
    of_block = F.pandas_udf(lambda x, k: x.combine(k, lambda v, b: np.asarray(v, np.float64)[b * size : (b + 1) * size].tobytes()), "binary")("made_of", "block")
    assert 100 < sum(v is not None for v in want.values()) < len(want) - 100
    for got in (snr.measure(packed, asked, ["station"], 1.0, None), snr.measure(heads, asked, ["station"], 1.0, None, derived=of_block)):
        rows = got.collect()
        assert len(rows) == len(events) and all(r.dropped == (r.snr is None) for r in rows)
        for r in rows:
            v = want[r.station, r.event_id]
            assert r.snr == (v if v is None else pytest.approx(v, rel=1e-12)), r


def test_snr_reads_samples_of_events_with_both_parts_only(spark):
    """An event whose noise no segment holds is dropped on headers: no samples of its signal are made."""
    heads = spark.createDataFrame([("S", 0, 0.0, 200, 0), ("S", 1, 1000.0, 20, 0)], "station string, seg_id int, t0 double, n long, block int")
    events = spark.createDataFrame([("S", 1, 100.0), ("S", 2, 1001.0)], "station string, event_id long, p_epoch double")
    made = F.when(F.col("n") == 20, F.raise_error(F.lit("samples that aren't asked for")).cast("binary")).otherwise(F.unhex(F.repeat(F.lit("000000000000F03F"), 200)))
    got = snr.measure(heads, events, ["station"], 1.0, None, derived=made)
    assert {r.event_id: (r.snr, r.dropped) for r in got.collect()} == {1: (1.0, False), 2: (None, True)}
