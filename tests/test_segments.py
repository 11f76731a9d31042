import numpy as np
import pytest
from pyspark.sql import functions as F

from waveline.operators import blocks, segments

FS = 100.0
T0 = 1714521600.0


def trace(start, n, channel="HNZ", value=None, fs=FS):
    data = np.full(n, float(value)) if value is not None else np.random.default_rng(int(start * 10) + n).normal(size=n)
    return ("TEST", "c", channel, T0 + start, fs, data.tolist())


@pytest.fixture(autouse=True, params=[1 << 17, 700], ids=["one block", "blocks of 700"])
def block_size(request, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK", request.param)


def packed(spark, traces):
    rows = [(*t[:3], seq, *t[3:]) for seq, t in enumerate(traces)]
    return segments.pack_traces(spark.createDataFrame(rows, "station string, chunk string, channel string, seq int, t0 double, fs double, data array<double>"))


def whole(segs):
    """Each segment's start and samples, from its blocks in order."""
    out = {}
    for r in segs.orderBy("channel", "t0", "block").collect():
        assert len(r.data) <= 8 * blocks.BLOCK and r.total == pytest.approx(np.frombuffer(r.data).sum(), rel=1e-9, abs=1e-9)
        out.setdefault((r.channel, r.t0, r.n), []).append(np.frombuffer(r.data))
    assert all(sum(map(len, parts)) == n for (_, _, n), parts in out.items())
    return [(c, t0 - T0, np.concatenate(parts)) for (c, t0, _), parts in out.items()]


def joined(spark, traces, channel="HNZ"):
    return [x[1:] for x in whole(segments.join_traces(segments.select_traces(packed(spark, traces), channel), FS))]


def merged(traces):
    """Sample by sample: traces in start order; one that reaches further overwrites, a contained one is left out."""
    out = []
    for t in sorted(traces, key=lambda t: t[3]):  # stable: of equal starts in the order given
        start, data = t[3] - T0, np.array(t[5])
        if out and start <= out[-1][0] + len(out[-1][1]) / FS + 0.5 / FS:
            s0, have = out[-1]
            lo = round((start - s0) * FS)
            if lo + len(data) > len(have):
                new = np.empty(lo + len(data))
                new[: len(have)] = have
                new[lo:] = data
                out[-1] = (s0, new)
        else:
            out.append((start, data))
    return out


def same(got, want):
    assert len(got) == len(want)
    for (a, x), (b, y) in zip(got, want):
        assert a == pytest.approx(b, abs=1e-6) and np.array_equal(x, y)


CASES = {
    "single": [trace(0, 1000)],
    "contiguous": [trace(0, 1000), trace(10, 1000)],
    "gap": [trace(0, 1000), trace(30, 1000)],
    "out of order": [trace(30, 1000), trace(0, 1000), trace(10, 1000)],
    "duplicate": [trace(0, 1000, value=1), trace(0, 1000, value=1)],
    "trailing overlap": [trace(0, 1000, value=1), trace(5, 1000, value=2)],
    "contained": [trace(0, 2000, value=1), trace(5, 500, value=2)],
    "equal starts": [trace(0, 1000, value=1), trace(0, 1000, value=2)],
    "equal starts, turned": [trace(0, 1000, value=2), trace(0, 1000, value=1)],
    "equal starts, the second longer": [trace(0, 1000, value=1), trace(0, 1500, value=2), trace(0, 1200, value=3)],
    "equal starts, the first longest": [trace(0, 1500, value=1), trace(0, 1000, value=2)],
    "nested no gap": [trace(0, 2000, value=1), trace(1, 100, value=2), trace(20, 500, value=3)],
}


@pytest.mark.parametrize("name", CASES)
def test_cases(spark, name):
    same(joined(spark, CASES[name]), merged(CASES[name]))


def test_order_is_the_files_not_the_rows(spark):
    """However the rows come, the traces' numbers decide between equal starts."""
    traces = [trace(0, 1000, value=k) for k in (3, 1, 2)]
    for k in range(3):
        rows = packed(spark, traces).orderBy(F.pmod(F.col("seq") + k, F.lit(3)))
        ((_, _, data),) = whole(segments.join_traces(rows, FS))
        assert set(data) == {3.0}


def test_overlap_values(spark):
    ((_, data),) = joined(spark, CASES["trailing overlap"])
    assert len(data) == 1500 and data[499] == 1 and data[500] == 2
    ((_, data),) = joined(spark, CASES["contained"])
    assert len(data) == 2000 and (data == 1).all()


def test_many_fragments(spark):
    rng, at, out = np.random.default_rng(0), 0.0, []
    for _ in range(100):
        n = int(rng.integers(200, 2000))
        out.append(trace(at, n))
        at = round(at + n / FS + (float(rng.integers(1, 50)) if rng.random() < 0.3 else 0), 2)
    rng.shuffle(out)
    same(joined(spark, out), merged(out))


def test_roles_and_bands(spark):
    pick = lambda *codes: [tuple(r) for r in segments.pick_channels(packed(spark, [trace(0, 10, c) for c in codes])).select("z", "n", "e").collect()]
    assert pick("HNN", "HNE") == []
    assert pick("HNZ", "HN1", "HN2") == [("HNZ", "HN1", "HN2")]
    assert pick("hhz", "HHN", "HHE", "HNZ", "HNN", "HNE") == [("HHZ", "HHN", "HHE")]
    assert pick("HHN", "HHE", "HNZ", "HNN", "HNE") == [("HNZ", "HNN", "HNE")]
    assert pick("HHZ", "HNN", "BHE") == []
    assert pick("XXZ", "XXN", "XXE", "AAZ", "AAN", "AAE") == [("AAZ", "AAN", "AAE")]


def test_two_instruments_are_not_merged(spark):
    rows = [trace(0, 1000, f"{b}{r}", v) for b, v in (("HH", 1), ("HN", 99)) for r in "ZNE"]
    traces = packed(spark, rows)
    chosen = whole(segments.join_traces(traces, FS, segments.pick_channels(traces)))
    assert {c for c, _, _ in chosen} == {"HHZ", "HHN", "HHE"} and all(set(data) == {1.0} for *_, data in chosen)
    both = [trace(0, 1000, "HHZ", 1), trace(10, 1000, "HNZ", 99)]
    bare = segments.select_traces(packed(spark, both), "Z").withColumn("channel", F.lit("Z"))
    ((_, _, data),) = whole(segments.join_traces(bare, FS))
    assert set(data) == {1.0, 99.0}


def test_other_rate_is_resampled(spark):
    t = np.arange(500) / 50
    row = ("TEST", "c", "HNZ", T0, 50.0, np.sin(2 * np.pi * t).tolist())
    ((_, data),) = joined(spark, [row])
    assert len(data) == 1000 and np.abs(data - np.sin(2 * np.pi * np.arange(1000) / 100)).max() < 0.05


def test_a_trace_too_short_for_the_rate_is_none(spark):
    rows = [("TEST", "c", "HNZ", T0, 200.0, [1.0]), ("TEST", "c", "HNZ", T0 + 5, 200.0, [1.0] * 8)]
    ((start, data),) = joined(spark, rows)
    assert start == 5.0 and data == pytest.approx(np.ones(4))


def segments_of(spark, *rows):
    df = spark.createDataFrame([(*r[:3], len(r[3]), r[3]) for r in rows], "station string, seg_id int, t0 double, n bigint, data array<double>")
    return blocks.pack(df)


def test_containing_refuses_partial_windows(spark):
    segs = segments_of(spark, ("s", 0, 0.0, list(map(float, range(1000)))), ("s", 1, 10.5, [1.0] * 1000))
    asked = spark.createDataFrame([("s", i, t) for i, t in enumerate([0.0, 9.0, 9.01, -0.01, 10.4, 19.5, 19.51, 3.333, 6.5])], "station string, i int, start double")
    got = {r.i: r.samples for r in segments.containing(asked, segs, ["station"], FS, "start", 100).collect()}
    assert sorted(got) == [0, 1, 5, 7, 8] and got[1][0] == 900.0 and got[7][0] == 333.0
    assert got[8] == list(map(float, range(650, 750)))  # over the end of a block


def test_ranges_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK", 64)
    x = np.random.default_rng(1).normal(size=1000)
    segs = segments_of(spark, ("s", 0, 0.0, x.tolist()), ("s", 1, 50.0, x[:65].tolist()), ("s", 2, 90.0, []))
    asked = [("s", 0, 0, 1000), ("s", 0, 63, 2), ("s", 0, 64, 64), ("s", 0, 999, 1), ("s", 1, 0, 65), ("s", 0, 5, 0), ("s", 0, 0, 1000)]
    rows = blocks.fetch(spark.createDataFrame(asked, "station string, seg_id int, at bigint, want int"), segs, ["station"], "at", "want").collect()
    assert len(rows) == 6 and all(np.array_equal(np.frombuffer(r.samples), x[r.at : r.at + r.want]) for r in rows)


@pytest.mark.parametrize("size", [50, 64, 997, 1 << 17])
def test_filter_over_blocks_is_the_filter_of_the_whole(spark, monkeypatch, size):
    from waveline.operators.signal import condition_segment

    monkeypatch.setattr(blocks, "BLOCK", size)
    rng = np.random.default_rng(size)
    rows = [("s", k, 1000.0 * k, (rng.normal(size=n).cumsum() + 5000).tolist()) for k, n in enumerate((3000, 51, 101, 29, 28, 27, 5))]
    segs = segments_of(spark, *rows)
    got = {}
    for r in blocks.filtered(segs, ["station"], FS, 2.0, 20.0).orderBy("seg_id", "block").collect():
        got.setdefault(r.seg_id, []).append(np.frombuffer(r.data))
    want = {k: condition_segment(np.array(x), FS) for _, k, _, x in rows}
    assert sorted(got) == [k for k, y in want.items() if y is not None] == [0, 1, 2, 3, 4]
    assert all(np.abs(np.concatenate(parts) - want[k]).max() < 1e-9 for k, parts in got.items())
    some = spark.createDataFrame([("s", 0, 0), ("s", 2, 0)], "station string, seg_id int, block int")
    assert sorted((r.seg_id, r.block) for r in blocks.filtered(segs, ["station"], FS, 2.0, 20.0, some).collect()) == [(0, 0), (2, 0)]


def sorts_of(df):
    return str(df._jdf.queryExecution().executedPlan().toString()).count("Sort [")


def test_trace_runs_order_traces_once(spark):
    rows = spark.createDataFrame([("S", t, n) for t, n in ((0.0, 10), (0.0, 4), (5.0, 5), (8.0, 10), (30.0, 5), (31.0, 3), (40.0, 1))], "station string, t0 double, n long")
    out = segments.trace_runs(rows, ["station"], 1.0)
    assert sorts_of(out) == 1
    assert sorted((r.t0, r.n, r.run, r.contained) for r in out.collect()) == [(0.0, 4, 0, True), (0.0, 10, 0, False), (5.0, 5, 0, True), (8.0, 10, 0, False), (30.0, 5, 1, False), (31.0, 3, 1, True), (40.0, 1, 2, False)]


def test_headers_meet_requests_in_few_buckets(spark):
    """Headers aren't copied by hours, and samples that follow from headers are made of asked blocks only."""
    heads = spark.createDataFrame([("S", k, k * 864000.0, 288, 0) for k in range(50)], "station string, seg_id int, t0 double, n long, block int")
    asked = spark.createDataFrame([(k, "S", k * 864000.0 + d) for k in range(50) for d in (-400.0, -200.0, 0.0, 170_400.0, 171_200.0)], "i long, station string, start double")
    held = segments.holding(asked, heads, ["station"], 1 / 600, "start", {"_x": 4})
    want = {(k, k * 864000.0 + d, k, at) for k in range(50) for d, at in ((-200.0, 0), (0.0, 0), (170_400.0, 284))}
    assert {(r.i, r.start, r["_x"].seg_id, r["_x"].at) for r in held.collect()} == want
    requests = held.select("i", "station", "_x.seg_id", "_x.at", F.lit(4).alias("want"))
    data = F.unhex(F.repeat(F.lpad(F.hex("seg_id"), 16, "0"), 288))
    got = blocks.fetch(requests, heads, ["station"], "at", "want", data).collect()
    assert len(got) == 150 and all(bytes(r.samples) == r.seg_id.to_bytes(8, "big") * 4 for r in got)
    right = held._jdf.queryExecution().optimizedPlan().toString()
    assert "3600.0" not in right
