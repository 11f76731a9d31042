import json
import os
import zipfile

import numpy as np
import pytest

from waveline.sources import archive, config, mseed, store, tables

FS = 100.0


def traces(seed=0, station="TEST"):
    rng = np.random.default_rng(seed)
    return [mseed.Trace(station, c, 1714521600.25 + 7 * k, FS, rng.integers(-(2**b), 2**b, 3000).astype(float)) for k, (c, b) in enumerate((("HHZ", 3), ("HHN", 12), ("HHE", 28)))]


@pytest.mark.parametrize("encoding", [3, mseed.STEIM1])
def test_mseed_round_trip(encoding):
    back = mseed.read_traces(mseed.write_traces(traces(), encoding=encoding, power=9))
    assert [(t.station, t.channel, t.t0, t.fs) for t in back] == [(t.station, t.channel, pytest.approx(t.t0, abs=1e-6), t.fs) for t in traces()]
    assert all(np.array_equal(a.data, b.data) for a, b in zip(back, traces()))


@pytest.mark.parametrize("code,nibble,k,bits", [(1, None, 4, 8), (2, 1, 1, 30), (2, 2, 2, 15), (2, 3, 3, 10), (3, 0, 5, 6), (3, 1, 6, 5), (3, 2, 7, 4)])
def test_steim2_words(code, nibble, k, bits):
    rng = np.random.default_rng(k)
    d = rng.integers(-(2 ** (bits - 1)), 2 ** (bits - 1), k * 13)
    x = 1000 + np.concatenate(([0], np.cumsum(d[1:])))
    words = []
    for i in range(0, len(d), k):
        w = sum((int(v) & (1 << bits) - 1) << bits * (k - 1 - j) for j, v in enumerate(d[i : i + k]))
        words.append(w | (nibble << 30 if nibble is not None else 0))
    control = sum(code << 28 - 2 * (i + 2) for i in range(13))
    frame = np.array([control, 1000, int(x[-1]) & 0xFFFFFFFF, *words], ">u4").tobytes()
    assert np.array_equal(mseed.decode_steim(frame, len(d), 2), x)
    with pytest.raises(ValueError):
        mseed.decode_steim(frame, len(d) - 1, 2)


def make_archive(root, stations=("AAA", "BBB"), days=("2024-01-01", "2024-01-22")):
    for s in stations:
        os.makedirs(root / s)
        for i, d in enumerate(days):
            with zipfile.ZipFile(root / s / f"{s}_{d}.zip", "w") as z:
                z.writestr("readme.txt", "x")
                z.writestr("data.MSEED", mseed.write_traces(traces(i, s)))
        for name in (f"{s}_2024-02-01.zip.part", f"incoming.{s}", f"{s}_2024-01-01.dup2.zip", "other.txt"):
            (root / s / name).write_text("x")
    os.makedirs(root / "_skipped")
    (root / "_skipped" / "AAA_2024-01-01.zip").write_text("x")
    return root


def test_discovery_and_decoding(spark, tmp_path):
    root = str(make_archive(tmp_path / "a"))
    files = archive.list_files(spark, root)
    chunks = archive.find_chunks(files)
    assert [(r.station, r.chunk, r.chunk_date) for r in chunks.collect()] == [(s, f"{s}_{d}", d) for s in ("AAA", "BBB") for d in ("2024-01-01", "2024-01-22")]
    assert [r.station for r in archive.find_chunks(files, ["BBB"]).collect()] == ["BBB"] * 2
    reasons = {r.name: r.reason for r in archive.rejected(files, ["AAA"]).collect()}
    assert reasons == {"AAA_2024-02-01.zip.part": "download in flight", "incoming.AAA": "download in flight", "AAA_2024-01-01.dup2.zip": "duplicate delivery", "other.txt": "unrecognised name"}
    got = archive.read_chunks(chunks.where("station = 'AAA'")).collect()
    assert len(got) == 6 and {r.channel for r in got} == {"HHZ", "HHN", "HHE"}
    assert [r.seq for r in got if r.chunk.endswith("01-22")] == [0, 1, 2] and {(r.at, r.n) for r in got} == {(0, 3000)}
    assert np.array_equal(np.frombuffer(next(r.data for r in got if r.chunk.endswith("01-22") and r.channel == "HHZ")), traces(1)[0].data)
    archive.register(spark)
    source = spark.read.format("waveline_chunks").load(root)
    assert source.where("station = 'BBB' and chunk = 'BBB_2024-01-22'").select("station", "chunk").distinct().collect() == [("BBB", "BBB_2024-01-22")]
    assert source.count() == 12
    one = spark.read.format("waveline_chunks").option("stations", "BBB").option("chunks", "BBB_2024-01-22").load(root)
    assert one.select("station", "chunk").distinct().collect() == [("BBB", "BBB_2024-01-22")]
    vertical = spark.read.format("waveline_chunks").option("channels", "HHZ").load(root)
    assert {(r.channel, r.seq) for r in vertical.collect()} == {("HHZ", 0)} and vertical.count() == 4


class Reading:
    """A stream that says how much was asked of it ahead of what has been used."""

    def __init__(self, data):
        self.data, self.at = data, 0

    def read(self, n):
        part = self.data[self.at : self.at + n]
        self.at += len(part)
        return part


def test_records_are_decoded_as_they_come():
    data = mseed.write_traces([mseed.Trace("S", c, 1714521600.0, FS, np.arange(100_000.0)) for c in ("HHZ", "HHN")])
    f = Reading(data)
    pieces = mseed.stream_pieces(f, 5000)
    first = next(pieces)
    assert (first.seq, first.at, len(first.trace.data)) == (0, 0, 5000)
    f2 = Reading(data)
    assert next(mseed.stream_records(f2, window=8192)) and f2.at <= 16_384
    rest = [first, *pieces]
    assert [(p.seq, p.at) for p in rest] == [(s, k * 5000) for s in (0, 1) for k in range(20)]
    assert all(np.array_equal(p.trace.data, np.arange(p.at, p.at + 5000.0)) for p in rest)
    assert {p.seq for p in mseed.stream_pieces(Reading(data), 5000, ["HHN"])} == {1}


def test_options_prune_files(tmp_path):
    root = str(make_archive(tmp_path / "a"))
    assert len(archive.ChunkReader(root, None, None).partitions()) == 4
    assert [p.station for p in archive.ChunkReader(root, ["AAA"], None).partitions()] == ["AAA", "AAA"]


def test_station_and_event_tables(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("﻿Code, Latitude ,Longitude,More\nA,1,2,x\n ,3,4,\nB,5,6,\nA,7,8,\n", encoding="utf-8")
    assert sorted(map(tuple, tables.read_stations(spark, str(path)).collect())) == [("A", 7.0, 8.0), ("B", 5.0, 6.0)]
    assert tables.station_coords(spark, str(path), "A") == (1.0, 2.0)
    with pytest.raises(KeyError):
        tables.station_coords(spark, str(path), "C")
    path = tmp_path / "c.csv"
    path.write_text("﻿EventID,Date,Latitude,Longitude,Depth,Magnitude,Location\n1,05/02/2024 03:04:05,37,30,7,3.5,here\n2,5/2/2024 3:4:5,37.5,30,,NaN,there\n3,05/13/2024 00:00:00,37,30,7,3,bad\n4,05/02/2024 03:04:06,47,30,7,9,far\n")
    events = tables.read_events(spark, str(path))
    assert [(r.event_id, r.t, r.depth, r.mag) for r in events.orderBy("event_id").collect()] == [(1, 1707102245.0, 7.0, 3.5), (2, 1707102245.0, None, None), (4, 1707102246.0, 7.0, 9.0)]
    assert [r.event_id for r in tables.load_catalog(events, 37.0, 30.0).collect()] == [1]


def test_ledgers(spark, tmp_path):
    row = lambda **k: json.dumps({"station": "A", "state": "fetched", "start": "2024-01-01", "end": "2024-01-11T12:00:00"} | k)
    (tmp_path / "one_ledger.jsonl").write_text("\n".join([row(), "", row(start="2024-01-05", end="2024-01-20"), row(station=""), row(station="B", state=None), row()[:20]]))
    (tmp_path / "two.jsonl").write_text(row(start="2024-02-01", end="2024-02-03T23:00:00") + "\n" + row(state="claimed"))
    got = tables.read_ledgers(spark, [str(tmp_path / n) for n in ("one_ledger.jsonl", "two.jsonl", "none.jsonl")])
    assert sorted((r.station, r.state, r.source) for r in got.collect()) == [("A", "claimed", "two"), ("A", "fetched", "one"), ("A", "fetched", "one"), ("A", "fetched", "two"), ("B", "?", "one")]
    spans = tables.spans_in_state(got, tables.FETCHED).orderBy("lo").collect()
    assert [(r.hi - r.lo) / 86400 for r in spans] == [19.0, pytest.approx(2 + 23 / 24)]
    assert tables.read_ledgers(spark, []).count() == 0


def test_snr_and_baseline_files(spark, tmp_path):
    (tmp_path / "r.csv").write_text("event_id,time,snr\n1,x,2.5\n1,x,3.5\n2,x,\n")
    assert {r.event_id: r.snr for r in tables.read_snr(spark, str(tmp_path / "r.csv")).collect()} == {1: 3.5, 2: None}
    (tmp_path / "b.json").write_text(json.dumps({"Z": {"mu": 0.5, "sigma": 2.0}, "_conditioning": {"freqmin": 1}}))
    rows, cond = tables.read_baseline(spark, str(tmp_path / "b.json"))
    assert cond == {"freqmin": 1} and rows.head().sigma_trimmed is None
    assert tables.read_baseline(spark, str(tmp_path / "none.json")) is None


def test_config(tmp_path, monkeypatch):
    deep = tmp_path / "x" / "y"
    deep.mkdir(parents=True)
    (tmp_path / config.NAME).write_text('archive = "data"\nout = "/abs/out"\nledgers = ["l1.jsonl", "s3://b/l2.jsonl"]\n')
    c = config.load({"stations": "here.csv", "archive": None}, str(deep))
    assert (c.archive, c.out, c.stations, c.ledgers) == (str(tmp_path / "data"), "/abs/out", "here.csv", [str(tmp_path / "l1.jsonl"), "s3://b/l2.jsonl"])
    assert config.load({"archive": "flag", "ledger": ["z"]}, str(deep)).ledgers == ["z"]
    with pytest.raises(ValueError, match="catalog"):
        c.require("archive", "catalog")


def test_products_are_overwritten_by_partition(spark, tmp_path):
    layout = store.Layout(str(tmp_path))
    rows = lambda *r: spark.createDataFrame(r, "station string, chunk string, arm string, t double, p float")
    store.write_scores(rows(("A", "c1", "6s", 1.0, 0.5), ("A", "c2", "6s", 2.0, 0.5)), layout)
    store.write_scores(rows(("A", "c2", "6s", 3.0, 0.5)), layout)
    assert [r.t for r in tables.read_scores(spark, layout.scores, "A", "6s").collect()] == [1.0, 3.0]
    with pytest.raises(FileNotFoundError):
        tables.read_scores(spark, layout.scores, "A", "10s")
    assert store.completed(spark, layout).count() == 0
    done = spark.createDataFrame([("A", "c1", "range", 0)], "station string, chunk string, product string, outputs int")
    store.mark_completed(done, layout)
    store.mark_completed(done, layout)
    assert store.completed(spark, layout).count() == 1
