"""The jobs over copies of the given tables: reruns, growing input, command lines."""

import logging

import pytest
from pyspark.sql import functions as F

from jobs import alarms, levels

ALARMS = alarms.Settings.load(alarms.CONFIG)


def events(spark, small):
    return spark.read.parquet(f"{small}/events.parquet")


def add(df, folder):
    """One more file in a folder, as new scores arrive."""
    df.coalesce(1).write.mode("append").parquet(folder)


def rows(df):
    return sorted((r.station, str(r.day), round(r.t, 6), round(r.p, 9)) for r in df.collect())


def test_alarms_over_growing_input(spark, small, tmp_path, caplog):
    """Two runs over a table that grows give what one run over all of it gives, and take only what is new."""
    table, cut = events(spark, small), "2024-01-15 12:00:00"
    whole, grown = str(tmp_path / "whole"), str(tmp_path / "grown")
    add(table, whole)
    want = alarms.run(spark, whole, f"{tmp_path}/a/out", f"{tmp_path}/a/state", ALARMS)
    caplog.set_level(logging.INFO, "jobs.alarms")
    early = table.where(F.col("ts") < F.lit(cut).cast("timestamp_ntz"))
    n = early.count()
    assert 0 < n < table.count()
    add(early, grown)
    first = rows(alarms.run(spark, grown, f"{tmp_path}/b/out", f"{tmp_path}/b/state", ALARMS))
    assert f"read {n} rows" in caplog.text
    add(table.where(F.col("ts") >= F.lit(cut).cast("timestamp_ntz")), grown)
    caplog.clear()
    second = rows(alarms.run(spark, grown, f"{tmp_path}/b/out", f"{tmp_path}/b/state", ALARMS))
    assert f"read {table.count() - n} rows" in caplog.text
    assert second == rows(want) and set(first) < set(second) and len(first) > 0
    caplog.clear()
    assert rows(alarms.run(spark, grown, f"{tmp_path}/b/out", f"{tmp_path}/b/state", ALARMS)) == second
    assert "read 0 rows" in caplog.text and "wrote 0 declarations" in caplog.text


def test_bursts_go_on_over_runs(spark, tmp_path):
    """A burst that was open when a run ended is one burst with what comes later."""
    s = alarms.Settings(threshold=0.5, cluster_seconds=60.0, lateness="10 seconds")
    make = lambda *r: spark.createDataFrame([("A", float(t), p) for t, p in r], "station string, t double, p double")
    paths = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    add(make((0, 0.9), (30, 0.8), (200, 0.4)), paths[0])
    assert alarms.run(spark, *paths, s).count() == 0
    add(make((80, 0.95), (300, 0.7), (500, 0.9)), paths[0])
    assert rows(alarms.run(spark, *paths, s)) == [("A", "1970-01-01", 80.0, 0.95), ("A", "1970-01-01", 300.0, 0.7)]


def test_odd_scores(spark, tmp_path):
    """Rows without station, time or score are none; an empty folder of files gives none; numbers, and both kinds of time stamps, are times."""
    made = spark.createDataFrame([("A", 1.0, 0.9), (None, 2.0, 0.9), ("A", None, 0.9), ("A", 3.0, None)], "station string, t double, p double")
    assert [tuple(r) for r in alarms.scores(made, alarms.Settings()).collect()] == [("A", 1.0, 0.9)]
    for kind in ("timestamp", "timestamp_ntz"):
        times = spark.sql(f"SELECT cast('2024-01-01 00:00:01.5' AS {kind}) AS t, 'A' AS station, 0.9 AS p")
        assert alarms.scores(times, alarms.Settings()).head().t == 1704067201.5
    add(made.limit(0), str(tmp_path / "in"))
    assert alarms.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), alarms.Settings()).count() == 0


def test_settings(tmp_path):
    assert ALARMS.station == "event_type" and levels.Settings.load(levels.CONFIG) == levels.Settings()
    (tmp_path / "x.toml").write_text("threshhold = 0.5")
    for job in (alarms, levels):
        with pytest.raises(ValueError, match="threshhold"):
            job.Settings.load(str(tmp_path / "x.toml"))


def test_command_lines(small, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark), "stop", lambda self: None)  # the tests' session stays
    add(events(spark, small), str(tmp_path / "scores"))
    alarms.main(["--source", str(tmp_path / "scores"), "--output", str(tmp_path / "alarms"), "--checkpoint", str(tmp_path / "state")])
    assert alarms.output(spark, str(tmp_path / "alarms")).count() > 0
    levels.main(["--source", f"{small}/documents.parquet", "--output", str(tmp_path / "levels")])
    assert spark.read.parquet(str(tmp_path / "levels/documents")).count() == 200


DOCS = "doc_id long, text string, lang string, source string, verdict string"


def verdicts(df):
    return {r.doc_id: r.verdict for r in df.collect()}


def test_levels_mark_what_is_no_prose(spark, tmp_path):
    prose = "the quick brown fox jumps over the lazy dog and runs away from it "
    docs = [(i, prose * (3 + i % 4), "en", "web", None) for i in range(40)]
    odd = [(100, None, "en", "web", None), (101, " \t ", "en", "web", None), (102, "one two", "en", "web", None), (103, "a " * 50 + "x" * 400, "en", "web", None), (104, "abcdefg " * 400, "en", "web", None), (None, prose, None, None, None)]
    spark.createDataFrame(docs + odd, DOCS).write.parquet(str(tmp_path / "in"))
    got = verdicts(levels.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), levels.Settings()))
    assert {k: got[k] for k in (100, 101, 102, 103, 104)} == {100: "silent", 101: "silent", 102: "short", 103: "loud", 104: "off"}
    assert {got[i] for i in range(40)} == {"normal"} and len(got) == 46


def test_levels_replace_only_their_sources(spark, tmp_path):
    make = lambda rows, name: spark.createDataFrame([(*r, None) for r in rows], DOCS).write.parquet(str(tmp_path / name))
    make([(1, "some words of a text", "en", "a"), (2, "some other words here", "en", "b/=x")], "one")
    make([(3, "a later text of words", "en", "b/=x")], "two")
    out = str(tmp_path / "out")
    run = lambda name: sorted((r.doc_id, r.source) for r in levels.run(spark, str(tmp_path / name), out, levels.Settings()).collect())
    assert run("one") == run("one") == [(1, "a"), (2, "b/=x")]
    assert run("two") == [(1, "a"), (3, "b/=x")]
    assert spark.read.schema(levels.BASELINE).parquet(f"{out}/baseline").count() == 2


def test_levels_equal_their_sql(spark, tmp_path):
    """Documents of 640 words have means halfway between two roundings, that of 5243 letters among them; silent ones have no deviation.

    Of the others the last two of each source deviate alike but for the last digit, and the quantile that trims lies between.
    """
    import duckdb

    from jobs import queries

    docs = [(k, " ".join("a" * (8 + (i < k)) for i in range(640)), "en", "web", None) for k in range(1, 640, 2)]
    words = [(4, 5, 5)] * 7 + [(1, 6, 7), (1, 2, 7)]
    docs += [(2000 + 20 * k + i, " ".join("a" * n for n in w), "en", f"s{k}", None) for k in range(7) for i, w in enumerate(words[k:])]
    docs += [(1000, None, "en", "web", None), (1001, " \t", "en", None, None)]
    spark.createDataFrame(docs, DOCS).drop("verdict").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.job2_levels(spark, str(tmp_path))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    found = db.sql(queries.SQL["job2_levels"])
    assert got.columns == found.columns and sorted(map(tuple, got.collect())) == sorted(found.fetchall())


def test_levels_of_no_documents(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "in"))
    assert levels.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), levels.Settings()).count() == 0


def test_jobs_import_nothing_of_the_corpus_operators():
    import subprocess
    import sys

    code = "import sys, jobs.alarms, jobs.levels, jobs.queries; print([m for m in sys.modules if m.startswith('waveline.llm') or m == 'corpus_pipeline'])"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.strip() == "[]"


def test_levels_takes_texts_apart_once(spark, small, tmp_path, monkeypatch):
    """What is read of a run's texts comes from stored pieces: no later plan scans them."""
    from jobs import levels

    stored, real = [], levels.checkpoint
    monkeypatch.setattr(levels, "checkpoint", lambda df: stored.append(df.columns) or real(df))
    levels.run(spark, f"{small}/documents.parquet", str(tmp_path), levels.Settings())
    assert stored == [["doc_id", "source", "lang", "s", "ss", "n"]]
