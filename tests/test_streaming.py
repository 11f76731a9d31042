import random

from pyspark.sql import functions as F

from waveline.operators import alarms
from waveline.streaming.declarations import streaming_declarations
from waveline.streaming.ingest import drain, ledger_stream, score_stream


def rows(seed=1, n=300):
    rng = random.Random(seed)
    return [(rng.choice("AB"), float(rng.randrange(20_000)), rng.choice([0.2, 0.8, 0.9])) for _ in range(n)] + [("A", 90_000.0, 0.9), ("A", 90_060.0, 0.9), ("A", 90_121.0, 0.95)]


def test_stream_equals_batch(spark, tmp_path):
    df = spark.createDataFrame(rows(), "station string, t double, p double").withColumn("p", F.col("p").cast("float")).dropDuplicates(["station", "t"])
    want = sorted(map(tuple, alarms.declarations(df, ["station"], 0.5, 60.0).collect()))
    assert sorted(map(tuple, streaming_declarations(df, 0.5, 60.0).collect())) == want
    src = str(tmp_path / "scores")
    df.repartition(3).write.parquet(src)
    q = streaming_declarations(score_stream(spark, src), 0.5, 60.0, lateness="2 days").writeStream.format("memory").queryName("declared").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("declared").collect())) == want


def test_new_files_come_once(spark, tmp_path):
    src, seen = tmp_path / "ledgers", []
    src.mkdir()
    line = '{"station": "%s", "state": "fetched", "start": "2024-01-01", "end": "2024-01-02"}\n'
    for names, torn in ((("A", "B"), ""), (("C",), '{"station": "D", "sta')):
        (src / f"{names[0]}.jsonl").write_text("".join(line % n for n in names) + torn)
        drain(ledger_stream(spark, str(src)), str(tmp_path / "cp"), lambda df, _: seen.append(sorted(r.station for r in df.collect())))
    assert [s for s in seen if s] == [["A", "B"], ["C"]]
