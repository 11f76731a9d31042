import os
import random

import corpus_pipeline
from llm_helpers import odd_rows, prose
from test_decontaminate import brute as brute_leaks
from test_mixing import brute as brute_mix
from test_simhash import brute_similar

from waveline.llm import langid, mixing


def test_stages_against_brute_force(spark, make_docs, tmp_path):
    rng = random.Random(1)
    shared, bench = prose(500, 70), [(1, prose(900, 25, [f"q{i}" for i in range(50)])), (2, prose(901, 40, [f"z{i}" for i in range(60)]))]
    rows = odd_rows(9_000)
    for i in range(150):
        text = prose(i, rng.randrange(5, 120))
        if i % 7 == 0:
            text += " " + shared
        if i % 11 == 0:
            text += " " + rng.choice(bench)[1]
        rows.append((i, text, rng.choice(["en", "de"]), rng.choice(["hot", "hot", "b"])))
        if i % 5 == 0:
            rows.append((1000 + i, text, "en", "hot"))
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = sorted((str(r.doc_id), r.text) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())

    left = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    near = brute_similar(left)
    left = [r for r, (i, c) in zip(left, near) if i is None or i == c]
    cut, first = [], {}
    for i, t, *_ in left:
        w = t.split()
        for k in range(len(w) - 49 if i is not None else 0):
            first[tuple(w[k : k + 50])] = min(first.get(tuple(w[k : k + 50]), i), i)
    for i, t, lang, s in left:
        w, gone = t.split(), set()
        for k in range(len(w) - 49 if i is not None else 0):
            if first[tuple(w[k : k + 50])] < i:
                gone |= set(range(k, k + 50))
        kept = [x for k, x in enumerate(w) if k not in gone]
        if kept or not w:
            cut.append((i, " ".join(kept) if gone else t, lang, s))
    leaked = {d for d, *_ in brute_leaks(cut, bench)}
    left = [r for r in cut if r[0] not in leaked]
    sampled = brute_mix(left, list(mixing.TARGETS.values()), mixing.SWEEPS, mixing.BUDGET)
    assert got == sorted((str(r[0]), r[1]) for r in left if sampled[r[0]][-1])
    assert 10 < len(got) < len(left)


def test_stages_keep_columns_and_read_each_other(spark, make_docs, small):
    docs = make_docs(odd_rows())
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
        assert docs.columns == make_docs([]).columns, name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near duplicates", "repeated passages", "benchmark leaks", "mixing"]


def test_empty_documents(spark, make_docs, tmp_path):
    make_docs([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_held_out_accuracy(spark, small):
    docs = spark.read.parquet(os.path.join(small, "documents.parquet"))
    out = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(out) > 20 and (out.lang == out.lang_pred).mean() >= 0.95
