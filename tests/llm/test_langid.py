import math
import re
import zlib

import pytest
from llm_helpers import odd_rows, pandas_of, prose

from waveline.llm import langid

LEXICON = {"en": "the of and house water with which there".split(), "de": "der und nicht über schön straße zwischen".split(), "fr": "été une dans français où garçon être".split()}


def rows(n=60):
    return [(100 + 3 * i + k, prose(i, 40, LEXICON[lang]), lang, "a") for i in range(n) for k, lang in enumerate(LEXICON)]


def test_held_out_rows_are_known(make_docs):
    out = pandas_of(langid.identify(make_docs(rows())))
    truth = {r[0]: r[2] for r in rows()}
    assert len(out) == len(truth)
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(out.doc_id, out.held_out))
    assert (out.lang_pred == out.doc_id.map(truth)).all()
    assert out.score.between(0, 1).all()


def test_odd_rows(make_docs):
    out = pandas_of(langid.identify(make_docs(rows(10) + odd_rows())))
    odd = out[~out.doc_id.between(100, 200)]
    assert len(odd) == len(odd_rows())
    by = {i: p for i, p in zip(odd.doc_id, odd.lang_pred) if i == i}
    assert [by[i] for i in (1, 2, 3, 7)] == ["und"] * 4 and by[4] == by[5] != "und"
    assert not odd[odd.doc_id.isna()].held_out.any()


def test_held_out_labels_do_not_matter(make_docs):
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    changed = [(i, t, "xx" if held(i) else lang, s) for i, t, lang, s in rows(20)]
    a, b = (pandas_of(langid.identify(make_docs(r))).sort_values("doc_id").reset_index(drop=True) for r in (rows(20), changed))
    assert a.equals(b)


def test_nothing_to_learn_and_empty(make_docs):
    assert {r.lang_pred for r in langid.identify(make_docs([(1, "words", None, None), (2, "more", None, None)])).collect()} == {"und"}
    assert langid.identify(make_docs([])).collect() == []


def test_counts_are_those_of_a_loop(make_docs):
    few = rows(3) + [(1, None, "en", "a"), (2, "", "de", "a")]
    got = {(r.lang, r.bucket): r.n for r in langid.bucket_counts(make_docs(few), "text", "lang", 1 << 10).collect()}
    want = {}
    for _, t, lang, _ in few:
        want[lang, -1] = want.get((lang, -1), 0) + 1
        for g in langid.grams(t or "", 1 << 10).tolist():
            want[lang, g] = want.get((lang, g), 0) + 1
    assert got == want


def brute_model(data, buckets, smoothing=0.5):
    """Counts and log-probabilities by plain loops."""
    docs, counts = {}, {}
    for i, text, lang, _ in data:
        if lang is not None and i is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            docs[lang] = docs.get(lang, 0) + 1
            own = counts.setdefault(lang, {})
            for g in langid.grams(text or "", buckets).tolist():
                own[g] = own.get(g, 0) + 1
    total = {lang: sum(c.values()) + smoothing * buckets for lang, c in counts.items()}
    return {lang: (math.log(docs[lang] / sum(docs.values())), lambda g, c=counts[lang], n=total[lang]: math.log((c.get(g, 0) + smoothing) / n)) for lang in sorted(docs)}


def brute_predict(model, text, buckets):
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    scores = {lang: prior + sum(weight(g) for g in langid.grams(text, buckets).tolist()) for lang, (prior, weight) in model.items()}
    best = max(scores, key=lambda lang: scores[lang])
    return best, 1 / sum(math.exp(s - scores[best]) for s in scores.values())


def plain_grams(text):
    """1- to 3-grams of a text as strings: lower case, each run of other characters one blank."""
    run = re.sub(" +", " ", "".join(c.lower()[0] if c.isalpha() else " " for c in f" {text} "))
    return [run[i : i + k] for k in (1, 2, 3) for i in range(len(run) - k + 1)]


def test_grams_are_those_of_plain_strings():
    """Equal strings have equal buckets, and different ones almost never share one of a million."""
    texts = ["the House, of  1 water", "ÉTÉ été", "a", "", "x y", "\U00010400b"]
    of = {}
    for t in texts:
        plain, got = plain_grams(t), langid.grams(t, 1 << 20).tolist()
        assert len(plain) == len(got)
        for p, g in zip(plain, got):
            assert of.setdefault(p, g) == g
    assert len(set(of.values())) == len(of)


@pytest.mark.parametrize("chars", [1, 1 << 18])
def test_predictions_against_brute_force(make_docs, monkeypatch, chars):
    monkeypatch.setattr(langid, "CHARS", chars)
    mixed = [(5000 + i, prose(i, 1 + i % 4, LEXICON["en"] + LEXICON["fr"] + LEXICON["de"]), None, "b") for i in range(40)]
    data = rows(12) + mixed + odd_rows(9000)
    got = {(r.doc_id, r.lang_pred, round(r.score, 5)) for r in langid.identify(make_docs(data)).collect()}
    model = brute_model(data, langid.BUCKETS)
    want = set()
    for i, t, *_ in data:
        lang, score = brute_predict(model, t, langid.BUCKETS)
        want.add((i, lang, round(score, 5)))
    assert len(got) == len(want)
    for (gi, gl, gs), (wi, wl, ws) in zip(sorted(got, key=str), sorted(want, key=str)):
        assert (gi, gl) == (wi, wl) and gs == pytest.approx(ws, abs=2e-4)
    assert any(0.05 < s < 0.999 for _, _, s in got)


def test_sparse_counts_are_each_text_alone():
    texts = ["", "a", "the house", "été " * 30, "12", "the house"]
    ends, buckets, counts = langid.sparse_counts(texts, 1 << 10)
    for k, t in enumerate(texts):
        lo, hi = (ends[k - 1] if k else 0), ends[k]
        alone = langid.grams(t, 1 << 10)
        assert dict(zip(buckets[lo:hi].tolist(), counts[lo:hi].tolist())) == {g: int((alone == g).sum()) for g in set(alone.tolist())}


def test_blocks_of_languages_give_what_one_model_gives(make_docs):
    """More languages than one broadcast holds: a pass for each block, the same predictions."""
    data = rows(20) + [(9000 + i, prose(i, 1 + i % 4, LEXICON["en"] + LEXICON["fr"] + LEXICON["de"]), None, "b") for i in range(40)] + odd_rows(9500)
    docs = make_docs(data)
    models = [langid.train(docs, block=n) for n in (256, 2, 1)]
    assert [len(m) for m in models] == [1, 2, 4] and all(len(m.weights) == langid.BUCKETS for part in models for m in part)
    texts = [t for _, t, *_ in data]
    one = models[0][0].predict(texts)
    for part in models:
        got = langid.predict_all(part, texts)
        assert [lang for lang, _ in got] == [lang for lang, _ in one] and [p for _, p in got] == pytest.approx([p for _, p in one], rel=1e-6)
        out = langid.predicted(docs.select("doc_id", "text"), 1, part, "lang", "p").collect()
        assert sorted((r.text or "", r.lang) for r in out) == sorted((t or "", lang) for t, (lang, _) in zip(texts, one))
    assert 0.05 < min(p for lang, p in one if lang != "und") < 0.99


def test_stage_keeps_columns_and_clean_rows(make_docs):
    docs = make_docs(rows(10) + odd_rows())
    out = langid.keep_identified(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in out.collect()) == sorted([r[0] for r in rows(10)] + [0, 4, 5, 6, 6, 8])


def test_stage_keeps_texts_with_letters_without_anything_to_learn_from(make_docs):
    docs = make_docs([(1, "one two", None, "a"), (2, "12 !!", None, "a"), (3, None, None, "a"), (None, "été", None, "a")])
    out = langid.keep_identified(docs)
    assert out.columns == docs.columns and sorted(str(r.doc_id) for r in out.collect()) == ["1", "None"]
