import hashlib
import random

import pytest
from llm_helpers import odd_rows, pandas_of, prose

from waveline.llm import mixing


def rows(n=300):
    rng = random.Random(3)
    marks = ["", "Licensed under", " | ", "a@b"]
    return [(i, prose(i, rng.randrange(1, 60)) + " " + rng.choice(marks), rng.choice(["en", "en", "de"]), rng.choice(["hot", "hot", "a", "b"])) for i in range(n)]


def brute(data, targets, sweeps, budget):
    def topic(text):
        return next((name for name, mark in mixing.TOPICS if mark in (text or "")), mixing.GENERAL)

    feats = [(i, s or mixing.NONE, lang or mixing.NONE, topic(t), len((t or "").split())) for i, t, lang, s in data]
    cells = {}
    for _, *key, n in feats:
        cells[tuple(key)] = cells.get(tuple(key), 0) + n
    total = sum(cells.values())
    f = dict.fromkeys(cells, 1.0)
    shares = []
    for k, t in enumerate(targets):
        sums = {}
        for key, n in cells.items():
            sums[key[k]] = sums.get(key[k], 0) + n
        raw = {v: (n**t if n else 0.0) if not isinstance(t, dict) else t.get(v, 0.0) * (n > 0) for v, n in sums.items()}
        shares.append({v: x / sum(raw.values()) for v, x in raw.items()})
    for _ in range(sweeps):
        off = 0.0
        for k, share in enumerate(shares):
            w = {}
            for key, n in cells.items():
                w[key[k]] = w.get(key[k], 0) + n * min(1.0, budget * f[key]) / budget
            for key in cells:
                ratio = total * share[key[k]] / w[key[k]] if w[key[k]] > 0 else 1.0
                f[key] *= ratio
                off = max(off, abs(ratio - 1))
        if off <= mixing.TOLERANCE:
            break
    out = {}
    for i, *key, n in feats:
        p = min(1.0, budget * f[tuple(key)])
        u = int(hashlib.md5(str(i if i is not None else "").encode()).hexdigest()[:13], 16) / 2**52
        out[i] = (*key, n, round(p / budget, 9), u < p)
    return out


@pytest.mark.parametrize("targets", [mixing.TARGETS, {"source": {"hot": 1, "a": 2, "b": 2}, "lang": 0.5, "topic": 1.0}])
def test_against_brute_force(make_docs, targets):
    data = rows() + odd_rows(1000) if targets is mixing.TARGETS else rows()
    got = {r.doc_id: (r.source, r.lang, r.topic, r.n_tokens, round(r.weight, 9), r.sampled) for r in mixing.mix(make_docs(data), targets).collect()}
    want = brute(data, list(targets.values()), mixing.SWEEPS, mixing.BUDGET)
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k][:4] == w[:4] and got[k][4] == pytest.approx(w[4], abs=1e-6) and got[k][5] == w[5], k


def test_margins_are_met(make_docs):
    out = pandas_of(mixing.mix(make_docs(rows()), {"source": {"hot": 1, "a": 1, "b": 1}, "lang": {"en": 1, "de": 1}, "topic": 1.0}, sweeps=30))
    w = out.n_tokens * out.weight
    for margin, share in (("source", 1 / 3), ("lang", 1 / 2)):
        assert (w.groupby(out[margin]).sum() / w.sum()).to_numpy() == pytest.approx(share, abs=1e-6)


def skewed():
    """A hot source of a third of the rows beside small ones that are wanted far above their share."""
    rng = random.Random(8)
    sources = ["hot"] * 400 + ["a", "b", "c"] * 250 + ["tiny"] * 12 + ["small"] * 30
    return [(i, prose(i, rng.randrange(20, 60)) + rng.choice(["", " Licensed under", " a@b"]), rng.choice(["en", "en", "en", "de"]), s) for i, s in enumerate(sources)]


def test_expected_shares_meet_the_targets_though_cells_are_taken_whole(make_docs):
    targets = {"source": {"hot": 0.32, "a": 0.21, "b": 0.21, "c": 0.21, "tiny": 0.013, "small": 0.037}, "lang": {"en": 0.6, "de": 0.4}, "topic": 0.8}
    docs = make_docs(skewed())
    out = pandas_of(mixing.mix(docs, targets, sweeps=40))
    assert (out.probability == 1).any() and out.probability.max() <= 1
    taken = out.n_tokens * out.probability
    for margin in ("source", "lang"):
        got = taken.groupby(out[margin]).sum() / taken.sum()
        for value, share in targets[margin].items():
            assert got[value] == pytest.approx(share, abs=2e-4), (margin, value)
    cells = mixing.rake(mixing.cells_of(mixing.features(docs), list(targets)), targets, 40)
    assert all(abs(r.target - r.expected) < 2e-4 for r in mixing.margins(cells, targets).collect())
    whole = out[out.sampled]
    drawn = whole.groupby("source").n_tokens.sum() / whole.n_tokens.sum()
    assert drawn["tiny"] > 0.006 and abs(drawn["hot"] - 0.32) < 0.08


def test_unreachable_margins_are_told(make_docs):
    docs = make_docs(skewed())
    targets = {"source": {"hot": 0.1, "tiny": 0.9}, "lang": 1.0, "topic": 1.0}
    cells = mixing.rake(mixing.cells_of(mixing.features(docs), list(targets)), targets)
    told = {(r.margin, r.value): (r.target, r.expected) for r in mixing.margins(cells, targets).collect()}
    assert told["source", "tiny"][0] == 0.9 and told["source", "tiny"][1] < 0.9 and told["source", "a"] == (0.0, 0.0)
    assert all(r.probability == 1 for r in mixing.mix(docs, targets).where("source = 'tiny'").collect())


def test_sweeps_end_when_margins_are_met(make_docs, monkeypatch):
    written = []
    real = mixing.stored
    monkeypatch.setattr(mixing, "stored", lambda df, name: written.append(name) or real(df, name))
    mixing.mix(make_docs(rows()), {"source": 1.0, "lang": 1.0, "topic": 1.0}).collect()
    assert written.count("mixing-sweep") == 1


def test_given_topics(make_docs):
    out = pandas_of(mixing.mix(make_docs(rows(60)), topic_col="weight"))
    assert set(out.topic) == {"clash"}


def test_rows_come_back_as_often(make_docs):
    data = odd_rows()
    assert mixing.mix(make_docs(data)).count() == len(data)
    assert mixing.mix(make_docs([])).collect() == []


def test_stage_samples_the_same(make_docs):
    docs = make_docs(rows() + odd_rows(1000))
    out = mixing.sample(docs)
    assert out.columns == docs.columns
    want = sorted(str(r.doc_id) for r in mixing.mix(docs).where("sampled").collect())
    assert sorted(str(r.doc_id) for r in out.collect()) == want
    assert mixing.sample(make_docs([])).collect() == []


def test_no_python_on_the_executors(make_docs):
    plan = mixing.mix(make_docs(rows(20)))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
