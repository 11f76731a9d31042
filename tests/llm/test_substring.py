import hashlib
import random
import re

import numpy as np
import pytest
from llm_helpers import odd_rows, prose, rows_of

from waveline.llm import substring


def brute(rows, size):
    """What stays of each row, by comparing every window with those of smaller ids."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    first = {}
    for (i, *_), w in zip(rows, words):
        for k in range(len(w) - size + 1 if i is not None else 0):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, *_), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - size + 1 if i is not None else 0):
            if first[tuple(w[k : k + size])] < i:
                gone |= set(range(k, k + size))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def passages(seed, n=60):
    """Documents that share passages of all lengths, whole, cut and chained."""
    rng = random.Random(seed)
    pool = [prose(1000 + k, rng.choice([8, 12, 30, 60, 120])) for k in range(12)]
    rows = []
    for i in range(n):
        parts = [prose(rng.random(), rng.randrange(40)) if rng.random() < 0.6 else rng.choice(pool) for _ in range(rng.randrange(1, 7))]
        if rng.random() < 0.2:
            parts.append("again and again " * rng.randrange(30))
        rows.append((rng.randrange(1, 10_000), "  ".join(parts), "en", "a"))
    return rows + rng.sample(rows, 5)


@pytest.mark.parametrize("size,run,seed", [(50, 8, 1), (10, 3, 2), (5, 5, 3), (7, 2, 4)])
def test_against_brute_force(make_docs, size, run, seed):
    rows = passages(seed) + odd_rows(20_000)
    got = rows_of(substring.dedup(make_docs(rows), size=size, run=run), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute(rows, size), key=lambda t: tuple((x is None, str(type(x)), x) for x in t))


def test_rows_of_one_id_do_not_clean_each_other(make_docs):
    a, b = prose(1, 80), prose(2, 80)
    rows = [(5, a), (5, b), (5, a + " " + b), (9, b), (3, prose(3, 20))]
    got = rows_of(substring.dedup(make_docs(rows), size=50), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute(rows, 50), key=lambda t: tuple((x is None, str(type(x)), x) for x in t))
    assert {(r[0], r[2]) for r in got} == {(3, 0), (5, 0), (9, 80)}


def test_intervals_are_maximal(make_docs):
    shared, tail = prose(1, 90), prose(9, 70)
    rows = [(1, shared), (2, tail), (3, prose(2, 10) + " " + shared + " " + prose(3, 5) + " " + tail)]
    out = {r.doc_id: [(x.begin, x.end) for x in r.intervals] for r in substring.dedup(make_docs(rows)).collect()}
    assert out == {1: [], 2: [], 3: [(10, 100), (105, 175)]}


def test_rolling_hashes_are_of_words(spark):
    h = substring.Hashed(prose(4, 300).encode())
    runs = h.runs(7)
    seen = {}
    for k in range(len(h.words) - 6):
        assert seen.setdefault(tuple(h.words[k : k + 7]), runs[k]) == runs[k]
    assert len(set(runs.tolist())) == len(seen)
    least, _, first, count = h.stretches(50, 8)
    spans = [min(h.runs(8)[k : k + 43].tolist()) for k in range(251)]
    assert np.repeat(least.view(np.uint64), count).tolist() == spans and first[0] == 0


def test_empty_table(make_docs):
    assert substring.dedup(make_docs([])).collect() == []
    assert substring.drop_repeats(make_docs([])).collect() == []


def test_stage(make_docs):
    shared = prose(1, 90)
    rows = [(1, shared), (2, "x y  z\n" + shared), (3, shared), (4, None), (5, ""), (None, shared), (6, "kept  as it is")]
    docs = make_docs(rows)
    out = substring.drop_repeats(docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    got = {(r.doc_id, r.text, r.n_chars) for r in out.collect()}
    assert got == {(1, shared, len(shared)), (2, "x y z", 5), (4, None, None), (5, "", 0), (None, shared, len(shared)), (6, "kept  as it is", 14)}
