import hashlib
import random

import numpy as np
import pytest
from llm_helpers import odd_rows, prose, rows_of

from waveline.llm import suffixes


def brute(rows, size):
    """What stays of each row, by comparing every byte string with those of smaller ids."""
    texts = [(t or "").encode() for _, t, *_ in rows]
    first = {}
    for (i, *_), t in zip(rows, texts):
        for k in range(len(t) - size + 1 if i is not None else 0):
            first[t[k : k + size]] = min(first.get(t[k : k + size], i), i)
    out = []
    for (i, *_), t in zip(rows, texts):
        gone = np.zeros(len(t) + 2, bool)
        for k in range(len(t) - size + 1 if i is not None else 0):
            if first[t[k : k + size]] < i:
                gone[k + 1 : k + 1 + size] = True
        kept = bytes(b for b, g in zip(t, gone[1:]) if not g)
        out.append((i, len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=order)


def order(t):
    return tuple((x is None, str(type(x)), x) for x in t)


def found(df):
    return rows_of(df, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def passages(seed, n=60):
    """Documents that share passages of all lengths, whole, cut, chained and edited."""
    rng = random.Random(seed)
    pool = [prose(1000 + k, rng.choice([2, 6, 12, 30, 120])) for k in range(12)]
    rows = []
    for _ in range(n):
        parts = [prose(rng.random(), rng.randrange(25)) if rng.random() < 0.6 else rng.choice(pool) for _ in range(rng.randrange(1, 7))]
        if rng.random() < 0.2:
            parts.append(rng.choice(["ab", "=", "\0", "né "]) * rng.randrange(300))
        text = " ".join(parts)
        if rng.random() < 0.3 and text:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(["", "x", "\0", "é"]) + text[at + 1 :]
        rows.append((rng.randrange(-50, 10_000), text, "en", "a"))
    return rows + rng.sample(rows, 5)


@pytest.mark.parametrize("size,run,seed", [(50, 20, 1), (20, 7, 2), (9, 9, 3), (5, 2, 4)])
def test_against_brute_force(make_docs, size, run, seed):
    rows = passages(seed) + odd_rows(20_000)
    assert found(suffixes.dedup(make_docs(rows), size=size, run=run)) == brute(rows, size)


def test_an_anchor_with_many_stretches(make_docs):
    """A passage in every document, with other neighbours in each: more stretches of its anchors
    than a block gives to a bucket, so that windows decide."""
    rng = random.Random(7)
    passage = prose(1, 15)
    rows = [(i, prose(rng.random(), 12) + str(i) + passage[rng.randrange(3) :] + str(rng.random()) + prose(rng.random(), 12)) for i in range(90)]
    assert found(suffixes.dedup(make_docs(rows).repartition(3))) == brute(rows, 50)


def test_several_blocks(make_docs):
    rows = passages(11, 80)
    assert found(suffixes.dedup(make_docs(rows).repartition(7))) == brute(rows, 50)


def test_rows_of_one_id_do_not_clean_each_other(make_docs):
    a, b = prose(1, 80), prose(2, 80)
    rows = [(5, a), (5, b), (5, a + b), (5, a), (9, b), (3, prose(3, 20)), (None, a)]
    got = found(suffixes.dedup(make_docs(rows).repartition(4)))
    assert got == brute(rows, 50)
    assert {(r[0], r[2] > 0) for r in got} == {(3, False), (5, False), (None, False), (9, True)}


def test_spans_are_maximal(make_docs):
    shared, tail = "s" + prose(1, 30) + "s", "t" + prose(9, 30) + "t"
    rows = [(1, shared), (2, tail), (3, "#" * 10 + shared + "!" * 5 + tail)]
    out = {r.doc_id: [(x.begin, x.end) for x in r.spans] for r in suffixes.dedup(make_docs(rows)).collect()}
    a, b = len(shared.encode()), len(tail.encode())
    assert out == {1: [], 2: [], 3: [(10, 10 + a), (15 + a, 15 + a + b)]}


def test_a_very_long_text(make_docs):
    long = prose(5, 150_000)
    rows = [(1, long[500_000:500_300]), (2, long), (3, "=" * 200_000), (4, "=" * 200_000)]
    assert found(suffixes.dedup(make_docs(rows))) == brute(rows, 50)


def test_empty_table(make_docs):
    assert suffixes.dedup(make_docs([])).collect() == []
    assert suffixes.maximal_repeats(make_docs([])).collect() == []


def maximal(texts, size):
    """Strings of at least ``size`` bytes that occur twice and that no byte before or after extends in all places."""
    out = {}
    for length in range(size, max(map(len, texts)) + 1):
        places = {}
        for i, t in enumerate(texts):
            for s in range(len(t) - length + 1):
                places.setdefault(t[s : s + length], []).append((i, s))
        for at in (x for x in places.values() if len(x) > 1):
            before = {texts[i][s - 1 : s] if s else (i, s) for i, s in at}
            after = {texts[i][s + length : s + length + 1] or (i, s) for i, s in at}
            if len(before) > 1 and len(after) > 1:
                out[length, tuple(sorted(at))] = min(i for i, _ in at)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_the_interval_tree_gives_all_maximal_repeats(seed):
    rng = random.Random(seed)
    texts = [bytes(rng.choice(b"ab\0" if seed % 2 else b"abcd") for _ in range(rng.randrange(6, 24))) for _ in range(14)]
    array = suffixes.SuffixArray(texts, np.arange(14), 6, 24)
    got = {}
    for group, suffix, length, least in zip(*(x.tolist() for x in array.occurrences())):
        got.setdefault((group, length, least), []).append((int(array.item[suffix]), int(array.start[suffix])))
    assert {(length, tuple(sorted(at))): least for (_, length, least), at in got.items()} == maximal(texts, 6)


def test_groups_have_all_occurrences(make_docs):
    shared = "<" + prose(1, 14)[:70] + ">"
    rows = [(i, prose(100 + i, 30) + str(i) + shared + str(9 - i) + prose(200 + i, 30)) for i in range(4)]
    groups = {}
    for r in suffixes.maximal_repeats(make_docs(rows)).collect():
        text = dict(rows)[r.doc_id].encode()
        groups.setdefault((r.group, text[r.begin : r.begin + r.length]), set()).add(r.doc_id)
    whole = {text: docs for (_, text), docs in groups.items()}
    assert whole and all(len(text) >= 50 and text in shared.encode() for text in whole)
    assert any(docs == {0, 1, 2, 3} for docs in whole.values())


def test_texts_stay_in_their_blocks(spark, make_docs):
    """Texts are stored once and joined in buckets of the block: no exchange moves them, and what waits has none."""
    rows = [(i, f"{i} " + prose(7, 60) + f" {i} " + prose(300 + i, 60), "en", "a") for i in range(40)]
    repeats = suffixes.Repeats(make_docs(rows).repartition(3), "doc_id", "text", 50, 20)
    assert "text" not in repeats.found.columns and repeats.found.where("open is not null").count() == repeats.blocks.count()
    out = suffixes.dedup(make_docs(rows).repartition(3))
    plan = out._jdf.queryExecution().executedPlan().toString()
    cogroup = plan[plan.index("FlatMapCoGroupsInArrow") :]
    assert "Bucketed: true" in plan and "Exchange" not in cogroup[: cogroup.index("FileScan")]
    assert found(out) == brute(rows, 50)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("suffixes")]
