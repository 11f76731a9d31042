import random

import numpy as np
import pytest
from llm_helpers import odd_rows, prose, rows_of

from waveline.llm import decontaminate as D

VOCABULARY = [f"w{i}" for i in range(400)]


def items(n=40, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(VOCABULARY) for _ in range(rng.choice([3, 5, 8, 12, 16, 25, 40, 59])))) for i in range(n)]


def edited(text, edits, rng):
    words = text.split()
    for _ in range(edits):
        k = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[k] = "new" + str(rng.randrange(1000))
        elif kind == 1 and len(words) > 1:
            del words[k]
        else:
            words.insert(k, "ins" + str(rng.randrange(1000)))
    return " ".join(words)


def brute_least(item, text):
    """Sellers' dynamic programming."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (w != x)))
        row = new
    return min(row)


def brute(docs, bench):
    out = set()
    for d, t, *_ in docs:
        for i, b in bench:
            item = D.words_of(b)
            if item and D.words_of(t) and (e := brute_least(item, D.words_of(t))) <= D.most_edits(len(item)):
                out.add((d, i, e))
    return out


def test_edit_distance_is_exact():
    rng = random.Random(2)
    for _ in range(500):
        item = [rng.randrange(4) for _ in range(rng.randrange(1, 80))]
        text = [rng.randrange(4) for _ in range(rng.randrange(0, 90))]
        assert D.least_edits(item, text)[0] == brute_least(item, text)


def test_recall_against_brute_force(spark, make_docs):
    rng, bench = random.Random(3), items()
    docs = odd_rows(50_000)
    for k in range(400):
        i, b = rng.choice(bench)
        e = rng.randrange(D.most_edits(len(b.split())) + 3)
        docs.append((k, f"{prose(k, 20, VOCABULARY)} {edited(b, e, rng)} {prose(k + 1, 20, VOCABULARY)}", "en", "a"))
    docs += [(1000 + k, prose(k + 7, 60, VOCABULARY), "en", "a") for k in range(100)]
    benchmark = spark.createDataFrame([(*b, "clash") for b in bench], "item_id long, text string, doc_id string")
    got = {tuple(r) for r in D.leaks(make_docs(docs), benchmark).select("doc_id", "item_id", "edits").collect()}
    want = brute(docs, bench)
    assert {g[:2] for g in got} <= {w[:2] for w in want}
    assert len({g[:2] for g in got}) >= 0.99 * len({w[:2] for w in want})
    assert len(got & want) >= 0.98 * len(want)


@pytest.mark.parametrize("similarity", [0.5, 0.66])
def test_lower_similarities(similarity):
    """Items may lose every word pair there: all windows are embedded."""
    rng, bench = random.Random(5), items(24, 4)
    index, found, planted = D.Index([(i, D.words_of(t)) for i, t in bench], similarity), 0, 0
    for i, text in bench:
        n = len(D.words_of(text))
        doc = f"{prose(i, 20)} {edited(text, rng.randrange(D.most_edits(n, similarity) + 1), rng)} {prose(i + 500, 20)}"
        got = {t: e for t, e, _ in index.search(doc)}
        want = {t: e for t, (_, b) in enumerate(bench) if (e := brute_least(D.words_of(b), D.words_of(doc))) <= D.most_edits(len(D.words_of(b)), similarity)}
        assert all(want.get(t) == e for t, e in got.items())
        found, planted = found + len(got), planted + len(want)
    assert planted >= 24 and found >= 0.95 * planted
    with pytest.raises(ValueError):
        D.Index([(1, [b"a"])], similarity=0.0)


def test_no_window_near_an_item_is_left_out():
    """Of every leak the window at its best run's start is among those embedded."""
    rng, bench = random.Random(13), items(60, 4)
    index = D.Index([(i, D.words_of(t)) for i, t in bench])
    for k in range(300):
        i, b = rng.choice(bench)
        n = len(b.split())
        before = prose(k, rng.randrange(8), ["aa", "bb", "cc"]).replace(",", "").replace(".", "")
        text = D.words_of(f"{before} {edited(b, rng.randrange(D.most_edits(n) + 1), rng)} {prose(k, rng.randrange(4), ['aa', 'bb'])}")
        codes = np.array([index.vocabulary.get(w, -2) for w in text])
        assert len(D.words_of(before)) in index.windows(codes).get(n, ()), (b, text)


def test_many_starts_at_once(monkeypatch):
    rng, bench = random.Random(17), items(25, 6)
    index = D.Index([(i, D.words_of(t)) for i, t in bench])
    texts = [" ".join(edited(b, rng.randrange(D.most_edits(len(b.split())) + 1), rng) for _, b in rng.sample(bench, 4)) for _ in range(25)]
    whole = [index.search(t) for t in texts]
    monkeypatch.setattr(D, "STARTS", 3)
    assert [index.search(t) for t in texts] == whole and any(whole)
    monkeypatch.setattr(D, "TABLE_BYTES", 0)
    bare = D.Index([(i, D.words_of(t)) for i, t in bench])
    assert bare.bits is None and [bare.search(t) for t in texts] == whole


def test_long_items():
    rng = random.Random(23)
    item = [f"v{rng.randrange(5000)}" for _ in range(3000)]
    index = D.Index([(7, [w.encode() for w in item])])
    changed = [w if rng.random() > 0.1 else "new" for w in item]
    ((_, edits, _),) = index.search(" ".join(["before"] * 50 + changed + ["after"] * 50))
    assert edits == brute_least(item, changed) and not index.search(" ".join(item[:1500]))


def test_exact_and_odd_cases(spark, make_docs):
    bench = [(1, "The quick, brown fox: jumps!"), (2, "the quick brown fox jumps"), (3, None), (4, "..."), (None, "alone here"), (5, "word")]
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    docs = make_docs([(1, "x THE QUICK brown-fox jumps y"), (1, "x THE QUICK brown-fox jumps y"), (2, None), (3, ""), (4, "alone, here"), (None, "a word"), (5, "the quick brown dog jumps"), (6, "nothing")])
    got = rows_of(D.leaks(docs, benchmark), "doc_id", "item_id", "edits")
    assert got == sorted([(1, 1, 0), (1, 1, 0), (1, 2, 0), (1, 2, 0), (4, None, 0), (None, 5, 0), (5, 1, 1), (5, 2, 1)], key=lambda t: tuple((x is None, str(type(x)), x) for x in t))
    assert sorted(str(r.doc_id) for r in D.drop_leaked(docs, benchmark).collect()) == ["2", "3", "6"]
    assert D.drop_leaked(docs, benchmark).columns == docs.columns


def test_blocks_and_empty_tables(spark, make_docs, monkeypatch):
    bench = items(20)
    docs = [(i, b) for i, b in bench]
    whole = spark.createDataFrame(bench, "item_id long, text string")
    one = rows_of(D.leaks(make_docs(docs), whole), "doc_id", "item_id", "edits")
    monkeypatch.setattr(D, "BLOCK_WORDS", 60)
    assert rows_of(D.leaks(make_docs(docs), whole), "doc_id", "item_id", "edits") == one
    assert D.drop_leaked(make_docs(docs), whole).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.leaks(make_docs(docs), none).collect() == [] == D.leaks(make_docs([]), whole).collect()
    assert D.drop_leaked(make_docs(docs), none).count() == len(docs)


def test_embedding_of_near_windows_is_near():
    rng, index = random.Random(5), D.Index([(0, [b"x"])])
    words = [rng.randrange(50) for _ in range(40)]
    other = [*words[:20], 99, *words[21:]]
    stranger = [rng.randrange(100, 150) for _ in range(40)]
    same = lambda a, b: sum(x == y for w in range(8) for x, y in zip(index.walk(a, w), index.walk(b, w)) if x != -1) / (8 * 120)
    assert same(words, words) > same(words, other) > same(words, stranger) + 0.2


@pytest.mark.parametrize("n,e", [(1, 0), (4, 0), (5, 1), (9, 1), (10, 2), (16, 3), (59, 11)])
def test_most_edits(n, e):
    assert D.most_edits(n) == e
