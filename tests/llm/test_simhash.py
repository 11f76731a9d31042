import random

import numpy as np
import xxhash
from llm_helpers import odd_rows, prose, rows_of

from waveline.llm import simhash
from waveline.llm.components import connected_components, joined_components


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\r\x0b\x0c" else c for c in lower).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hashes) * 2 > len(hashes))


def brute(rows):
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    part = list(range(len(rows)))

    def find(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                part[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], f"{fp:016x}", least.get(find(i))) for i, (r, fp) in enumerate(zip(rows, fps))]


def same(df, rows):
    assert rows_of(df, "doc_id", "fingerprint", "component_id") == sorted(brute(rows), key=lambda t: tuple((x is None, str(type(x)), x) for x in t))


def near_copies(n, seed=1):
    rng, base, out = random.Random(seed), prose(seed, 200).split(), []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = rng.choice("abc") + str(i)
        out.append((100 + i, " ".join(words), "en", "a"))
    return out


def test_against_brute_force(make_docs):
    rows = odd_rows() + near_copies(60) + [(500 + i, prose(i, 30), "en", "a") for i in range(40)]
    same(simhash.near_duplicates(make_docs(rows)), rows)


def test_long_lists_take_the_linear_path(make_docs):
    rows = near_copies(80, 3)
    same(simhash.near_duplicates(make_docs(rows), max_list=2), rows)


def test_links_at_every_distance(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = base + [b ^ 1 << rng.randrange(64) for b in base] + [b ^ 1 << i ^ 1 << j for b in base for i, j in [rng.sample(range(64), 2)]] + [b ^ 7 << 20 for b in base]
    fps = list({f - (1 << 64) if f >> 63 else f for f in fps})
    wanted = {frozenset((a, b)) for a in fps for b in fps if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    for max_list in (64, 1):
        got = {frozenset((r.a, r.b)) for r in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp bigint"), max_list=max_list).collect()}
        assert got == wanted if max_list == 64 else got <= wanted


def test_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).collect() == []
    assert simhash.keep_one(make_docs([])).collect() == []


def test_keep_one_keeps_columns_and_one_of_each_group(make_docs):
    rows = near_copies(30, 7) + odd_rows()
    docs = make_docs(rows)
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    kept = {c for i, _, c in brute(rows) if i is not None}
    assert {r.doc_id for r in out.collect()} == kept | {None}


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(200 + rng.randrange(50), 200 + rng.randrange(50)) for _ in range(60)] + [(7, 7), (None, 1)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    part = {x: x for e in edges for x in e if x is not None and e[0] != e[1] and None not in e}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            part[y] = x
    assert got == {x: find(x) for x in part}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_and_more_edges(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(25)]
    more = [(rng.randrange(80), rng.randrange(80)) for _ in range(15)]
    make = lambda e: spark.createDataFrame(e, "a long, b long")
    known = connected_components(make(edges))
    got = {r.node: r.component for r in joined_components(known, make(more)).collect()}
    want = {r.node: r.component for r in connected_components(make(edges + more)).collect()}
    alone = {x for e in more if e[0] == e[1] for x in e}
    assert {k: v for k, v in got.items() if k in want} == want and set(got) - set(want) <= alone
    assert {r.node: r.component for r in joined_components(known, make([])).collect()} == {r.node: r.component for r in known.collect()}


def word_sets(rows, n=5):
    out = []
    for _, text, *_ in rows:
        w = (text or "").lower().split()
        out.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    return out


def brute_similar(rows, close=None):
    """(doc_id, component_id) by comparing all pairs' sets of five words."""
    sets, part = word_sets(rows), list(range(len(rows)))

    def find(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                part[find(i)] = find(j)
                if close is not None:
                    close.append((i, j))
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], least.get(find(i))) for i, r in enumerate(rows)]


def test_similar_against_brute_force_jaccard(make_docs):
    """Groups of one base each, at every similarity around 0.8; a fingerprint's two bits miss most."""
    rng, rows = random.Random(11), odd_rows(90_000)
    for g in range(40):
        base = [f"{rng.randrange(3000)}w" for _ in range(rng.randrange(60, 160))]
        for k in range(6):
            words = list(base)
            for at in rng.sample(range(len(words)), rng.randrange(0, 1 + len(words) // 18)):
                words[at] = f"x{g}-{k}-{at}"
            rows.append((10 * g + k, " ".join(words), "en", "a"))
    close = []
    want = sorted(brute_similar(rows, close), key=str)
    docs = make_docs(rows)
    assert sorted(((r.doc_id, r.component_id) for r in simhash.similar(docs, 5, 0.8).collect()), key=str) == want
    assert sorted(str(r.doc_id) for r in simhash.keep_one(docs, shingle=5, similarity=0.8).collect()) == sorted(str(i) for i, c in want if i is None or i == c)
    fps = [simhash.fingerprint((r[1] or "").encode()) for r in rows]
    assert len(close) > 50 and sum((fps[i] ^ fps[j]).bit_count() <= 2 for i, j in close) < len(close) / 2
    assert simhash.similar(make_docs([]), 5, 0.8).collect() == []


def test_large_groups_just_below_the_similarity(make_docs, monkeypatch):
    """Lists of many members that their smallest isn't similar to: compared in small blocks, all links found."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng, base = random.Random(21), [f"b{i}" for i in range(120)]
    rows = []
    for k in range(110):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.randrange(1, 5)):
            words[at] = f"x{k}-{at}"
        rows.append((k, " ".join(words), "en", "a"))
    close = []
    want = sorted(brute_similar(rows, close), key=str)
    assert 5 < len({c for _, c in want}) < 100 and 100 < len(close) < 4000
    assert sorted(((r.doc_id, r.component_id) for r in simhash.similar(make_docs(rows), 5, 0.8).collect()), key=str) == want


def test_packed_sets_come_back():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 700):
        own = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        assert np.array_equal(simhash.unpack_set(simhash.pack_set(own)), own >> np.uint64(24))


def test_common_counts():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40)).astype(np.uint64)) for _ in range(12)]
    got = simhash.common_counts(sets[:5], sets[5:])
    assert got.tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in sets[5:]] for a in sets[:5]]


def test_pipeline_stage_drops_copies_at_five_words_and_eight_tenths(spark, make_docs):
    import corpus_pipeline

    words = prose(5, 200, [f"w{i}" for i in range(900)]).split()
    near, far = list(words), list(words)
    for k in range(3):
        near[20 + 50 * k] = f"n{k}"
    for k in range(10):
        far[5 + 18 * k] = f"f{k}"
    docs = make_docs([(1, " ".join(words), "en", "a"), (2, " ".join(near), "en", "a"), (3, " ".join(far), "en", "a")])
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()} == {1, 3}
