import random
import time

import pytest
from llm_helpers import pandas_of

from waveline.llm import urlfilter
from waveline.llm.queries import URL_RULES
from waveline.llm.urlfilter import Rule, RuleTrie, split_url


def brute(rules, host, path):
    fits = [r for r in rules if (not r.host or host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return min(fits, key=Rule.rank, default=None)


def test_trie_against_brute_force():
    rng = random.Random(1)
    labels, segments = ["com", "a", "b", "ab", ""], ["", "en", "e", "7", "77", "x"]
    rules = [Rule(rng.choice(["allow", "block"]), ".".join(rng.choice(labels) for _ in range(rng.randrange(4))), "/" + "/".join(rng.choice(segments) for _ in range(rng.randrange(4)))) for _ in range(120)]
    trie = RuleTrie(rules)
    for _ in range(3000):
        host = ".".join(rng.choice(labels) for _ in range(rng.randrange(5)))
        path = "/" + "/".join(rng.choice(segments) for _ in range(rng.randrange(5))) if rng.random() < 0.9 else ""
        assert trie.match(host, path) == brute(rules, host, path), (host, path)


@pytest.mark.parametrize(
    "url,host,path",
    [("http://A.Com/En/7?x#y", "a.com", "/En/7"), (None, "", ""), ("a.com/x", "", ""), ("", "", ""), ("x://", "", ""), ("http://a.com", "a.com", ""), ("http://a.com?/q", "a.com", ""), ("http://a.com#/q?z", "a.com", ""), ("http://ÄB.com/ü", "Äb.com", "/ü"), ("a://b://c/d", "b:", "//c/d")],
)
def test_parts(url, host, path):
    assert split_url(url) == (host, path)


def test_verdicts(make_pages):
    urls = ["http://w.example.com/en/71", "http://w.example.com/en/8", "http://net/de/", "http://x.example.net/de/80", "http://example.net/de/7", "http://org/es/", "http://org/es", "http://notcom/en/", None, "junk"]
    want = ["allow", "block", "allow", "block", "allow", "block", "allow", "allow", "allow", "allow"]
    rows = [(i, u, "h") for i, u in enumerate(urls)] + [(None, urls[1], None), (0, urls[0], "h")]
    out = pandas_of(urlfilter.filter_urls(make_pages(rows), URL_RULES))
    assert len(out) == len(rows)
    first = out[out.doc_id.notna()] if "doc_id" in out else out
    got = {(i, v) for i, v in zip(first.page_id, first.verdict) if i == i}
    assert got == set(enumerate(want))
    assert set(out[out.page_id == 3].rule) == {"example.net/de/8"} and out[out.page_id == 9].rule.isna().all()
    assert urlfilter.filter_urls(make_pages([]), URL_RULES).collect() == []


def test_blocks_of_rules_decide_as_one(make_pages, monkeypatch):
    rng = random.Random(6)
    rules = [Rule(rng.choice(["allow", "block"]), rng.choice(["com", "a.com", "b.a.com"]), "/" + rng.choice(["", "en/", "en/7", "e"])) for _ in range(30)]
    rows = [(i, f"http://{rng.choice(['', 'x.'])}{rng.choice(['com', 'a.com', 'b.a.com', 'org'])}/{rng.choice(['en/77', 'en', 'e', ''])}", "h") for i in range(60)] + [(None, None, None)]
    monkeypatch.setattr(urlfilter, "BLOCK_RULES", 7)
    got = sorted((str(r.page_id), r.rule, r.verdict) for r in urlfilter.filter_urls(make_pages(rows), iter(rules)).collect())
    want = [(str(i), *((r.text, r.action) if (r := brute(rules, *split_url(u))) else (None, "allow"))) for i, u, _ in rows]
    assert got == sorted(want, key=lambda t: t[0])
    assert [r.verdict for r in urlfilter.filter_urls(make_pages(rows[:2]), [], default="block").collect()] == ["block"] * 2


def test_long_segments_take_linear_time():
    trie = RuleTrie([Rule("block", "com", "/" + "a" * k) for k in range(1, 12)])
    began = time.perf_counter()
    for _ in range(20):
        assert trie.match("com", "/" + "a" * 1_000_000).path == "/" + "a" * 11
    assert time.perf_counter() - began < 2


def test_bad_rules():
    with pytest.raises(ValueError):
        RuleTrie([Rule("maybe", "a", "/")])
