import itertools
import random
import time

import pytest
from llm_helpers import pandas_of

from waveline.llm import extract

ARTICLE = "<h1>A title &amp; more</h1><p>First   paragraph\n with a <a href='/x'>link</a> in it.</p><p><b>Unclosed bold<br><p>Second one, quite a bit longer than the first, to be sure.</p><p>End.</p>"
WANT = "A title & more\nFirst paragraph with a link in it.\nUnclosed bold\nSecond one, quite a bit longer than the first, to be sure.\nEnd."


def page(article=ARTICLE, before="", after=""):
    return f"<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var t='</p>';</script></head><body>{before}<article>{article}</article>{after}</body></html>"


AROUND = [
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>About us</a></li></ul></nav>",
    "<header><h2>The Site Name</h2><p>A long header text that describes the whole site at some length.</p></header>",
    "<aside class='sidebar'><h3>Related</h3><p>Other articles that you may want to read next, at some length.</p></aside>",
    "<div class='cookie-notice'>We use cookies to make this site better for you and for everyone else.</div>",
    "<div id='comments'><h3>2 comments</h3><div class='comment'><p>What a great article, I agree with all of it, every word.</p></div></div>",
    "<form><label>Your email</label><input name='e'><button>Subscribe now</button></form>",
    "<div class='ad banner'>Buy one of these things now, they are cheap and very good indeed.</div>",
    "<footer>&copy; 2024 The Site &middot; All rights reserved by its owners.</footer>",
    "<!-- a comment with <p>markup</p> -->",
    "<noscript>Please turn on scripts.</noscript><div hidden>Unseen</div><div style='display:none'>Unseen</div>",
]


@pytest.mark.parametrize("part", AROUND)
def test_boilerplate_goes_wherever_it_is(part):
    assert extract.main_text(page(before=part)) == WANT
    assert extract.main_text(page(after=part)) == WANT
    if not part.startswith("<header"):  # an article's own header is the article's
        assert extract.main_text(page(ARTICLE + part)) == WANT


def test_all_at_once_and_without_article():
    assert extract.main_text(page(before="".join(AROUND[:5]), after="".join(AROUND[5:]))) == WANT
    plain = f"<html><body>{AROUND[0]}<div class='content'>{ARTICLE}</div>{AROUND[7]}</body></html>"
    assert extract.main_text(plain) == WANT


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def planted(seed):
    """A page of known content: its blocks in order, each with whether it is the article's."""
    rng = random.Random(seed)
    blocks, html = [], []

    def put(tag, text, content, attributes="", link=False):
        blocks.append((text, content))
        html.append(f"<{tag}{attributes}>{f'<a href=x>{text}</a>' if link else text}</{tag}>")

    named = rng.random() < 0.5
    html.append("<nav><ul>" if rng.random() < 0.5 else "<div><ul>")
    closing = "</ul></nav>" if html[-1].startswith("<nav") else "</ul></div>"
    for _ in range(rng.randrange(3, 8)):
        put("li", words(rng, rng.randrange(1, 4)), False, link=True)
    html.append(closing + ("<article>" if named else "<div>"))
    put("h1", words(rng, 6), True)
    last = "linked"
    for _ in range(rng.randrange(4, 12)):
        kind = rng.choice(["long", "long", "short", "linked", "advert"])
        if kind in ("linked", "advert") and last != "long" or last in ("linked", "advert"):
            kind = "long"  # links and adverts stand between long paragraphs
        if kind == "long":
            put("p", words(rng, rng.randrange(70, 120)), True)
        elif kind == "short":
            put("p", words(rng, rng.randrange(1, 4)), True)  # alone it looks like a label
        elif kind == "linked":
            put("p", words(rng, rng.randrange(3, 6)), True, link=True)
        else:
            put("div", words(rng, rng.randrange(5, 20)), False, " class='advert'")
        last = kind
    put("p", words(rng, 70), True)
    html.append("</article>" if named else "</div>")
    html.append("<footer>" if rng.random() < 0.5 else "<div class='footer'>")
    put("p", words(rng, rng.randrange(3, 30)), False)
    html.append("</footer></div>")
    return "<html><body>" + "".join(html) + "</body></html>", blocks


def test_planted_pages_and_what_the_cut_mends():
    """Page texts are those planted; the classifier alone errs on many pages, the cut on none."""
    wrong_alone = 0
    for seed in range(300):
        html, blocks = planted(seed)
        assert extract.main_text(html) == "\n".join(t for t, content in blocks if content), seed
        found = extract.blocks_of(html)
        assert [b.text for b in found] == [t for t, _ in blocks]
        wrong_alone += [b.score > 0 for b in found] != [c for _, c in blocks]
    assert wrong_alone > 100


def brute_labels(blocks):
    """The cheapest labelling of a small page by trying all."""
    edges = extract._edges(blocks)

    def cost(labels):
        return sum(b.score if b.score > 0 and not x else -b.score if b.score < 0 and x else 0 for b, x in zip(blocks, labels)) + sum(w for a, b, w in edges if labels[a] != labels[b])

    best = min(itertools.product([False, True], repeat=len(blocks)), key=cost)
    return list(best)


def test_page_texts_against_all_labellings():
    rng, decided = random.Random(9), 0
    for _ in range(150):
        parts = [rng.choice(["<p>{}</p>", "<div>{}</div>", "<li>{}</li>", "<h2>{}</h2>", "<p><a>{}</a></p>", "<div class='ad'>{}</div>", "<article><p>{}</p></article>", "<aside><p>{}</p></aside>"]).format(words(rng, rng.choice([1, 3, 10, 40]))) for _ in range(rng.randrange(1, 9))]
        blocks = extract.blocks_of("".join(parts))
        best = brute_labels(blocks)
        if any(best):
            assert extract.main_text("".join(parts)) == "\n".join(b.text for b, x in zip(blocks, best) if x)
            decided += best != [b.score > 0 for b in blocks]
    assert decided > 20


@pytest.mark.parametrize("torn", ["<a ", '<a x="', "<svg>", "<div>", "<span>t", "<", "<div hidden>", "<!-- ", "<b><p>t", "</b>", "<a x='\""])
def test_torn_pages_take_linear_time(torn):
    page = torn * (1_000_000 // len(torn))
    began = time.perf_counter()
    extract.main_text(page)
    extract.main_text(page + '">')
    assert time.perf_counter() - began < 8


def test_few_words_are_content_and_an_articles_header_keeps_its_headings():
    assert extract.main_text("just text") == "just text" and extract.main_text("<article><p>Hi</p></article>") == "Hi"
    assert extract.main_text("<nav><a>Home</a></nav>") == ""
    text = "A paragraph that is long enough to be one, with some more words behind it."
    assert extract.main_text(f"<article><header><h1>Title</h1><p>By someone, on some day, in a place</p></header><p>{text}</p></article>") == f"Title\n{text}"
    assert extract.main_text(f"<p>{text}</p><div hidden><p>No</p><div>no</div></div><p>{text}</p>") == f"{text}\n{text}"


def test_blocks():
    text = lambda h: [b.text for b in extract.blocks_of(h)]
    assert text("a<p>b<p>c</p>d") == ["a", "b", "c", "d"]
    assert text("<ul><li>x<li>y</ul><pre> k \n l </pre>") == ["x", "y", "k l"]
    assert text("<p>1 &lt; 2&nbsp;&nbsp;&#51; &#x41; &bogus; AT&T</p>") == ["1 < 2 3 A &bogus; AT&T"]
    assert text("<p title='a>b'>in</p><p") == ["in", "<p"] or text("<p title='a>b'>in</p>") == ["in"]
    assert text("<script>if (a<b) '<p>'</script><p>z") == ["z"]
    assert text("") == [] and text("<!-- open") == []


A, B, C = ("a" * 20 + " one", "b" * 20 + " two", "c" * 20 + " three")


@pytest.mark.parametrize("page,want", [
    (f"<p>{A}</p><p hidden>x<p>{B}</p>", [A, B]),
    (f"<ul><li hidden>x<li>{B}</ul><p>{C}</p>", [B, C]),
    (f"<ul><li>{A}<li hidden>x<ul><li>y<li>z</ul>w<li>{B}</ul><p>{C}", [A, B, C]),
    (f"<ul><li hidden>x</ul><p>{C}", [C]),
    (f"<table><tr><td hidden>x<td>{B}<tr hidden><td>x<td>y<tr><td>{C}</table><p>{A}", [B, C, A]),
    (f"<dl><dt hidden>x<dd>{B}<dd hidden>y<dt>{C}</dl>", [B, C]),
    (f"<p hidden>x<div>{B}</div>", [B]),
    (f"<p hidden>x <b>y</b> <!-- <p> --> z<div>{B}</div>", [B]),
    (f"<div hidden><p>x<p>y<div>z</div><li>w</div><p>{B}", [B]),
    (f"<article><div hidden>x</article><p>{B}", [B]),
    (f"<div><p hidden>x</div><p>{B}", [B]),
    (f'<div hidden title="</div>">x</div><p>{B}', [B]),
    (f"<span hidden>x <span>y</span> z</span><p>{B}", [B]),
    (f"<p>{A}<div hidden>never ends<p>x", [A]),
    (f"<p>{A} <span hidden>x</span> end", [A + " end"]),
    (f"<select hidden><option>x<option>y</select><p>{B}", [B]),
])
def test_hidden_elements_end_where_their_kind_ends(page, want):
    assert [b.text for b in extract.blocks_of(page)] == want


def test_min_cut_against_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randrange(1, 8)
        scores = [rng.choice([-3, -1, -0.5, 0.5, 1, 3]) * rng.random() for _ in range(n)]
        edges = [(a, b, rng.random() * 2) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def cost(labels):
            return sum(s if s > 0 and not x else -s if s < 0 and x else 0 for s, x in zip(scores, labels)) + sum(w for a, b, w in edges if labels[a] != labels[b])

        best = min(cost(labels) for labels in itertools.product([False, True], repeat=n))
        assert cost(extract.min_cut(scores, edges)) == pytest.approx(best)


def test_long_pages_take_linear_time():
    long = "".join(f"<p>Paragraph {i} of a very long page.</p>" for i in range(20_000))
    assert extract.main_text(page(long)).count("\n") == 19_999


def test_table(make_pages):
    rows = [(1, "http://a", page()), (2, None, None), (3, "u", ""), (None, "u", page()), (1, "http://a", page()), (4, "u", "just text, no markup at all here")]
    out = pandas_of(extract.extract(make_pages(rows)))
    assert len(out) == len(rows)
    assert sorted(out.n_chars) == sorted(map(len, out.text))
    assert set(out[out.page_id == 1].text) == {WANT} and set(out[out.page_id.isin([2, 3])].text) == {""}
    assert extract.extract(make_pages([])).collect() == []
