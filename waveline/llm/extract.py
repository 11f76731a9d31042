"""HTML main text: a page's blocks labelled content or boilerplate by a minimum cut.

A page is cut into blocks of text at its block-level tags. A classifier over a block's own
features (length, links, its tag, marks of its surroundings) gives log-odds, which are what it
costs to call it boilerplate (its capacity from the source) or content (to the sink). Blocks
that follow each other are joined by edges that cost when their labels differ, the more the
closer they are in the document tree, and so are the steps of one container; across the border
of an article, or of an element marked as something else, edges are weak. The maximum flow's cut
is the cheapest labelling: a short or linked paragraph amid an article stays with it, and a long
one in a row of links goes with them, though alone each would be taken for the other.

Costs and edges are of one scale, chosen so: only a mark, or a long text, outweighs both
neighbours (two edges of ADJACENT / 2); a long text outweighs a linked one; a mark any length.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter, deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waveline.llm.common import small_batches

#: Kinds of HTML elements.
BLOCK_TAGS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table caption tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT_TAGS = frozenset("script style noscript template iframe svg math canvas object audio video select textarea title datalist".split())
#: Elements whose text never is the article's, and words of class, id or role that say so.
AWAY_TAGS = frozenset("nav footer aside form menu button dialog search".split())
AWAY_WORDS = frozenset("ad ads advert adverts advertisement advertisements adsense banner sponsor sponsored promo promotion promoted cookie cookies consent gdpr notice notices alert popup modal overlay comment comments disqus reply replies respond discussion sidebar side rail menu menubar nav navbar navigation navigator breadcrumb breadcrumbs pagination pager footer foot copyright masthead topbar toolbar header banner social share sharing follow related recommended recommendations more widget widgets newsletter subscribe subscription signup login signin search form contentinfo complementary".split())
NEAR_WORDS = frozenset("article articles content contents main post entry story text body page hentry maincontent".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

_SPECIAL = re.compile("[>\"']")
_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_NAMES = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NO_END = ("p", "li", "dt", "dd", "tr", "td", "th", "option")

#: The classifier's weights, log-odds for content: of any block, a character (up to so many), all
#: its text being links, a heading, a paragraph, another element, a place inside an article, inside
#: an element named like one, and of each mark that it is something else (two count at most).
BIAS, CHARACTER, MOST, LINKS, HEADING, PARAGRAPH, OTHER, INSIDE, NAMED, AWAY = -1.0, 0.01, 500, -3.0, 1.5, 0.5, -0.3, 0.45, 0.45, -8.0
#: The cost of a label change between neighbours, by their distance in the tree; between steps of
#: one container that aren't neighbours; and what is left of the first across a border.
ADJACENT, SIBLING, BORDER = 5.0, 1.0, 0.1
_PARAGRAPHS, _PLAIN = frozenset("p blockquote pre figcaption".split()), frozenset("li dd dt td th".split())


@dataclass
class Block:
    text: str
    score: float
    holder: int  # the container's number
    distance: int  # steps in the tree from the block before
    side: tuple[bool, int]  # inside an article; marks of something else
    links: float  # share of the text


class _Open:
    __slots__ = ("tag", "number", "away", "inside", "named", "lead", "depth")

    def __init__(self, tag, number, away, inside, named, lead, depth):
        self.tag, self.number, self.away, self.inside, self.named, self.lead, self.depth = tag, number, away, inside, named, lead, depth


def _opened(tag: str, attributes: str, number: int, above: _Open | None) -> _Open | None:
    """An element with what it inherits: marks, inside an article, named like one, an article's own header; None if it isn't shown."""
    away, inside, named, lead, depth = (above.away, above.inside, above.named, above.lead, above.depth) if above else (0, False, False, False, 0)
    if tag == "header" and inside:
        lead = True
    elif tag in AWAY_TAGS or tag == "header":
        away += 1
    inside = inside or tag in ("article", "main")
    if attributes:
        for m in _NAMES.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return None
            if name in ("class", "id", "role"):
                words = {w.lower() for w in _WORDS.findall(value)}
                if tag in ("html", "body"):
                    continue
                if words & NEAR_WORDS and not words & AWAY_WORDS:
                    named = True
                elif words & AWAY_WORDS and not (tag in HEADINGS or tag in ("article", "main") or words & NEAR_WORDS and words & {"header", "page"}):
                    away += 1
    return _Open(tag, number, away, inside, named, lead, depth + (tag in BLOCK_TAGS))


class _Ends:
    """Where tags end: the next ``>`` outside quotes. Linear over a page, whatever it is torn like."""

    def __init__(self, page: str):
        self.page, self.known = page, {}
        self.places = [m.start() for m in _SPECIAL.finditer(page)]
        self.close, last = [0] * len(self.places), {}
        for k in range(len(self.places) - 1, -1, -1):  # of each quote the next like it, by its place in the list
            c = page[self.places[k]]
            self.close[k] = last.get(c, -1)
            last[c] = k

    def of(self, at: int) -> int:
        """The place of the end of a tag whose attributes begin at ``at``; -1 if there is none. A
        quote that never closes is no quote."""
        k, path = bisect_left(self.places, at), []
        while k not in self.known:
            path.append(k)
            if k >= len(self.places) or self.page[self.places[k]] == ">":
                self.known[k] = self.places[k] if k < len(self.places) else -1
            elif self.close[k] < 0:
                k += 1
            else:
                k = self.close[k] + 1
        for x in path:
            self.known[x] = self.known[k]
        return self.known[k]


def blocks_of(page: str) -> list[Block]:
    """The page's blocks of text in order, white space single, character references decoded."""
    out: list[Block] = []
    stack: list[_Open] = []
    parts: list[str] = []
    open_tags: Counter = Counter()
    ends, unclosed = None, set()
    linked = number = at = in_link = low = hidden = 0
    n = len(page)

    def end_block() -> None:
        nonlocal linked, low
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                top = stack[-1] if stack else None
                tags = {e.tag for e in stack[-3:]}
                score = BIAS + CHARACTER * min(len(text), MOST) + LINKS * min(1.0, linked / len(text))
                score += HEADING if tags & HEADINGS else PARAGRAPH if tags & _PARAGRAPHS else 0.0 if tags & _PLAIN else OTHER
                away, inside, depth = (top.away + (top.lead and not tags & HEADINGS), top.inside, top.depth) if top else (0, False, 0)
                score += INSIDE * inside + NAMED * (top is not None and top.named) + AWAY * min(away, 2)
                box = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].tag in BLOCK_TAGS), 0)
                holder = stack[box - 1].number if box else 0
                steps = max(1, depth_of[0] + depth - 2 * min(low, depth)) if out else 0
                out.append(Block(text, score, holder, steps, (inside, away), min(1.0, linked / len(text))))
                depth_of[0] = low = depth
        linked = 0

    depth_of = [0]

    def pop_to(k: int) -> None:
        nonlocal in_link, hidden, low
        for e in stack[k:]:
            open_tags[e.tag] -= 1
            in_link -= e.tag == "a"
        del stack[k:]
        low = min(low, stack[-1].depth if stack else 0)

    def say(text: str) -> None:
        nonlocal linked
        if text:
            text = entities.unescape(text) if "&" in text else text
            parts.append(text)
            if in_link:
                linked += len(text.strip())

    def skip(tag: str, at: int) -> int:
        """The end of an element that isn't shown; ``at`` if it never ends."""
        if tag in unclosed:
            return at
        close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
        if close is None:
            unclosed.add(tag)
            return at
        return close.end()

    while at < n:
        start = page.find("<", at)
        if start < 0:
            break
        if page.startswith("<!--", start):
            say(page[at:start])
            end = page.find("-->", start + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith("<![CDATA[", start):
            end = page.find("]]>", start)
            say(page[at:start])
            say(page[start + 9 : n if end < 0 else end])
            at = n if end < 0 else end + 3
            continue
        m = _TAG.match(page, start + 1)
        marked = m is not None or page[start + 1 : start + 2] in ("!", "?", "/")
        if marked and ends is None:
            ends = _Ends(page)
        end = ends.of(m.end() if m else start + 1) if marked else -1
        if end < 0:  # a bare sign, or a tag that is torn off
            say(page[at : start + 1])
            at = start + 1
            continue
        say(page[at:start])
        at = end + 1
        if m is None:
            continue
        tag, attributes = m[2].lower(), page[m.end() : end]
        if m[1]:
            if tag in BLOCK_TAGS:
                end_block()
            elif tag == "br":
                parts.append(" ")
            if open_tags[tag]:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag == tag:
                        pop_to(k)
                        break
                    if tag not in BLOCK_TAGS and stack[k].tag in BLOCK_TAGS:
                        break  # an inline end tag doesn't close blocks
            continue
        if tag in SILENT_TAGS:
            if not attributes.endswith("/"):
                after = skip(tag, at)
                at = after if after > at else n if tag in ("script", "style") else at
            continue
        if tag in BLOCK_TAGS:
            end_block()
            # A paragraph ends at the next block; an item at the next of its kind.
            for k in range(len(stack) - 1, -1, -1):
                open_tag = stack[k].tag
                if open_tag == "p" or open_tag == tag and tag in _NO_END:
                    pop_to(k)
                    break
                if open_tag in BLOCK_TAGS:
                    break
        elif tag == "br":
            parts.append(" ")
        if tag not in VOID_TAGS and not attributes.endswith("/"):
            number += 1
            element = _opened(tag, attributes, number, stack[-1] if stack else None)
            if element is None:  # not shown: up to its own end tag
                at = _past(page, tag, at, ends, open_tags)
                continue
            stack.append(element)
            open_tags[tag] += 1
            in_link += tag == "a"
    say(page[at:])
    end_block()
    return out


#: Fixed values of the format: what ends an element without an end tag, besides what it is in.
_ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "thead", "tfoot"}, "td": {"td", "th", "tr", "tbody", "thead", "tfoot"}, "th": {"td", "th", "tr", "tbody", "thead", "tfoot"}, "option": {"option"}}
_ANY_TAG = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s/>]*))")


def _past(page: str, tag: str, at: int, ends: _Ends, around: Counter) -> int:
    """Where a hidden element ends: at its end tag, where its kind ends without one, where an
    element that it is in (``around``) ends; else at the page's end."""
    inside: list[str] = []
    while m := _ANY_TAG.search(page, at):
        if m[2] is None:
            end = page.find("-->", m.end())
            at = len(page) if end < 0 else end + 3
            continue
        end = ends.of(m.end())
        if end < 0:
            return len(page)
        at, name = end + 1, m[2].lower()
        if m[1]:
            if name in inside:
                del inside[len(inside) - 1 - inside[::-1].index(name) :]
            elif name == tag:
                return at
            elif name in BLOCK_TAGS and around[name]:
                return m.start()
            continue
        if name in BLOCK_TAGS:
            while inside and (inside[-1] == "p" or name in _ENDED_BY.get(inside[-1], ())):
                inside.pop()
            if not inside and (tag == "p" or name in _ENDED_BY.get(tag, ())):
                return m.start()
        elif name == "option" == tag and not inside:
            return m.start()
        if (name in BLOCK_TAGS or name == tag) and name not in VOID_TAGS and page[end - 1] != "/":
            inside.append(name)
    return len(page)


def _edges(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Neighbours, nearer in the tree costing more and little across a border; and steps of one
    container with something else between them."""
    out, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            weight = ADJACENT / max(2, b.distance)
            out.append((i - 1, i, weight if blocks[i - 1].side == b.side else weight * BORDER))
        k = last.get((b.holder, b.side), i)
        if k < i - 1:
            out.append((k, i, SIBLING))
        last[b.holder, b.side] = i
    return out


def min_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source: a node costs ``score`` if it doesn't (or ``-score`` if it does), an edge its weight if its ends part.

    Dinic's maximum flow: the terminals' capacities are netted, then blocking flows along
    shortest paths, without recursion.
    """
    n = len(scores)
    supply = [max(0.0, s) for s in scores]
    demand = [max(0.0, -s) for s in scores]
    to: list[int] = []
    room: list[float] = []
    arcs: list[list[int]] = [[] for _ in range(n)]
    for a, b, w in edges:
        arcs[a].append(len(to))
        to.append(b)
        room.append(w)
        arcs[b].append(len(to))
        to.append(a)
        room.append(w)
    tiny = 1e-12
    while True:
        level = [0 if s > tiny else -1 for s in supply]
        queue = deque(i for i in range(n) if level[i] == 0)
        reached = False
        while queue:
            i = queue.popleft()
            reached = reached or demand[i] > tiny
            for e in arcs[i]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not reached:
            return [x >= 0 for x in level]
        next_arc = [0] * n
        for source in range(n):
            while supply[source] > tiny:
                path, i = [], source
                while demand[i] <= tiny:
                    while next_arc[i] < len(arcs[i]):
                        e = arcs[i][next_arc[i]]
                        if room[e] > tiny and level[to[e]] == level[i] + 1:
                            break
                        next_arc[i] += 1
                    else:
                        if not path:
                            break
                        i = to[path.pop() ^ 1]
                        next_arc[i] += 1
                        continue
                    path.append(e)
                    i = to[e]
                if demand[i] <= tiny:
                    break
                flow = min([supply[source], demand[i], *(room[e] for e in path)])
                supply[source] -= flow
                demand[i] -= flow
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow


def labels(blocks: list[Block]) -> list[bool]:
    """Which blocks are content, by the minimum cut. Where it leaves none (a page of a few words),
    the blocks without a mark, and not mostly links, are."""
    out = min_cut([b.score for b in blocks], _edges(blocks))
    return out if any(out) else [not b.side[1] and b.links < 0.5 for b in blocks]


def main_text(page: str | None) -> str:
    """The article's blocks, joined by newlines; empty if there are none."""
    blocks = blocks_of(page or "")
    return "\n".join(b.text for b, content in zip(blocks, labels(blocks), strict=True) if content)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row; a null html has an empty text.

    Torn or nested markup is read as far as it goes. Repeated rows and null ids come back as
    they went in; an empty table gives none; other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64(), size=len(texts))], ["page_id", "url", "text", "n_chars"])

    kinds = [f.dataType.simpleString() for f in pages.select(id_col, url_col).schema.fields]
    return small_batches(pages).select(F.col(id_col), F.col(url_col), F.col(html_col)).mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
