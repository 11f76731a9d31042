"""URL filters: a trie over reversed host labels and path segments, longest match first.

A rule is an action, a host and a path. It fits its host and every subdomain, if the URL's
path starts with the rule's path. Of the rules that fit, the longest (characters of host and
path together) decides; of equal ones block does, then the alphabetically first.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waveline.llm.common import checkpoint

#: Rules of one broadcast trie at most, some 1.5 KB each; more rules are several tries, a pass for each.
BLOCK_RULES = 50_000


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str  # with its leading slash

    @property
    def text(self) -> str:
        return self.host + self.path

    def rank(self) -> tuple:
        return (-len(self.text), self.action != "block", self.text)


@dataclass
class _Node:
    labels: dict[str, _Node] = field(default_factory=dict)
    paths: _Path | None = None


@dataclass
class _Path:
    segments: dict[str, _Path] = field(default_factory=dict)
    tails: dict[str, Rule] = field(default_factory=dict)  # unfinished last segments
    lengths: tuple[int, ...] = ()  # that the tails have


class RuleTrie:
    """Hosts by labels from the right, then paths by whole segments, then unfinished segments."""

    def __init__(self, rules: Iterable[Rule]):
        self.root = _Node()
        for rule in rules:
            if rule.action not in ("allow", "block"):
                raise ValueError(f"neither allow nor block: {rule.action}")
            node = self.root
            for label in reversed(rule.host.lower().split(".")) if rule.host else ():
                node = node.labels.setdefault(label, _Node())
            node.paths = at = node.paths or _Path()
            *whole, tail = rule.path.split("/")
            for segment in whole:
                at = at.segments.setdefault(segment, _Path())
            at.tails[tail] = min(rule, at.tails.get(tail, rule), key=Rule.rank)
            if len(tail) not in at.lengths:
                at.lengths = (*at.lengths, len(tail))

    def match(self, host: str, path: str) -> Rule | None:
        """The rule that decides, if any fits."""
        found: list[Rule] = []
        node: _Node | None = self.root
        labels = host.split(".") if host else []
        while node is not None:
            if node.paths is not None:
                self._fit(node.paths, path, found)
            node = node.labels.get(labels.pop()) if labels else None
        return min(found, key=Rule.rank, default=None)

    @staticmethod
    def _fit(at: _Path | None, path: str, found: list[Rule]) -> None:
        start = 0
        while at is not None:
            cut = path.find("/", start)
            segment = path[start:] if cut < 0 else path[start:cut]
            found += [at.tails[segment[:k]] for k in at.lengths if k <= len(segment) and segment[:k] in at.tails]
            at = at.segments.get(segment) if cut >= 0 else None
            start = cut + 1


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for a null URL or one without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    for k, c in enumerate(rest):
        if c in "/?#":
            break
    else:
        k = len(rest)
    host, rest = rest[:k], rest[k:]
    path = rest.split("?", 1)[0].split("#", 1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host) if not host.islower() else host, path


def filter_urls(pages: DataFrame, rules: Iterable[Rule], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every row; a row that no rule fits gets ``default``.

    Null URLs and those without ``://`` have an empty host and path. Repeated rows and null
    ids come back as they went in; an empty table gives none; other columns are ignored.
    """
    kind = pages.select(id_col).schema[0].dataType.simpleString()
    found = pages.select(F.col(id_col), F.col(url_col)).mapInArrow(_split, f"page_id {kind}, host string, path string, rule string, action string")
    rules = iter(rules)
    blocks = 0
    while block := list(islice(rules, BLOCK_RULES)):
        trie = pages.sparkSession.sparkContext.broadcast(RuleTrie(block))
        if blocks:  # one trie at a time in a worker's memory
            found = checkpoint(found)
        blocks += 1

        def run(batches, trie=trie):
            match = trie.value.match
            for batch in batches:
                old = [Rule(a, r, "") if r is not None else None for r, a in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
                best = [min((r for r in (match(h, p), o) if r), key=Rule.rank, default=None) for h, p, o in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), old, strict=True)]
                cols = [pa.array([r and r.text for r in best], pa.string()), pa.array([r and r.action for r in best], pa.string())]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], *cols], batch.schema.names)

        found = found.mapInArrow(run, found.schema)
    return found.select("page_id", "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))


def _split(batches):
    for batch in batches:
        parts = [split_url(u) for u in batch.column(1).to_pylist()]
        none = pa.nulls(len(parts), pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p[0] for p in parts], pa.string()), pa.array([p[1] for p in parts], pa.string()), none, none], ["page_id", "host", "path", "rule", "action"])
