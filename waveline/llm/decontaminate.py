"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edits.

Texts and items are words (lower case, ASCII punctuation dropped). An item of n words leaks into
a text if some run of the text's words is at ``n - ceil(similarity * n)`` word edits from it or
fewer.

The Chowdhury-Goldenberg-Koucky random walk copies a word sequence into 3n positions, staying
on a word or stepping on by a random bit of (position, word): few edits become few differing
positions. Each repetition samples some positions of one walk as a bucket key; item-sized windows
that fall into an item's bucket in any repetition are candidates, and the exact edit distance of
the item to the text around the window decides. The number of repetitions follows from the
target recall and the agreement expected at the similarity wanted.

Item-sized windows of every start are candidates for embedding, but for those that cannot be near
an item of their length: e edits spare all but 2e of an item's word pairs, and a window that is
e words too short misses e more. Of any 3e + k of an item's pairs (its rarest are taken) a window
near it has k, so windows that have so many of no item are left out, without loss. (Where an item
has no more than 3e pairs, as short ones at low similarities, every window is embedded.) Items that
allow no edits are found by their whole word sequence. Walks of one start are the same for all
lengths, so a start is embedded once, many at a time in numpy.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waveline.llm.common import small_batches

SIMILARITY, RECALL = 0.8, 0.99
#: LSH: walks, positions sampled by a key, agreement of positions expected at the similarity wanted.
WALKS, SAMPLED, AGREEMENT = 8, 3, 0.45
#: Words of one broadcast index at most, some 300 bytes each; a larger benchmark is several indexes, a pass for each.
BLOCK_WORDS = 200_000
#: Starts of a text that are embedded at once, and steps of all of them; bytes of the walks' bits
#: that an index holds at most, beyond which each text makes its own.
STARTS, PLACES, TABLE_BYTES = 1024, 1 << 18, 32 << 20
#: Word pairs that a window must share, at most, to be embedded.
SHARED = 3
_PAD, _OTHER = -1, -2
_PUNCTUATION = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_PUNCTUATION).split()


def most_edits(n: int, similarity: float = SIMILARITY) -> int:
    return n - math.ceil(similarity * n - 1e-9)


def agreement_at(similarity: float) -> float:
    """Agreement of positions expected at a similarity: less than ``AGREEMENT`` below 0.8, more edits put walks out of step."""
    return AGREEMENT if similarity >= SIMILARITY else max(0.12, AGREEMENT - 1.1 * (SIMILARITY - similarity))


def repetitions(recall: float = RECALL, sampled: int = SAMPLED, agreement: float = AGREEMENT) -> int:
    """Repetitions that find a pair with the agreement given with at least the recall wanted."""
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement**sampled))


def least_edits(item: list[int], text: list[int]) -> tuple[int, int]:
    """The least word edits between an item and any run of a text, and where that run ends.

    Bit-parallel dynamic programming (Myers): one step a text word.
    """
    m = len(item)
    places: dict[int, int] = defaultdict(int)
    for i, w in enumerate(item):
        places[w] |= 1 << i
    mask, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = mask, 0, m
    best, end = m, 0
    for j, w in enumerate(text):
        x = places.get(w, 0) | down
        same = ((up + (x & up)) ^ up) | x
        right_up, right_down = down | ~(up | same), up & same
        if right_up & high:
            score += 1
        elif right_down & high:
            score -= 1
        x = right_up << 1
        down = x & same & mask
        up = ((right_down << 1) | ~(x | same)) & mask
        if score < best:
            best, end = score, j + 1
    return best, end


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words without visible order."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _numbers(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.int64).view(np.uint64)


def _runs(codes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n word numbers."""
    out = np.zeros(max(0, len(codes) - n + 1), np.uint64)
    for k in range(n):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + _numbers(codes[k : k + len(out)]) + np.uint64(1))
    return out


def _among(values: np.ndarray, sought: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(sought):
        return np.zeros(len(values), bool)
    place = np.searchsorted(sought, values)
    place[place == len(sought)] = 0
    return sought[place] == values


def walk_bits(words: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The random bits of these steps (rows) and word numbers: a bit of the byte for each walk."""
    step = steps.astype(np.uint64)[:, None] * np.uint64(0xC2B2AE3D27D4EB4F)
    return (_mix(_numbers(words) * np.uint64(0x9E3779B97F4A7C15) + step) >> np.uint64(64 - WALKS)).astype(np.uint8)


def walks(codes: np.ndarray, starts: np.ndarray, steps: int, table: np.ndarray | None = None) -> np.ndarray:
    """CGK embeddings: how far each walk from each start has come, by step (steps by starts by walks).

    ``table`` has the bits of all steps and word numbers, unknown words last; without one, those
    of the text's own words are made.
    """
    own = np.append(codes, _OTHER)  # what is behind the end is as unknown words are
    if table is None:
        words, own = np.unique(own, return_inverse=True)
    else:
        own = np.where(own < 0, table.shape[1] - 1, own)
    at = np.repeat(starts[:, None], WALKS, axis=1)
    out = np.empty((steps, len(starts), WALKS), np.int64)
    shift = np.arange(WALKS, dtype=np.uint8)
    for j in range(steps):
        out[j] = at
        bits = walk_bits(words, np.array([j]))[0] if table is None else table[j]
        at += (bits[own[np.minimum(at, len(codes))]] >> shift) & 1
    return out - starts[:, None]


class Index:
    """Items of one block: their word pairs, and their buckets in every repetition."""

    def __init__(self, items: list[tuple[object, list[bytes]]], similarity: float = SIMILARITY, recall: float = RECALL):
        if not 0 < similarity <= 1:
            raise ValueError(f"similarity must be over 0 and at most 1, not {similarity}")
        self.ids = [i for i, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        self.items = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for _, words in items]
        self.edits = [most_edits(len(x), similarity) for x in self.items]
        self.reps = repetitions(recall, agreement=agreement_at(similarity))
        words, steps = len(self.vocabulary), 3 * max(map(len, self.items), default=0)
        self.bits = walk_bits(np.append(np.arange(words), _OTHER), np.arange(steps)) if words * steps <= TABLE_BYTES else None
        by_words: dict[tuple, int] = {}
        self.same: dict[int, list[int]] = defaultdict(list)  # items of the same words share all buckets
        for t, words in enumerate(self.items):
            self.same[by_words.setdefault(tuple(words), t)].append(t)
        by_length: dict[int, list[int]] = defaultdict(list)
        for t in by_words.values():
            by_length[len(self.items[t])].append(t)
        self.lengths = {n: most_edits(n, similarity) for n in sorted(by_length)}
        self.sampled = {n: np.random.default_rng(n).integers(0, 3 * n, (self.reps, SAMPLED)) for n, e in self.lengths.items() if e}
        self._pairs([t for n, e in self.lengths.items() if e for t in by_length[n]])
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # of each length the sorted keys, and the items they are of
        for n, ts in by_length.items():
            of = [self.keys(np.array(self.items[t]), np.zeros(1, np.int64), n).ravel() for t in ts]
            keys = np.concatenate(of)
            order = np.argsort(keys, kind="stable")
            self.tables[n] = keys[order], np.repeat(np.array(ts), [len(k) for k in of])[order]

    def _pair_codes(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of the pairs of known words that follow each other."""
        known = codes >= 0
        at = np.flatnonzero(known[:-1] & known[1:])
        return at, codes[at].astype(np.int64) * len(self.vocabulary) + codes[at + 1]

    def _pairs(self, ts: list[int]) -> None:
        """The word pairs looked for, in order, and the items each is of.

        An item whose pairs can all be gone at its edits is looked for in every window of its length.
        """
        self.every = {len(self.items[t]) for t in ts if len(self.items[t]) - 1 <= 3 * self.edits[t]}
        ts = [t for t in ts if len(self.items[t]) not in self.every]
        none = np.empty(0, np.int64)
        own = [np.unique(self._pair_codes(np.array(self.items[t]))[1], return_counts=True) for t in ts]
        found, n = np.unique(np.concatenate([none, *[x for x, _ in own]]), return_counts=True)
        self.shared, pairs, of = np.zeros(len(self.items), np.int64), [], []
        for t, (x, times) in zip(ts, own, strict=True):
            order = np.argsort(n[np.searchsorted(found, x)], kind="stable")
            so_far, e = np.cumsum(times[order]), self.edits[t]
            take = int(np.searchsorted(so_far, min(len(self.items[t]) - 1, 3 * e + SHARED))) + 1
            self.shared[t] = so_far[take - 1] - 3 * e
            pairs.append(x[order[:take]])
            of.append(np.full(take, t))
        pairs, of = np.concatenate([none, *pairs]), np.concatenate([none, *of])
        order = np.argsort(pairs, kind="stable")
        self.pairs, first = np.unique(pairs[order], return_index=True)
        self.pair_ends, self.pair_items = np.append(first, len(order)), of[order]
        self.sizes = np.array([len(x) for x in self.items], np.int64)

    def keys(self, codes: np.ndarray, starts: np.ndarray, n: int, paths: np.ndarray | None = None) -> np.ndarray:
        """Bucket keys of the windows of n words from these starts: a row of each, one in every
        repetition; or just the whole sequence's, where an item of n words allows no edits."""
        if not self.lengths[n]:
            return _runs(codes, n)[starts][:, None]
        paths = walks(codes, starts, 3 * n, self.bits) if paths is None else paths
        place = self.sampled[n]
        walk = np.arange(self.reps)[:, None] % WALKS
        come = paths[place[None], np.arange(len(starts))[:, None, None], walk[None]]
        at = starts[:, None, None] + come
        words = np.where((come < n) & (at < len(codes)), np.append(codes, _PAD)[np.minimum(at, len(codes))], np.where(come < n, _OTHER, _PAD))
        key = _mix(np.arange(self.reps, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n))[None]
        for k in range(SAMPLED):
            key = _mix(key * np.uint64(0xC2B2AE3D27D4EB4F) + _numbers(words[:, :, k]))
        return key

    def walk(self, words: list[int], walk: int) -> list[int]:
        """One embedding of a whole sequence into three times its length."""
        codes = np.array(words)
        return [int(np.append(codes, _PAD)[min(i, len(codes))]) for i in walks(codes, np.zeros(1, np.int64), 3 * len(codes))[:, 0, walk]]

    def windows(self, codes: np.ndarray) -> dict[int, np.ndarray]:
        """Of each item length the starts of the windows that can be near such an item."""
        out, total = {}, len(codes)
        for n, e in self.lengths.items():
            if not e and total >= n and len(found := np.flatnonzero(_among(_runs(codes, n), self.tables[n][0]))):
                out[n] = found
        at, pairs = self._pair_codes(codes)
        met = np.flatnonzero(_among(pairs, self.pairs))
        if len(met):
            at, place = at[met], np.searchsorted(self.pairs, pairs[met])
            many = self.pair_ends[place + 1] - self.pair_ends[place]
            item = self.pair_items[np.repeat(self.pair_ends[place] - np.cumsum(many) + many, many) + np.arange(many.sum())]
            # Of each item the places of its pairs in order; as many as it takes inside one window.
            at = np.repeat(at, many)
            order = np.lexsort((at, item))
            item, at = item[order], at[order]
            k = self.shared[item]
            last = np.arange(len(item)) + k - 1
            ok = last < len(item)
            ok[ok] = (item[last[ok]] == item[ok]) & (at[last[ok]] - at[ok] <= self.sizes[item[ok]] - 2)
            first, upto, n = at[last[ok]], at[ok], self.sizes[item[ok]]
            for size in np.unique(n).tolist():
                mine = n == size
                lo, hi = np.maximum(0, first[mine] - size + 2), upto[mine] + 1
                spans = np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo) + np.arange((hi - lo).sum())
                out[size] = np.unique(spans)
        return out | {n: np.arange(total) for n in self.every if total}

    def search(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item's place, edits, end) of every item that leaks into a text, at its fewest edits."""
        words = words_of(text)
        if not words:
            return []
        get = self.vocabulary.get
        codes = np.fromiter((get(w, _OTHER) for w in words), np.int64, len(words))
        best: dict[int, tuple[int, int]] = {}
        windows = self.windows(codes)
        walked = [starts for n, starts in windows.items() if self.lengths[n]]
        every = np.unique(np.concatenate(walked)) if walked else np.empty(0, np.int64)
        steps = 3 * max((n for n in windows if self.lengths[n]), default=0)
        once = max(1, min(STARTS, PLACES // max(1, steps)))
        for lo in range(0, max(1, len(every)), once):
            part = every[lo : lo + once]
            paths = walks(codes, part, steps, self.bits) if len(part) else None
            for n, starts in windows.items():
                if self.lengths[n]:
                    here = np.flatnonzero(_among(part, starts))
                    if not len(here):
                        continue
                    keys, starts = self.keys(codes, part[here], n, paths[: 3 * n, here]), part[here]
                elif lo:
                    continue
                else:
                    keys = self.keys(codes, starts, n)
                self._candidates(codes, starts, n, keys, best)
        return [(t, *found) for first, found in sorted(best.items()) for t in self.same[first]]

    def _candidates(self, codes: np.ndarray, starts: np.ndarray, n: int, keys: np.ndarray, best: dict[int, tuple[int, int]]) -> None:
        """Verify the items whose buckets the windows fall into; ``best`` keeps each one's fewest edits."""
        table, items = self.tables[n]
        rows, cols = np.nonzero(_among(keys.ravel(), table).reshape(keys.shape))
        if not len(rows):
            return
        met = keys[rows, cols]
        lo, hi = np.searchsorted(table, met), np.searchsorted(table, met, "right")
        of = items[np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo) + np.arange((hi - lo).sum())]
        at = np.repeat(starts[rows], hi - lo)
        order = np.lexsort((at, of))
        of, at = of[order], at[order]
        # Windows that overlap are verified as one stretch of the text.
        cut = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (at[1:] - at[:-1] > n))))
        e = self.lengths[n]
        for first, last in zip(cut.tolist(), np.append(cut[1:], len(of)).tolist(), strict=True):
            t, begin = int(of[first]), max(0, int(at[first]) - e)
            edits, end = least_edits(self.items[t], codes[begin : int(at[last - 1]) + n + e].tolist())
            if edits <= e and (edits, begin + end) < best.get(t, (e + 1, 0)):
                best[t] = edits, begin + end


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, similarity: float, recall: float) -> Iterator[Index]:
    """Indexes of at most BLOCK_WORDS words each; items come to the driver one partition at a time."""
    held: list[tuple[object, list[bytes]]] = []
    n = 0
    for item, text in benchmark.select(item_col, text_col).toLocalIterator():
        words = words_of(text)
        if not words:
            continue
        if held and n + len(words) > BLOCK_WORDS:
            yield Index(held, similarity, recall)
            held, n = [], 0
        held.append((item, words))
        n += len(words)
    if held:
        yield Index(held, similarity, recall)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """``(doc_id, item_id, edits, item_words, end_word)``: a row for each item that leaks into a row.

    Whole texts are searched. A null or wordless text or item has no leaks; equal items are
    each named; repeated rows are each reported and null ids stay null. Empty tables give no
    rows; other columns are ignored. Below 0.8 the repetitions grow with what edits leave in
    step, and items that may lose all their word pairs are looked for in every window.
    """
    kinds = docs.select(id_col).schema[0].dataType, benchmark.select(item_col).schema[0].dataType
    schema = f"doc_id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, edits int, item_words int, end_word bigint"
    out = None
    for index in _blocks(benchmark, item_col, item_text_col, similarity, recall):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            from pyspark.sql.pandas.types import to_arrow_type

            index = shared.value
            for batch in batches:
                rows = [(i, index.ids[t], edits, len(index.items[t]), end) for i, text in enumerate(batch.column(1).to_pylist()) for t, edits, end in index.search(text)]
                types = [to_arrow_type(kinds[1]), pa.int32(), pa.int32(), pa.int64()]
                cols = [pa.array([r[k + 1] for r in rows], t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())), *cols], ["doc_id", "item_id", "edits", "item_words", "end_word"])

        found = small_batches(docs).select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def drop_leaked(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows into which any item leaks, in one pass for each block and without a join.

    Null and wordless texts stay, as do all rows if there are no items; rows with a null or a
    repeated id stay or go by their own texts. An empty table gives no rows; all columns stay.
    """
    at = docs.columns.index(text_col)
    for index in _blocks(benchmark, item_col, item_text_col, SIMILARITY, RECALL):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for batch in batches:
                yield batch.filter(pa.array([not shared.value.search(t) for t in batch.column(at).to_pylist()], pa.bool_()))

        docs = small_batches(docs).mapInArrow(run, docs.schema)
    return docs
