"""Suffix-array dedup: byte strings of a fixed length that a smaller document has too are cut out.

Sorting every suffix of a corpus would move 8 bytes and more for each byte of text. Suffixes
are sorted only where two can share ``size`` bytes:

1. texts are stored as packed blocks; each text falls into stretches of consecutive windows
   whose least hash of ``run`` bytes (the anchor) is the same, so windows that are equal are
   stretches' parts with equal anchors;
2. an anchor of one document only can't belong to a repeat; a stretch equal to one of a smaller
   document is repeated in whole; where all stretches of an anchor are equal, nothing is open;
3. the first of equal stretches, of anchors with several, go to shards by anchor. A shard sorts
   the suffixes of its stretches with their common prefixes, an enhanced suffix array; a scan
   with a stack closes the intervals of the common-prefix tree, and those whose occurrences
   differ in the byte before are the maximal repeats, with all occurrences. Each occurrence in a
   document larger than the group's smallest goes;
4. anchors with more stretches than a task should sort are decided by hashes of their windows
   instead, which settles the same question, whatever their number.

What is said of a block comes back to it by a join on the block; nothing passes the driver. Blocks
are stored in buckets of that key, so the joins move what is said, not the texts.
Blocks, buckets and shards are bounded by bytes; a hot anchor has at most ``VARIANTS`` entries of
a block in one bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waveline.llm.common import small_batches, stored, stored_by

SIZE, RUN = 50, 20
#: Stretches of one anchor that a block gives to the anchor's bucket, and that a shard sorts.
VARIANTS, SORTED_VARIANTS = 8, 2000
#: Entries that a bucket holds on average, and suffixes sorted at once.
BUCKET_ENTRIES, SORT_SUFFIXES = 500_000, 200_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)
_COVERED, _MANY, _HASHED = 1, 2, 4
_NONE = np.empty(0, np.int64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n of them at least."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        made = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps))
        _powers = made[0], made[1]
    return _powers


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _pack(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def _unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    """Arrays of one length, by their types."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    width, out, at = [np.dtype(k).itemsize for k in kinds], [], 0
    n = len(raw) // sum(width)
    for kind, w in zip(kinds, width, strict=True):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * w
    return out


def _planes(x: np.ndarray, width: int) -> np.ndarray:
    """The low ``width`` bytes of each number, all first bytes first."""
    return np.ascontiguousarray(x.astype("<u8", copy=False)).view(np.uint8).reshape(-1, 8)[:, :width].T


def _unplanes(raw: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((raw.size // width, 8), np.uint8)
    out[:, :width] = raw.reshape(width, -1).T
    return out.reshape(-1).view("<u8")


class Hashed:
    """A text's prefix sums: the hash of any of its strings in constant time."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _tables(n + 1)[0][:n], out=self.sums[1:])

    def strings(self, first: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return _mix((self.sums[first + length] - self.sums[first]) * _tables(len(self.sums))[1][first])

    def runs(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return _mix((self.sums[length:] - self.sums[:-length]) * _tables(len(self.sums))[1][:n])

    def stretches(self, size: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, hash, first window and number of windows of each stretch.

        No stretch has more windows than anchors' places in one (equal runs, as in a text of one
        letter, would make longer ones).
        """
        windows, span = len(self.sums) - size, size - run + 1
        least, width = self.runs(run), 1
        while width * 2 <= span:
            least, width = np.minimum(least[:-width], least[width:]), width * 2
        least = np.minimum(least[:windows], least[span - width :][:windows])
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        count = np.diff(np.append(first, windows))
        if len(count) and count.max() > span:
            parts = -(-count // span)
            offset = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            first, whole = np.repeat(first, parts) + offset * span, np.repeat(count, parts)
            count = np.minimum(whole - offset * span, span)
        # Least hashes are small numbers: mixed again, they deal out evenly.
        return _mix(least[first]), self.strings(first, count + size - 1) ^ count.astype(np.uint64), first, count


def _texts(row: dict) -> list[np.ndarray]:
    ends = np.cumsum(np.frombuffer(row["lengths"], np.int64))
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["texts"]), np.uint8) if row["texts"] else np.empty(0, np.uint8)
    return np.split(data, ends[:-1]) if len(ends) else []


class Block:
    """The texts of one batch and their stretches; entries are the different (anchor, stretch) pairs, sorted."""

    def __init__(self, row: dict, size: int, run: int):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.known = np.frombuffer(row["known"], np.bool_)
        self.texts = _texts(row)
        parts = [(i, *Hashed(t).stretches(size, run)) for i, t in enumerate(self.texts) if self.known[i] and len(t) >= size]
        m, h, s, c = (np.concatenate([p[k] for p in parts] or [_NONE]) for k in (1, 2, 3, 4))
        self.anchor, self.hash, self.s, self.c = m.astype(np.uint64), h.astype(np.uint64), s.astype(np.int64), c.astype(np.int64)
        self.row = np.repeat(np.array([p[0] for p in parts], np.int64), [len(p[1]) for p in parts])
        self.doc = self.ids[self.row]
        order = np.lexsort((self.doc, self.hash, self.anchor))
        a, h, d = self.anchor[order], self.hash[order], self.doc[order]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (h[1:] != h[:-1])))[: len(order)]
        at = np.flatnonzero(new)
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.e_anchor, self.e_hash, self.e_doc = a[at], h[at], d[at]
        self.e_several = np.maximum.reduceat(d, at) > self.e_doc if len(at) else np.empty(0, bool)
        self.e_at = order[at]  # an occurrence in the smallest document
        same = np.concatenate(([True], self.e_anchor[1:] != self.e_anchor[:-1]))[: len(at)]
        self.e_group = np.cumsum(same) - 1
        self.e_hot = np.bincount(self.e_group, minlength=1)[self.e_group] > VARIANTS if len(at) else np.empty(0, bool)
        self.e_marker = np.flatnonzero(same & self.e_hot)

    def deals(self, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(bucket, entries, markers): entries of an anchor meet in its bucket; those of one with
        many in this block by their own hash, and the anchor's bucket is told so."""
        to = np.where(self.e_hot, buckets + _bucket(self.e_hash, buckets), _bucket(self.e_anchor, buckets))
        marked = _bucket(self.e_anchor[self.e_marker], buckets)
        order, m_order = np.argsort(to, kind="stable"), np.argsort(marked, kind="stable")
        for b in np.union1d(to, marked).tolist():
            yield b, order[slice(*np.searchsorted(to[order], [b, b + 1]))], self.e_marker[m_order[slice(*np.searchsorted(marked[m_order], [b, b + 1]))]]


def _bucket(x: np.ndarray, buckets: int) -> np.ndarray:
    return ((x >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row of each batch: its ids and its texts, packed. Stored, so that a block stays what it is."""

    def work(batches):
        n, base = 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0)
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            known = np.array([x is not None for x in ids.to_pylist()], np.bool_)
            row = {
                "block": base | n, "bytes": sum(map(len, texts)), "ids": ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(), "known": known.tobytes(),
                "lengths": np.array(list(map(len, texts)), np.int64).tobytes(), "texts": zstandard.ZstdCompressor(level=3).compress(b"".join(texts)),
            }
            n += 1
            yield pa.RecordBatch.from_pylist([row], _BLOCK)

    rows = small_batches(docs).select(F.col(id_col).cast("bigint"), F.col(text_col))
    return stored_by(rows.mapInArrow(work, "block bigint, bytes bigint, ids binary, known binary, lengths binary, texts binary"), "suffixes-blocks", "block")


_BLOCK = pa.schema([("block", pa.int64()), ("bytes", pa.int64()), ("ids", pa.binary()), ("known", pa.binary()), ("lengths", pa.binary()), ("texts", pa.binary())])
_DEALT = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("base", pa.int64()), ("n", pa.int32()), ("data", pa.binary())])
_DEALT_TYPE = "bucket int, block bigint, base bigint, n int, data binary"


def _message(bucket: int, block: int, anchor: np.ndarray, value: np.ndarray, doc: np.ndarray, flag: np.ndarray) -> pa.RecordBatch:
    """Entries as byte planes: 4 bytes of the anchor, 7 of the hash, the document less the smallest."""
    base = int(doc.min())
    data = _pack(_planes(anchor, 4), _planes(value, 7), _planes((doc - base).astype(np.uint64), 8), flag.astype(np.uint8))
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([block], pa.int64()), pa.array([base], pa.int64()), pa.array([len(doc)], pa.int32()), pa.array([data], pa.binary())], schema=_DEALT)


def _messages(table: pa.Table) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(block, entries) of each message, and all entries: anchor, hash, document, flag."""
    said, parts = [], []
    for block, base, n, data in zip(*(table[c].to_pylist() for c in ("block", "base", "n", "data")), strict=True):
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
        a, v, d = (raw[n * lo : n * hi] for lo, hi in ((0, 4), (4, 11), (11, 19)))
        parts.append((_unplanes(a, 4), _unplanes(v, 7), _unplanes(d, 8).astype(np.int64) + base, raw[19 * n :]))
        said.append((block, n))
    return said, *(np.concatenate([p[k] for p in parts]) for k in range(4))


_SEVERAL, _MARKER = 1, 2


def _judge(buckets: int):
    """What is to become of each entry of a bucket's messages: its block's reply, a byte an entry."""

    def work(table: pa.Table) -> pa.Table:
        hot = table["bucket"][0].as_py() >= buckets
        said, anchor, value, doc, flag = _messages(table)
        order = np.lexsort((doc, value, anchor))
        a, v, d, f = anchor[order], value[order], doc[order], flag[order]
        marker = (f & _MARKER) > 0
        new_a = np.concatenate(([True], a[1:] != a[:-1]))
        new = new_a | np.concatenate(([True], (v[1:] != v[:-1]) | marker[1:] | marker[:-1]))
        at, group = np.flatnonzero(new_a), np.cumsum(new_a) - 1
        first = np.flatnonzero(new)
        covered = d[first][np.cumsum(new) - 1] < d
        if hot:  # the anchor has several stretches for certain
            status = np.where(covered, _COVERED, 0) | _MANY | _HASHED
        else:
            told = np.add.reduceat(marker.astype(np.int64), at) > 0
            variants = np.add.reduceat((new & ~marker).astype(np.int64), at)
            hashed = told | (variants > SORTED_VARIANTS)
            status = np.where(covered, _COVERED, 0) | np.where((told | (variants > 1))[group], _MANY, 0) | np.where(hashed[group], _HASHED, 0)
        reply = np.empty(len(order), np.uint8)
        reply[order] = status
        replies, begin = [], 0
        for _, n in said:
            replies.append(_pack(reply[begin : begin + n]))
            begin += n
        return pa.Table.from_arrays([table["block"], table["bucket"], pa.array(replies, pa.binary())], ["block", "bucket", "reply"])

    return work


def _entries(blocks: DataFrame, buckets: int, size: int, run: int) -> DataFrame:
    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, size, run)
                for bucket, entries, markers in block.deals(buckets):
                    at = np.concatenate([entries, markers])
                    flag = np.concatenate([block.e_several[entries] * _SEVERAL, np.full(len(markers), _MARKER)])
                    yield _message(bucket, row["block"], block.e_anchor[at], block.e_hash[at], block.e_doc[at], flag)

    return blocks.mapInArrow(work, _DEALT_TYPE)


_FOUND_TYPE = "kind int, bucket int, block bigint, base bigint, n int, data binary, doc_id bigint, known boolean, n_bytes bigint, n_removed bigint, kept_sha256 string, spans array<struct<begin: bigint, end: bigint>>, open binary, cover binary"
_FOUND = pa.schema([
    ("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("base", pa.int64()), ("n", pa.int32()), ("data", pa.binary()), ("doc_id", pa.int64()), ("known", pa.bool_()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
    ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), ("open", pa.binary()), ("cover", pa.binary()),
])
_DONE, _PENDING, _ITEMS, _WINDOWS = 0, 1, 2, 3


def _merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the intervals ``[begin, end)``."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate(([True], begin[1:] > reach[:-1]))
    return begin[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def _cut(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> dict:
    """A document's columns, without what lies in the maximal runs given."""
    kept = hashlib.sha256()
    for lo, hi in zip([0, *end.tolist()], [*begin.tolist(), len(text)], strict=True):
        kept.update(text[lo:hi])
    return {"n_bytes": len(text), "n_removed": int((end - begin).sum()), "kept_sha256": kept.hexdigest(), "spans": [{"begin": a, "end": z} for a, z in zip(begin.tolist(), end.tolist(), strict=True)]}


def _sort_out(size: int, run: int, buckets: int):
    """A block and its replies: documents that are settled, those that wait, and what they wait for."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        replies = dict(zip(right["bucket"].to_pylist(), right["reply"].to_pylist(), strict=True))
        for row in left.to_pylist():
            block = Block(row, size, run)
            status = np.zeros(len(block.e_doc), np.uint8)
            for bucket, entries, _ in block.deals(buckets):
                status[entries] = _unpack(replies[bucket], "u1")[0][: len(entries)]
            covered = ((status & _COVERED) > 0)[block.entry] | (block.doc > block.e_doc[block.entry])
            waits = ((status & (_COVERED | _MANY)) == _MANY)[block.entry] & ~covered
            hashed = ((status & _HASHED) > 0)[block.entry]
            items = np.unique(block.entry[waits & ~hashed])  # one of equal stretches
            if len(items):
                at = block.e_at[items]
                to = _bucket(block.e_anchor[items], buckets)
                for b in np.unique(to).tolist():
                    some = np.flatnonzero(to == b)
                    texts = [block.texts[block.row[i]][block.s[i] : block.s[i] + block.c[i] + size - 1] for i in at[some].tolist()]
                    data = zstandard.ZstdCompressor(level=3).compress(b"".join([*(a.tobytes() for a in (block.e_anchor[items[some]], block.doc[at[some]], block.s[at[some]], items[some], np.array(list(map(len, texts)), np.int64))), *(t.tobytes() for t in texts)]))
                    out.append({"kind": _ITEMS, "bucket": b, "block": row["block"], "n": len(some), "data": data})
            open_hashed = waits & hashed
            if open_hashed.any():
                value, doc = _windows(block.texts, block.row[open_hashed], block.s[open_hashed], block.c[open_hashed], block.doc[open_hashed], size)
                order = np.lexsort((doc, value))
                value, doc = value[order], doc[order]
                new = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
                several = np.maximum.reduceat(doc, new) > doc[new]
                value, doc = value[new], doc[new]
                to = _bucket(value, buckets)
                for b in np.unique(to).tolist():
                    some = to == b
                    out.append({"kind": _WINDOWS} | _message(b, row["block"], value[some], value[some] >> np.uint64(8), doc[some], several[some]).to_pylist()[0])
            begin, end = block.s[covered], block.s[covered] + block.c[covered] - 1 + size
            of, open_of = block.row[covered], block.row[waits]
            waiting = np.bincount(open_of, minlength=len(block.texts)) > 0
            order, open_order = np.argsort(of, kind="stable"), np.argsort(open_of, kind="stable")
            cuts = np.searchsorted(of[order], np.arange(len(block.texts) + 1))
            opens = np.stack([open_of, block.s[waits], block.c[waits], np.where(hashed[waits], -1, block.entry[waits])])[:, open_order]
            covers = [(_NONE, _NONE, _NONE)]
            for i, text in enumerate(block.texts):
                mine = order[cuts[i] : cuts[i + 1]]
                lo, hi = _merged(begin[mine], end[mine])
                if waiting[i]:
                    covers.append((np.full(len(lo), i), lo, hi))
                else:
                    out.append({"kind": _DONE, "block": row["block"], "doc_id": int(block.ids[i]), "known": bool(block.known[i])} | _cut(text, lo, hi))
            if waiting.any():  # their texts stay in the block
                out.append({"kind": _PENDING, "block": row["block"], "open": _pack(*opens), "cover": _pack(*map(np.concatenate, zip(*covers, strict=True)))})
        return pa.Table.from_pylist(out, _FOUND)

    return work


def _windows(texts: list[np.ndarray], rows: np.ndarray, s: np.ndarray, c: np.ndarray, docs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every window of the stretches given."""
    values, of = [], []
    order = np.argsort(rows, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(rows[order])) + 1):
        runs = Hashed(texts[rows[part[0]]]).runs(size)
        for i in part.tolist():
            values.append(runs[s[i] : s[i] + c[i]])
            of.append(np.full(c[i], docs[i]))
    return np.concatenate(values), np.concatenate(of)


def _judge_windows(table: pa.Table) -> pa.Table:
    """Of windows in several documents, the smallest of these, to each block that has them."""
    said, low, value, doc, flag = _messages(table)
    order = np.lexsort((doc, value, low))
    a, v, d = low[order], value[order], doc[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (v[1:] != v[:-1])))
    first = d[np.flatnonzero(new)][np.cumsum(new) - 1]
    least = np.empty(len(order), np.int64)
    least[order] = first
    whole = (value << np.uint64(8)) | (low & np.uint64(255))
    blocks, replies, begin = [], [], 0
    for block, n in said:
        some = np.arange(begin, begin + n)
        some = some[(least[some] < doc[some]) | ((flag[some] & _SEVERAL) > 0)]
        begin += n
        if len(some):
            blocks.append(block)
            replies.append(_pack(whole[some], least[some]))
    none = pa.nulls(len(blocks), pa.binary())
    return pa.Table.from_arrays([pa.array(blocks, pa.int64()), none, pa.array(replies, pa.binary())], ["block", "spans", "windows"])


class SuffixArray:
    """The sorted suffixes of at least ``size`` bytes of some short texts, with the prefixes that neighbours share."""

    def __init__(self, texts: list[bytes], docs: np.ndarray, size: int, width: int):
        wide = -(-width // 8) * 8
        lengths = np.array(list(map(len, texts)), np.int64)
        table = np.zeros((len(texts), width + wide), np.uint8)
        flat = np.frombuffer(b"".join(texts), np.uint8)
        rows = np.repeat(np.arange(len(texts)), lengths)
        table[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
        items, starts, suffixes = [], [], []
        for s in range(int(lengths.max(initial=0)) - size + 1):
            some = np.flatnonzero(lengths - s >= size)
            items.append(some)
            starts.append(np.full(len(some), s))
            suffixes.append(np.ascontiguousarray(table[some, s : s + wide]).view(">u8").astype(np.uint64))
        item, start, words = np.concatenate(items or [_NONE]), np.concatenate(starts or [_NONE]), np.concatenate(suffixes or [np.empty((0, wide // 8), np.uint64)])
        length = lengths[item] - start
        # Suffixes without an equal beginning meet no other: only the rest is sorted.
        key = np.zeros(len(item), np.uint64)
        for k in range(size // 8):
            key = _mix(key ^ words[:, k])
        _, of, n = np.unique(key, return_inverse=True, return_counts=True)
        some = np.flatnonzero(n[of] > 1)
        item, start, words, length = item[some], start[some], words[some], length[some]
        order = np.lexsort((length, *words.T[::-1]))
        self.item, self.start, self.doc = item[order], start[order], docs[item[order]]
        words, length = words[order], length[order]
        #: The byte before; none at the beginning of a text, which differs from all.
        self.left = np.where(self.start > 0, table[self.item, np.maximum(self.start - 1, 0)].astype(np.int64), -1)
        n = len(order)
        self.lcp = np.zeros(n + 1, np.int64)  # of a suffix and the one before; nothing at both ends
        if n > 1:
            differs = words[1:].astype(">u8").view(np.uint8) != words[:-1].astype(">u8").view(np.uint8)
            common = np.where(differs.any(1), differs.argmax(1), wide)
            self.lcp[1:n] = np.minimum(common, np.minimum(length[1:], length[:-1]))
        self.lcp[self.lcp < size] = 0

    def intervals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last suffix and length of every maximal repeat.

        Each interval of the common-prefix tree is a string with all its occurrences; no longer
        one has them all. It can't be longer to the left either if the bytes before differ.
        Stretches of equal common prefixes are one interval; others are scanned with a stack.
        """
        lcp, left = self.lcp, self.left
        inside = lcp > 0
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        begin, end = edge[::2], edge[1::2]  # lcp[begin:end] > 0: suffixes begin - 1 to end - 1
        if not len(begin):
            return _NONE, _NONE, _NONE
        # reduceat needs neighbouring parts: what lies between is skipped.
        cuts = np.stack([begin, end], 1).ravel()
        low, high = np.minimum.reduceat(lcp, cuts)[::2], np.maximum.reduceat(lcp, cuts)[::2]
        flat = low == high
        lo, hi, length = [begin[flat] - 1], [end[flat] - 1], [low[flat]]
        scanned = []
        for b, e in zip(begin[~flat].tolist(), end[~flat].tolist(), strict=True):
            stack: list[tuple[int, int]] = []  # (common prefix, first suffix), growing
            for i, common in enumerate([*lcp[b:e].tolist(), 0], b):
                first = i - 1
                while stack and stack[-1][0] > common:
                    shared, first = stack.pop()
                    scanned.append((first, i - 1, shared))
                if common and (not stack or stack[-1][0] < common):
                    stack.append((common, first))
        for k, x in enumerate((lo, hi, length)):
            x.append(np.array([y[k] for y in scanned], np.int64))
        lo, hi, length = (np.concatenate(x) for x in (lo, hi, length))
        # Left-extension diversity: changes of the byte before, counted up to each suffix; no byte before counts as a change.
        change = np.concatenate(([0], np.cumsum((left[1:] != left[:-1]) | (left[1:] < 0) | (left[:-1] < 0))))
        diverse = change[hi] > change[lo]
        return lo[diverse], hi[diverse], length[diverse]

    def occurrences(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(group, suffix, length, the group's smallest document) of every occurrence of every maximal repeat."""
        lo, hi, length = self.intervals()
        n = hi - lo + 1
        group = np.repeat(np.arange(len(lo)), n)
        suffix = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        least = np.minimum.reduceat(self.doc[suffix], np.cumsum(n) - n) if len(n) else _NONE
        return group, suffix, length[group], least[group]


def _items(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Block, anchor, document, place and number of each stretch of a shard, and its bytes."""
    cols, texts = [], []
    for block, n, data in zip(*(table[c].to_pylist() for c in ("block", "n", "data")), strict=True):
        raw = zstandard.ZstdDecompressor().decompress(data)
        anchor, doc, s, item, length = (np.frombuffer(raw, np.uint64 if k == 0 else np.int64, n, k * n * 8) for k in range(5))
        ends = (40 * n + np.cumsum(length)).tolist()
        texts += [raw[a:z] for a, z in zip([40 * n, *ends[:-1]], ends, strict=True)]
        cols.append((np.full(n, block), anchor, doc, s, item))
    return *(np.concatenate([c[k] for c in cols]) for k in range(5)), texts


def _shard(size: int, width: int):
    """(arrays of a shard, its occurrences), a bounded number of suffixes at a time."""

    def parts(table: pa.Table):
        block, anchor, doc, s, item, texts = _items(table)
        order = np.argsort(anchor, kind="stable")
        ends = np.append(np.flatnonzero(np.diff(anchor[order])) + 1, len(order))  # anchors stay whole
        weight = np.cumsum([len(texts[i]) - size + 1 for i in order.tolist()])
        begin = 0
        while begin < len(order):
            most = (weight[begin - 1] if begin else 0) + SORT_SUFFIXES
            k = max(np.searchsorted(weight[ends - 1], most, "right") - 1, np.searchsorted(ends, begin, "right"))
            end = int(ends[min(k, len(ends) - 1)])
            some = order[begin:end]
            begin = end
            array = SuffixArray([texts[i] for i in some.tolist()], doc[some], size, width)
            yield block[some], item[some], s[some], array

    def spans(table: pa.Table) -> pa.Table:
        """Where the stretches' windows are a smaller document's too, by block: (number, begin, length)."""
        found = []
        for block, item, _, array in parts(table):
            group, suffix, length, least = array.occurrences()
            late = array.doc[suffix] > least
            of = array.item[suffix[late]]
            found.append((block[of], item[of], array.start[suffix[late]], length[late]))
        block, item, start, length = (np.concatenate([f[k] for f in found]) for k in range(4))
        order = np.lexsort((start, item, block))
        blocks, at = np.unique(block[order], return_index=True)
        replies = [_pack(item[p], start[p], length[p]) for p in np.split(order, at[1:])] if len(order) else []
        return pa.Table.from_arrays([pa.array(blocks, pa.int64()), pa.array(replies, pa.binary()), pa.nulls(len(replies), pa.binary())], ["block", "spans", "windows"])

    def groups(table: pa.Table) -> pa.Table:
        rows, bucket = [], table["bucket"][0].as_py()
        for n, (_, _, s, array) in enumerate(parts(table)):
            group, suffix, length, _ = array.occurrences()
            names = pa.array([f"{bucket}-{n}-{g}" for g in group.tolist()], pa.string())
            rows.append(pa.Table.from_arrays([names, pa.array(length, pa.int64()), pa.array(array.doc[suffix], pa.int64()), pa.array(s[array.item[suffix]] + array.start[suffix], pa.int64())], ["group", "length", "doc_id", "begin"]))
        return pa.concat_tables(rows)

    return spans, groups


def _finish(size: int):
    """A block's documents that waited, with what the shards and the windows' buckets say of it."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        said = {c: [x for x in right[c].to_pylist() if x is not None] for c in ("open", "cover", "spans", "windows")}
        if not said["open"]:
            return _RESULT.empty_table()
        spans = [_unpack(x, "i8", "i8", "i8") for x in said["spans"]]
        item, start, length = (np.concatenate([x[k] for x in spans] or [_NONE]) for k in range(3))
        order = np.argsort(item, kind="stable")
        item, start, length = item[order], start[order], length[order]
        told = [_unpack(x, "u8", "i8") for x in said["windows"]]
        value, least = (np.concatenate([x[k] for x in told] or [_NONE.astype(np.uint64 if k == 0 else np.int64)]) for k in range(2))
        order = np.argsort(value)
        value, least = value[order], least[order]
        row = left.to_pylist()[0]
        ids, texts = np.frombuffer(row["ids"], np.int64), _texts(row)
        doc, s, c, of = _unpack(said["open"][0], "i8", "i8", "i8", "i8")
        c_doc, c_lo, c_hi = _unpack(said["cover"][0], "i8", "i8", "i8")
        out = []
        for i in np.unique(doc).tolist():
            text = texts[i]
            mine, known = slice(*np.searchsorted(doc, [i, i + 1])), slice(*np.searchsorted(c_doc, [i, i + 1]))
            begin, end = [c_lo[known]], [c_hi[known]]
            lo, hi = np.searchsorted(item, of[mine], "left"), np.searchsorted(item, of[mine], "right")
            for k in np.flatnonzero((of[mine] >= 0) & (hi > lo)).tolist():
                begin.append(s[mine][k] + start[lo[k] : hi[k]])
                end.append(begin[-1] + length[lo[k] : hi[k]])
            if (of[mine] < 0).any() and len(value):
                runs = Hashed(text).runs(size)
                for k in np.flatnonzero(of[mine] < 0).tolist():
                    hashes = runs[s[mine][k] : s[mine][k] + c[mine][k]]
                    at = np.minimum(np.searchsorted(value, hashes), len(value) - 1)
                    late = np.flatnonzero((value[at] == hashes) & (least[at] < ids[i]))
                    begin.append(s[mine][k] + late)
                    end.append(begin[-1] + size)
            out.append({"doc_id": int(ids[i])} | _cut(text, *_merged(np.concatenate(begin), np.concatenate(end))))
        return pa.Table.from_pylist(out, _RESULT)

    return work


_RESULT = pa.schema([_FOUND.field(c) for c in ("doc_id", "n_bytes", "n_removed", "kept_sha256", "spans")])
_RESULT_TYPE = "doc_id bigint, n_bytes bigint, n_removed bigint, kept_sha256 string, spans array<struct<begin: bigint, end: bigint>>"


class Repeats:
    """The stages over one table: what each makes is stored once and read by the next."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, size: int, run: int):
        self.size, self.width = size, 2 * size - run
        self.blocks = blocks = _blocks(docs, id_col, text_col)
        total = blocks.agg(F.sum("bytes")).head()[0] or 0
        self.buckets = max(8, -(-2 * total // ((size - run + 2) * BUCKET_ENTRIES)))
        replies = _entries(blocks, self.buckets, size, run).groupBy("bucket").applyInArrow(_judge(self.buckets), "block bigint, bucket int, reply binary")
        found = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_sort_out(size, run, self.buckets), _FOUND_TYPE)
        self.found = stored(found, "suffixes-found", "zstd")
        self.items = self.found.where(F.col("kind") == _ITEMS).select("bucket", "block", "n", "data")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, run: int = RUN) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)`` of every row.

    Texts are UTF-8 bytes. A byte goes if a string of ``size`` bytes over it also starts in a row
    with a smaller id; spans are the maximal byte ranges ``[begin, end)`` that go. Null, empty and
    short texts lose nothing. Rows with one id don't clean each other, and repeated rows come back
    as often as they went in; a null id is neither compared nor cleaned. Ids are integers. An
    empty table gives no rows; other columns are ignored.
    """
    repeats = Repeats(docs, id_col, text_col, size, run)
    found = repeats.found
    sorted_, _ = _shard(size, repeats.width)
    reply = "block bigint, spans binary, windows binary"
    told = repeats.items.groupBy("bucket").applyInArrow(sorted_, reply)
    windows = found.where(F.col("kind") == _WINDOWS).select("bucket", "block", "base", "n", "data")
    told = told.unionByName(windows.groupBy("bucket").applyInArrow(_judge_windows, reply))
    pending = found.where(F.col("kind") == _PENDING).select("block", "open", "cover")
    told = told.unionByName(pending, allowMissingColumns=True)
    late = repeats.blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_finish(size), _RESULT_TYPE)
    done = found.where(F.col("kind") == _DONE).select(F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), "n_bytes", "n_removed", "kept_sha256", "spans")
    return done.unionByName(late).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "spans")


def maximal_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, run: int = RUN) -> DataFrame:
    """``(group, length, doc_id, begin)``: each occurrence of every maximal repeat of ``size`` bytes or more.

    A repeat is maximal within the stretches that share its anchor: longer ones come as several
    that overlap. Stretches that equal one of a smaller document are represented by that, and
    anchors without a second stretch, or with too many to sort, have no groups here. Null and
    short texts and null ids have none.
    """
    repeats = Repeats(docs, id_col, text_col, size, run)
    _, groups = _shard(size, repeats.width)
    return repeats.items.groupBy("bucket").applyInArrow(groups, "group string, length bigint, doc_id bigint, begin bigint")
