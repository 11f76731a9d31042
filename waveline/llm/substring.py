"""Substring dedup: repeated fixed-length token windows, by Rabin-Karp hashes counted in Spark.

Every window of ``size`` words has a Rabin-Karp hash, from prefix sums modulo 2^64. A window is
represented by its minimizer: the least hash of the word runs of ``run`` words inside it. Equal
windows have equal minimizers, so

1. one pass over the texts finds, for each document, the stretches of consecutive windows that
   share a minimizer, each with the hash of all its words (about a row for every 22 windows);
2. Spark counts minimizers; those of one document only cannot belong to a repeated window;
3. stretches equal to one of a document with a smaller id are repeated in whole;
4. of the other stretches whose minimizer is repeated, only the first of equal ones can settle
   anything: the hashes of all its windows are counted, and each window is compared with the
   smallest document that has it.

Flagged windows merge into maximal removal intervals. No window is left out: what isn't sent
is proven to be in one document only, or decided as part of its stretch. Hashes meet by
(minimizer, hash), 128 bits together.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waveline.llm.common import bounded_broadcast, fresh, small_batches, stored

SIZE, RUN = 50, 8
_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


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
    """A bijection of 64-bit words without visible order."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashed:
    """The words of a text with their prefix sums: the hash of any run in constant time."""

    def __init__(self, text: bytes):
        self.words = text.split()  # of bytes: ASCII white space only
        n = len(self.words)
        codes = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * _tables(n + 1)[0][:n], out=self.sums[1:])

    def key(self) -> int:
        """32 bits of the whole word sequence, signed."""
        return int(_mix(self.sums[-1:] ^ np.uint64(len(self.words))).view(np.int32)[0])

    def runs(self, length: int) -> np.ndarray:
        """The hash of each run of ``length`` words, by its first word."""
        return _mix((self.sums[length:] - self.sums[:-length]) * _tables(len(self.sums))[1][: len(self.sums) - length])

    def stretches(self, size: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Minimizer, hash, first window and number of windows of each stretch."""
        windows, span = len(self.words) - size + 1, size - run + 1
        if windows < 1:
            return (np.empty(0, np.int64),) * 4
        least, width = self.runs(run), 1
        while width * 2 <= span:
            least, width = np.minimum(least[:-width], least[width:]), width * 2
        least = np.minimum(least[:windows], least[span - width :][:windows])
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        count = np.diff(np.append(first, windows))
        whole = (self.sums[first + count + size - 1] - self.sums[first]) * _tables(len(self.sums))[1][first]
        return least[first].view(np.int64), _mix(whole ^ count.astype(np.uint64)).view(np.int64), first, count


_STRETCHES = "array<struct<m: bigint, h: bigint, s: int, c: int>>"


def _scan(docs: DataFrame, id_col: str, text_col: str, size: int, run: int) -> DataFrame:
    """One row of each document: its word count, the hash of its words, its stretches."""

    def work(batches):
        for batch in batches:
            keys, counts, hashes, parts, ends = [], [], [], [], [0]
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                hashed = Hashed(text or b"")
                parts.append(hashed.stretches(size, run))
                ends.append(ends[-1] + len(parts[-1][0]))
                keys.append(hashed.key())
                counts.append(len(hashed.words))
                hashes.append(hashlib.sha256(b" ".join(hashed.words)).hexdigest())
            cols = [np.concatenate([p[k] for p in parts]) if parts else np.empty(0, np.int64) for k in range(4)]
            arrays = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(arrays, ["m", "h", "s", "c"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int32()), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), lists], ["doc_id", "k", "n_words", "sha", "stretches"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return small_batches(docs).select(F.col(id_col), F.col(text_col)).mapInArrow(work, f"doc_id {kind}, k int, n_words bigint, sha string, stretches {_STRETCHES}")


def _windows(chosen: DataFrame, size: int, id_type: str) -> DataFrame:
    """(m, w, doc_id, k, s): the hash of each window of the stretches in ``todo``."""

    def work(batches):
        for batch in batches:
            for i, (text, key, todo) in enumerate(zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                hashed = Hashed(text or b"")
                if hashed.key() != key:
                    continue
                all_of = hashed.runs(size).view(np.int64)
                for t in todo:  # a stretch at a time, long ones in parts
                    for first in range(t["s"], t["s"] + t["c"], 100_000):
                        count = min(100_000, t["s"] + t["c"] - first)
                        of = batch.column(0).take(pa.array(np.full(count, i)))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(count, t["m"]), pa.int64()), pa.array(all_of[first : first + count]), of, pa.array(np.full(count, key), pa.int32()), pa.array(np.arange(first, first + count), pa.int32())], ["m", "w", "doc_id", "k", "s"])

    return chosen.mapInArrow(work, f"m bigint, w bigint, doc_id {id_type}, k int, s int")


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


class Repeats:
    """The stages over one table: what each makes is stored once and read by the next."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, size: int, run: int):
        self.id_type = docs.select(id_col).schema[0].dataType.simpleString()
        self.scanned = stored(_scan(docs, id_col, text_col, size, run), "substring-scan")
        rows = self.scanned.where("doc_id is not null").select("doc_id", "k", F.explode("stretches").alias("x")).select("doc_id", "k", "x.*")
        minimizers = rows.groupBy("m").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z").select("m")
        # Sums are stored before they are joined back: a join of two plain shuffles is split where
        # a key is hot, one whose side still aggregates isn't.
        shared = stored(rows.join(stored(minimizers, "substring-minimizers"), "m"), "substring-stretches")
        firsts = stored(shared.groupBy("m", "h", "c").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "substring-firsts")
        variants = stored(firsts.groupBy("m").agg((F.count("*") > 1).alias("many")), "substring-variants")
        firsts = firsts.join(variants, "m").where("n > 1 or many").drop("n")
        judged = shared.join(stored(firsts, "substring-judges"), ["m", "h", "c"])
        judged = judged.select("doc_id", "k", F.struct("m", "s", "c", (F.col("doc_id") > F.col("first")).alias("whole")).alias("x"), "many").where("x.whole or many")
        # One row of each document, of its own stretches: no longer than the document.
        per_doc = judged.groupBy("doc_id", "k").agg(F.collect_list("x").alias("xs"))
        text = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        self.chosen = stored(text.join(per_doc, "doc_id").select("doc_id", "text", "k", "xs"), "substring-chosen")
        todo = F.filter("xs", lambda x: ~x["whole"])
        open_ = self.chosen.select("doc_id", "text", "k", todo.alias("todo")).where(F.size("todo") > 0)
        windows = stored(_windows(open_, size, self.id_type), "substring-windows")
        firsts = windows.groupBy("m", "w").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("m", "w", "first")
        late = windows.join(stored(firsts, "substring-window-firsts"), ["m", "w"]).where("doc_id > first").select("doc_id", "k", F.struct("s", F.lit(1).alias("c")).alias("y"))
        late = stored(late, "substring-late")  # its join stands alone, so that hot windows are split
        whole = self.chosen.select("doc_id", "k", F.explode(F.filter("xs", lambda x: x["whole"])).alias("x")).select("doc_id", "k", F.struct("x.s", "x.c").alias("y"))
        self.flagged = whole.unionByName(late).groupBy("doc_id", "k").agg(F.collect_set("y").alias("spans"))


def _cut(text: bytes, key: int, spans: list[dict] | None, size: int) -> tuple[list[bytes], int, list[tuple[int, int]]] | None:
    """Kept words, number of words and merged intervals; None if these spans are another text's."""
    words = text.split()
    if spans and Hashed(text).key() != key:
        return None
    intervals = _merged([(x["s"], x["s"] + x["c"] - 1 + size) for x in spans or ()])
    kept, at = [], 0
    for lo, hi in intervals:
        kept += words[at:lo]
        at = hi
    return kept + words[at:], len(words), intervals


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, run: int = RUN) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256, intervals)`` of every row.

    A word goes if a window of ``size`` words over it also starts in a row with a smaller id;
    intervals are the maximal word ranges ``[begin, end)`` that go. Null and short texts lose
    nothing. Rows with one id don't clean each other, and repeated rows come back as often as
    they went in; a null id is neither compared nor cleaned. An empty table gives no rows;
    other columns are ignored.
    """
    found = Repeats(docs, id_col, text_col, size, run)
    plain = found.scanned.join(found.flagged.select("doc_id", "k"), ["doc_id", "k"], "left_anti")
    interval = "array<struct<begin: int, end: int>>"
    plain = plain.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"), F.array().cast(interval).alias("intervals"))

    def work(batches):
        for batch in batches:
            rows = []
            for i, (text, key, spans) in enumerate(zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                if (done := _cut(text or b"", key, spans, size)) is not None:
                    kept, n, intervals = done
                    rows.append((i, n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), [{"begin": a, "end": z} for a, z in intervals]))
            cols = [pa.array([r[k] for r in rows], t) for k, t in ((1, pa.int64()), (2, pa.int64()), (3, pa.string()), (4, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())), *cols], ["doc_id", "n_words", "n_removed", "kept_sha256", "intervals"])

    cut = found.chosen.select("doc_id", "text", "k").join(found.flagged, ["doc_id", "k"]).select("doc_id", "text", "k", "spans")
    cut = cut.mapInArrow(work, f"doc_id {found.id_type}, n_words bigint, n_removed bigint, kept_sha256 string, intervals {interval}")
    return plain.unionByName(cut)


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, run: int = RUN, length_col: str = "n_chars") -> DataFrame:
    """``docs`` with repeated windows cut out of the texts; rows left without a word go.

    A text that loses words becomes its kept words with one blank between, and ``length_col``,
    if there is one, its code points. Others stay as they are, null and empty ones too. All
    columns stay. Rows with one id don't clean each other, and each repeated row is cut alike; a
    null id is neither compared nor cut. An empty table gives no rows. Where the ids of texts
    that lose words are few in bytes, only those rows are shuffled, else all are.
    """
    found = Repeats(docs, id_col, text_col, size, run)
    names = [fresh(docs, s) for s in ("wl_key", "wl_spans", "wl_id")]
    flagged = found.flagged.select(F.col("doc_id").alias(names[2]), F.col("k").alias(names[0]), F.col("spans").alias(names[1]))
    # An id with several texts has several keys: one row of each id, its keys side by side.
    flagged = stored(flagged.groupBy(names[2]).agg(F.collect_list(F.struct(names[0], names[1])).alias(names[1])), "substring-flagged")
    ids = flagged.select(F.col(names[2]).alias(id_col))
    few = bounded_broadcast(ids)
    rows, rest = docs, None
    if few is not ids:
        rows, rest = docs.join(few, id_col, "left_semi").select(*docs.columns), docs.join(few, id_col, "left_anti").select(*docs.columns)
    rows = rows.join(flagged, rows[id_col] == flagged[names[2]], "left").drop(names[2])
    at, spans_at = docs.columns.index(text_col), len(docs.columns)
    length_at = docs.columns.index(length_col) if length_col in docs.columns else None

    def work(batches):
        for batch in batches:
            texts, keep = batch.column(at).to_pylist(), []
            lengths = batch.column(length_at).to_pylist() if length_at is not None else []
            for i, of in enumerate(batch.column(spans_at).to_pylist()):
                left = True
                for f in of or ():
                    done = _cut(texts[i].encode(), f[names[0]], f[names[1]], size)
                    if done is not None:
                        texts[i], left = b" ".join(done[0]).decode(), bool(done[0])
                        if lengths:
                            lengths[i] = len(texts[i])
                        break
                keep.append(left)
            cols = list(batch.columns[:spans_at])
            cols[at] = pa.array(texts, pa.string())
            if lengths:
                cols[length_at] = pa.array(lengths, batch.schema.field(length_at).type)
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names[:spans_at]).filter(pa.array(keep))

    cut = rows.mapInArrow(work, T.StructType(docs.schema.fields))
    return cut if rest is None else cut.unionByName(rest)
