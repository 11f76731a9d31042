"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every 1-, 2- and 3-gram of every labelled text into a fixed number of buckets,
summed a task at a time and then in Spark. The model is one row of log-probabilities for each
bucket and one column for each language; it is broadcast. A batch of texts becomes one sparse
matrix of bucket counts (rows' ends, buckets, counts), and its product with the model gives the
scores of all its texts. With many languages the model is blocks of some of them: each text
carries the best so far and the sum of all likelihoods against it from block to block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waveline.llm.common import checkpoint, fresh, small_batches

#: Size of the model: buckets, n-gram lengths, and languages of one broadcast at most (32 MB).
#: More languages are several blocks, a pass over the texts for each.
BUCKETS, ORDERS, LANGUAGES = 1 << 15, 3, 256
#: Characters whose n-grams are held at once, but for a longer text.
CHARS = 1 << 18
#: A task hands on its counts when it has this many languages, so that its memory is bounded.
_HELD = 64
_LETTER = regex.compile(r"\p{L}")
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)
_lower = None


def _codes() -> np.ndarray:
    """A letter's code point in lower case, a blank's for all else."""
    global _lower
    if _lower is None:
        table = np.full(0x110000, 32, np.uint32)
        for c in filter(str.isalpha, map(chr, range(0x110000))):
            table[ord(c)] = ord(c.lower()[0])
        _lower = table
    return _lower


def _letters(text: str) -> np.ndarray:
    """Code points in lower case, a blank at both ends and for every run of non-letters."""
    code = _codes()[np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = code == 32
    return code[~(blank & np.concatenate(([False], blank[:-1])))]


def _hashed(code: np.ndarray, buckets: int) -> list[np.ndarray]:
    """Buckets of the 1-grams, 2-grams and so on that begin at each place of the code points."""
    out, key = [], np.zeros(len(code), np.uint32)
    for k in range(min(ORDERS, len(code))):
        key = (key[: len(code) - k] ^ code[k:]) * _MULTIPLIERS[k]
        key ^= key >> np.uint32(15)
        out.append((key * np.uint32(0x27D4EB2F) >> np.uint32(8)) % np.uint32(buckets))
    return out


def grams(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of all 1- to 3-grams of a text, in lower case, with runs of non-letters as one blank."""
    return np.concatenate(_hashed(_letters(text), buckets))


def sparse_counts(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket counts of a batch as a sparse matrix: where each text's entries end, their buckets, their counts."""
    codes = [_letters(t) for t in texts]
    ends = np.cumsum([len(c) for c in codes])
    row = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(ends, prepend=0)) * buckets
    keys = []
    for k, found in enumerate(_hashed(np.concatenate(codes), buckets)):
        keys.append((row[: len(found)] + found)[row[: len(found)] == row[k:]])  # none across two texts
    keys, counts = np.unique(np.concatenate(keys), return_counts=True)
    return np.searchsorted(keys, np.arange(1, len(texts) + 1) * buckets), keys % buckets, counts


def _parts(texts: list[str]):
    """Consecutive texts of CHARS characters together, or one longer text."""
    at, size = 0, 0
    for k, text in enumerate(texts):
        if k > at and size + len(text) > CHARS:
            yield texts[at:k]
            at, size = k, 0
        size += len(text)
    if texts:
        yield texts[at:]


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray  # by language
    weights: np.ndarray  # buckets by languages

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log-probabilities of texts by languages: the sparse counts times the model."""
        ends, buckets, counts = sparse_counts(texts, len(self.weights))
        out = np.empty((len(texts), len(self.languages)))
        for k in range(len(self.languages)):
            so_far = np.concatenate(([0.0], np.cumsum(counts * self.weights[buckets, k], dtype=np.float64)))
            out[:, k] = np.diff(so_far[ends], prepend=0.0)
        return out + self.prior

    def go_on(self, texts: list[str | None], so_far: list[tuple[str, float, float] | None]) -> list[tuple[str, float, float] | None]:
        """(language, score, likelihoods of all against it) of each text, with this block's languages
        taken in; of equal scores the first stays. None without letters or languages."""
        out = list(so_far)
        known = [i for i, t in enumerate(texts) if t and self.languages and _LETTER.search(t)]
        at = 0
        for part in _parts([texts[i] for i in known]):
            scores = self.scores(part)
            best = scores.argmax(axis=1)
            top = scores.max(axis=1)
            total = np.exp(scores - top[:, None]).sum(axis=1)
            for i, b, score, against in zip(known[at : at + len(part)], best.tolist(), top.tolist(), total.tolist(), strict=True):
                had = out[i]
                if had is None:
                    out[i] = self.languages[b], score, against
                elif score > had[1]:
                    out[i] = self.languages[b], score, against + had[2] * float(np.exp(had[1] - score))
                else:
                    out[i] = had[0], had[1], had[2] + against * float(np.exp(score - had[1]))
            at += len(part)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The likeliest language of each text and its posterior probability, the alphabetically
        first of equal ones; ``und`` and 0 without letters or languages."""
        return [("und", 0.0) if x is None else (x[0], 1 / x[2]) for x in self.go_on(texts, [None] * len(texts))]


def predict_all(models: list[Model], texts: list[str | None]) -> list[tuple[str, float]]:
    """The same over all blocks of a model."""
    found: list[tuple[str, float, float] | None] = [None] * len(texts)
    for model in models:
        found = model.go_on(texts, found)
    return [("und", 0.0) if x is None else (x[0], 1 / x[2]) for x in found]


def predicted(rows: DataFrame, at: int, models: list[Model], lang: str, score: str) -> DataFrame:
    """``rows`` with the language predicted of the text in column ``at``, and its probability.

    A pass over the texts for each block of languages, each with its own broadcast.
    """
    types = [*rows.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]
    rest, wide = fresh(rows, "wl_rest"), len(rows.columns)
    carried = T.StructType([*types, T.StructField(rest, T.DoubleType())])
    rows = rows.select("*", F.lit(None).cast("string").alias(lang), F.lit(None).cast("double").alias(score), F.lit(None).cast("double").alias(rest))
    for model in models:
        shared = rows.sparkSession.sparkContext.broadcast(model)

        def work(batches, shared=shared):
            for batch in batches:
                had = [None if a is None else (a, b, c) for a, b, c in zip(*(batch.column(wide + k).to_pylist() for k in range(3)), strict=True)]
                found = shared.value.go_on(batch.column(at).to_pylist(), had)
                cols = [pa.array([None if x is None else x[k] for x in found], t) for k, t in enumerate((pa.string(), pa.float64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:wide], *cols], batch.schema.names)

        rows = rows.mapInArrow(work, carried)
    none = F.col(lang).isNull()
    return rows.withColumns({score: F.when(none, 0.0).otherwise(1 / F.col(rest)), lang: F.when(none, "und").otherwise(F.col(lang))}).drop(rest)


def bucket_counts(rows: DataFrame, text_col: str, lang_col: str, buckets: int = BUCKETS) -> DataFrame:
    """``(lang, bucket, n)`` over all rows; bucket -1 counts documents. Rows without language are left out."""

    def run(batches):
        held: dict[str, np.ndarray] = {}

        def out():
            for lang, counts in held.items():
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used - 1, pa.int32()), pa.array(counts[used], pa.int64())], ["lang", "bucket", "n"])
            held.clear()

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang not in held:
                    if len(held) >= _HELD:
                        yield from out()
                    held[lang] = np.zeros(buckets + 1, np.int64)
                held[lang][0] += 1
                held[lang][1:] += np.bincount(grams(text or "", buckets), minlength=buckets)
        yield from out()

    labelled = small_batches(rows).where(F.col(lang_col).isNotNull()).select(F.col(text_col), F.col(lang_col))
    return labelled.mapInArrow(run, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS, smoothing: float = 0.5, block: int = LANGUAGES) -> list[Model]:
    """A model of all labelled rows, in blocks of at most ``block`` languages in order. The counts
    of one block are on the driver at a time; a model of none is no block."""
    languages = sorted(r[0] for r in rows.where(F.col(lang_col).isNotNull()).select(lang_col).distinct().toLocalIterator())
    if not languages:
        return []
    found = checkpoint(bucket_counts(rows, text_col, lang_col, buckets)) if len(languages) > block else bucket_counts(rows, text_col, lang_col, buckets)
    out, total = [], 0.0
    for k in range(0, len(languages), block):
        some = languages[k : k + block]
        mine = found.where((F.col("lang") >= some[0]) & (F.col("lang") <= some[-1])) if len(languages) > block else found
        mine, counts = mine.toArrow(), np.zeros((buckets + 1, len(some)))
        place = np.searchsorted(some, mine["lang"].to_numpy(zero_copy_only=False).astype(str))
        counts[mine["bucket"].to_numpy() + 1, place] = mine["n"].to_numpy()
        documents, counts = counts[0], counts[1:] + smoothing
        total += documents.sum()
        out.append(Model(some, documents, np.log(counts / counts.sum(axis=0)).astype(np.float32)))
    for model in out:
        model.prior = np.log(np.maximum(model.prior, 1) / max(total, 1))
    return out


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """crc32 of the id as text leaves ``part`` modulo ``parts``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row, learnt from the labelled rows not held out.

    A null text, or one without a letter, gets ``und`` and score 0, as all do if there is
    nothing to learn from. A row with a null id isn't learnt from nor held out. Repeated rows
    come back as often as they went in; an empty table gives none; other columns are ignored.
    """
    models = train(docs.where(~held_out(id_col)), text_col, lang_col)
    rows = small_batches(docs).select(F.col(id_col).alias("doc_id"), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), F.col(text_col).alias("_text"))
    return predicted(rows, 2, models, "lang_pred", "score").select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows that are in no language; all columns stay. One pass, no join.

    A text is in none if it is null or has no letter. That is the whole rule: no language is
    turned away, nor a low score, since short and mixed texts have one too. Where there is
    nothing to learn from, texts with letters stay all the same. Repeated rows and rows with a
    null id stay by their texts; an empty table gives none.
    """
    models = train(docs.where(~held_out(id_col)), text_col, lang_col)
    name, score = fresh(docs, "lang_pred"), fresh(docs, "score")
    if models:
        rows = predicted(small_batches(docs), docs.columns.index(text_col), models, name, score)
        return rows.where(F.col(name) != "und").select(*docs.columns)
    at = docs.columns.index(text_col)

    def lettered(batches):
        for batch in batches:
            yield batch.filter(pa.array([bool(t and _LETTER.search(t)) for t in batch.column(at).to_pylist()], pa.bool_()))

    return small_batches(docs).mapInArrow(lettered, docs.schema)
