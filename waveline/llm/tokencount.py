"""Token counts: pieces once per distinct pre-token, joined to per-document frequencies, summed.

For byte-level BPE a text's tokens are its pre-tokens' pieces one after the other, so a count
needs no ids of the text:

1. one pass over the texts writes a row for each block of documents (bounded rows and bytes):
   the block's distinct pre-tokens, and each document's frequencies by their places in it;
2. the blocks' pre-tokens are dealt out by themselves, so that equal ones of all documents meet
   in one task, where each is encoded once and its number of pieces joined to its places;
3. a block's numbers meet its frequencies, a row on either side, and are summed by document.

A frequency is two small numbers, packed, in its block's row; a row for each distinct pre-token
of each document, to be shuffled by pre-token, would be more than the texts.
"""

from __future__ import annotations

import json
import os
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waveline.llm.common import small_batches, stored

#: The byte-level pre-tokenizer's pattern.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Documents and characters of a block at most, and characters divided at once; a longer text is a block of its own.
BLOCK_ROWS, BLOCK_CHARS, PART_CHARS = 50_000, 32 << 20, 2 << 20
_counters: dict[str, TokenCounter] = {}


class TokenCounter:
    """Counts as the library gives them, without special tokens added; special strings inside texts are its default."""

    def __init__(self, path: str):
        if path.endswith(".json"):
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(path)
            self.library.no_truncation()
            self.library.no_padding()
            spec = json.loads(Path(path).read_text(encoding="utf-8"))
            pre = spec.get("pre_tokenizer") or {}
            added = spec.get("added_tokens") or []
            plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in added)
            self.by_pieces = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer") and plain
            special = sorted((t["content"] for t in added), key=len, reverse=True)
            self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        elif path.endswith(".model"):
            import sentencepiece

            self.library, self.by_pieces = sentencepiece.SentencePieceProcessor(model_file=path), False
        else:
            raise ValueError(f"neither .json nor .model: {path}")
        self.split = regex.compile(BYTE_LEVEL)

    def lengths(self, texts: list[str]) -> list[int]:
        """Pieces of each string, encoded as it is."""
        if hasattr(self.library, "encode_batch"):
            return [len(e) for e in self.library.encode_batch(texts, add_special_tokens=False)]
        return [len(x) for x in self.library.encode(texts, num_threads=1)]

    def pretokens(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens in order, and how many special tokens the text holds. A text is its own
        one pre-token where the file divides it in no independent parts."""
        if not self.by_pieces:
            return [text], 0
        if self.special is None or not self.special.search(text):
            return self.split.findall(text), 0
        parts = self.special.split(text)
        return [p for part in parts for p in self.split.findall(part)], len(parts) - 1

    def count(self, texts: list[str]) -> list[int]:
        """Token counts of a few texts, by the same steps in one process."""
        block = Block(self)
        block.add(texts)
        return block.sums(np.array(self.lengths(list(block.places)), np.int64)).tolist()


class Block:
    """Texts as frequencies of the block's distinct pre-tokens, which are told by their places."""

    def __init__(self, of: TokenCounter):
        self.of, self.places, self.chars, self.rows = of, {}, 0, 0
        self.ends: list[np.ndarray] = []  # where each text's frequencies end
        self.at: list[np.ndarray] = []  # the places they are of
        self.n: list[np.ndarray] = []
        self.special: list[int] = []  # special tokens of each text
        self.sizes: list[int] = []

    def add(self, texts: list[str]) -> None:
        found, ends = [], []
        for text in texts:
            parts, n = self.of.pretokens(text)
            found += parts
            ends.append(len(found))
            self.special.append(n)
            self.sizes.append(len(text.encode("utf-8", "surrogatepass")))
            self.chars += len(text)
        coded = pa.array(found, pa.large_string()).dictionary_encode()
        pieces, places = coded.dictionary.to_pylist(), self.places
        own = np.fromiter((places.setdefault(p, len(places)) for p in pieces), np.int64, len(pieces))
        row = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(ends, prepend=0))
        wide = max(1, len(places))
        keys, n = np.unique(row * wide + own[coded.indices.to_numpy()], return_counts=True)
        before = int(self.ends[-1][-1]) if self.rows else 0
        self.ends.append(before + np.searchsorted(keys, np.arange(1, len(texts) + 1) * wide))
        self.at.append((keys % wide).astype(np.int32))
        self.n.append(n.astype(np.int32))
        self.rows += len(texts)

    def sums(self, lengths: np.ndarray) -> np.ndarray:
        return sums(lengths, *(np.concatenate(x) for x in (self.ends, self.at, self.n))) + np.array(self.special, np.int64)


def sums(lengths: np.ndarray, ends: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Each text's sum of its pre-tokens' lengths by their frequencies."""
    so_far = np.concatenate(([0], np.cumsum(lengths[at] * n.astype(np.int64)))) if len(at) else np.zeros(1, np.int64)
    return np.diff(so_far[ends], prepend=0)


def counter(path: str) -> TokenCounter:
    """The worker's counter for a vocabulary file."""
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def _parts(texts: list[str]) -> list[slice]:
    """Consecutive texts of PART_CHARS together."""
    out, at, size = [], 0, 0
    for k, text in enumerate(texts):
        if k > at and size + len(text) > PART_CHARS:
            out.append(slice(at, k))
            at, size = k, 0
        size += len(text)
    return [*out, slice(at, len(texts))] if texts else out


def _packed(*arrays: np.ndarray) -> bytes:
    """Small whole numbers, as byte planes (the higher ones nearly empty), compressed."""
    flat = np.concatenate([a.astype("<i4") for a in arrays])
    return zlib.compress(np.ascontiguousarray(flat.view(np.uint8).reshape(-1, 4).T).tobytes(), 3)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One row that holds all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every whole text; a null text is empty.

    ``vocabulary`` is a file's path that holds on all executors. Repeated rows and null ids
    come back as they went in; an empty table gives none; other columns are ignored.
    """
    kind = docs.select(id_col).schema[0].dataType.simpleString()

    def divide(batches):
        """A row for each block; its number is the task's and its own, told apart by their bits."""
        from pyspark import TaskContext

        of, k = counter(vocabulary), TaskContext.get().partitionId() << 32
        block, ids = Block(of), []

        def row() -> pa.RecordBatch:
            pieces = pa.array(list(block.places), pa.string())
            whole = pa.concat_arrays(ids)
            cols = [pa.array([k], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces)]
            cols += [pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole), _lists(np.array(block.sizes), pa.int64()), _lists(np.array(block.special), pa.int64())]
            ends, at, n = (np.concatenate(x) for x in (block.ends, block.at, block.n))
            steps = np.diff(at, prepend=0)  # places rise inside a text: steps are small
            cols += [pa.array([_packed(np.diff(ends, prepend=0), steps, n)], pa.binary())]
            return pa.RecordBatch.from_arrays(cols, ["block", "pieces", "ids", "sizes", "special", "frequencies"])

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for cut in _parts(texts):
                part = texts[cut]
                if block.rows and (block.rows + len(part) > BLOCK_ROWS or block.chars + sum(map(len, part)) > BLOCK_CHARS):
                    yield row()
                    block, ids, k = Block(of), [], k + 1
                block.add(part)
                ids.append(batch.column(0).slice(cut.start, len(part)))
        if block.rows:
            yield row()

    def lengths(batches):
        """Equal pre-tokens come to one task: each is encoded once there."""
        of, known = counter(vocabulary), {}
        for batch in batches:
            pieces = batch.column(2).to_pylist()
            new = list(set(pieces) - known.keys())
            known.update(zip(new, of.lengths(new), strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([known[p] for p in pieces], pa.int32())], ["block", "place", "length"])

    def add(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                sizes, special, place, length = (row.column(k).flatten().to_numpy() for k in (1, 2, 4, 5))
                packed = _unpacked(row.column(3)[0].as_py())
                each, rest = packed[: len(sizes)], packed[len(sizes) :].reshape(2, -1)
                of = np.zeros(len(place), np.int64)
                of[place] = length
                counts = sums(of, np.cumsum(each), np.cumsum(rest[0]), rest[1]) + special
                yield pa.RecordBatch.from_arrays([row.column(0).flatten(), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array(counts > limit, pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    fields = f"block bigint, pieces array<string>, ids array<{kind}>, sizes array<bigint>, special array<bigint>, frequencies binary"
    blocks = stored(small_batches(docs).select(F.col(id_col), F.col(text_col)).mapInArrow(divide, fields), "token-blocks", "zstd")
    dealt = blocks.select("block", F.posexplode("pieces").alias("place", "piece")).repartition(F.col("piece"))
    told = dealt.mapInArrow(lengths, "block bigint, place int, length int")
    told = told.groupBy("block").agg(F.collect_list(F.struct("place", "length")).alias("x"))  # a block is bounded
    none = F.array().cast("array<int>")
    whole = blocks.drop("pieces").join(told, "block", "left")
    whole = whole.select("ids", "sizes", "special", "frequencies", F.coalesce("x.place", none).alias("place"), F.coalesce("x.length", none).alias("length"))
    return whole.mapInArrow(add, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
