"""Hard-negative mining by a two-dimensional block product of anchors and all rows.

Rows are packed into blocks of bounded size, each cut into chunks of dimensions, so that a
block's chunk is a small integer matrix. Anchor blocks go to every block of rows that they are to
be scored against, chunk by chunk; a task multiplies two chunks to a partial tile of int64 scores,
partial tiles of one pair of blocks are shuffled together and added, and a tile gives only its
best rows of each anchor or of each anchor-positive window, which are reduced to the best of all.

Positives need the tiles of blocks that share a label only, and are found first; the negatives'
windows follow from their scores. No tile outlives its task: what a tile gives grows with the
anchors, not with the rows. The labels of blocks, blocks and tiles pass no single task, and
rows are dealt to blocks in order of label and a hash, so a label of a third of all rows is as
many blocks as it needs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waveline.llm.common import stored

#: Fixed values of the task: components are scaled and floored; the windows are hundredths of the positive's score.
SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
#: Rows of a block, anchors of one and dimensions of a chunk, at most.
ROWS, ANCHORS, CHUNK = 2048, 512, 32
#: Groups that the blocks of rows are divided into where all pairs of blocks are formed.
GROUPS = 256
#: Exact in a float: products of whole numbers are made by it where no sum can pass this.
_EXACT = float(1 << 53)


def quantized(rows: DataFrame, id_col: str, label_col: str, vector_col: str, anchor: Column) -> DataFrame:
    """``(id, label, q, anchor)`` of the rows that take part, equal ones once."""
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    known = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & vector.isNotNull()).where(finite)
    q = F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("bigint"))
    out = known.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), q.alias("q"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    return out.distinct().withColumn("key", F.xxhash64("label", "q"))  # rows of one id that differ


_BLOCK = pa.schema([("block", pa.int64()), ("chunk", pa.int32()), ("labels", pa.list_(pa.int64())), ("ids", pa.binary()), ("of", pa.binary()), ("keys", pa.binary()), ("data", pa.binary())])
_BLOCK_TYPE = "block bigint, chunk int, labels array<bigint>, ids binary, of binary, keys binary, data binary"


def blocks(rows: DataFrame, size: int, chunk: int) -> DataFrame:
    """A row of each block and chunk of dimensions: its ids, its labels and its matrix.

    Stored, so that a block stays what it is. Vectors of other lengths are as if zeros followed.
    """

    def work(batches):
        n, base = 0, TaskContext.get().partitionId() << 32

        def pack(part: pa.RecordBatch):
            nonlocal n
            ids, labels, keys = (part.column(k).to_numpy() for k in range(3))
            order = np.argsort(ids, kind="stable")
            lists = part.column(3)
            values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            lengths = np.diff(offsets)
            whole = np.zeros((len(ids), -(-max(int(lengths.max()), 1) // chunk) * chunk), np.int64)
            of = np.repeat(np.arange(len(ids)), lengths)
            whole[of, np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values[offsets[0] : offsets[-1]]
            whole = whole[order]
            rows = [{"block": base | n, "chunk": k, "labels": np.unique(labels).tolist(), "ids": ids[order].tobytes(), "of": labels[order].tobytes(), "keys": keys[order].tobytes(), "data": np.ascontiguousarray(whole[:, k * chunk : (k + 1) * chunk]).tobytes()} for k in range(whole.shape[1] // chunk)]
            n += 1
            return pa.RecordBatch.from_pylist(rows, _BLOCK)

        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            while batch.num_rows:
                take = min(size - count, batch.num_rows)
                held.append(batch.slice(0, take))
                count, batch = count + take, batch.slice(take)
                if count == size:
                    yield pack(_one(held))
                    held, count = [], 0
        if count:
            yield pack(_one(held))

    dealt = rows.withColumn("_h", F.xxhash64("id", "key"))
    parts = max(1, -(-rows.count() // (4 * size)))
    dealt = dealt.repartitionByRange(parts, "label", "_h").sortWithinPartitions("label", "_h").select("id", "label", "key", "q")
    return stored(dealt.mapInArrow(work, _BLOCK_TYPE), "negatives-blocks")


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


_TILE = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int32()), ("tile", pa.binary())])


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a`` times the transpose of ``b``, exact modulo 2^64."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def tiles(pairs: DataFrame, anchors: DataFrame, others: DataFrame, chunk: int) -> DataFrame:
    """Partial score tiles ``(a, b, n, tile)``: one for each pair of blocks and chunk of dimensions.

    Chunks that one side lacks are zeros there and add nothing.
    """

    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                a, b = (np.frombuffer(row[c], np.int64).reshape(-1, chunk) for c in ("_a", "_b"))
                yield pa.RecordBatch.from_pylist([{"a": row["a"], "b": row["b"], "n": len(b), "tile": _product(a, b).tobytes()}], _TILE)

    left = pairs.join(anchors.select(F.col("block").alias("a"), "chunk", F.col("data").alias("_a")), "a")
    both = left.join(others.select(F.col("block").alias("b"), "chunk", F.col("data").alias("_b")), ["b", "chunk"])
    return both.select("a", "b", "_a", "_b").mapInArrow(work, "a bigint, b bigint, n int, tile binary")


def _added(partial: DataFrame, sides: list[DataFrame], work, schema: str) -> DataFrame:
    """Tiles as the sums of their partial ones, with what is known of their blocks: ``work``'s rows of each."""
    rows = partial.select("a", "b", F.lit(0).alias("side"), "n", F.col("tile").alias("x"), F.lit(None).cast("binary").alias("y"), F.lit(None).cast("binary").alias("z"))
    for side in sides:
        rows = rows.unionByName(side)

    def one(table: pa.Table) -> pa.Table:
        side, total, known = table["side"].to_pylist(), None, {}
        for k, of in enumerate(side):
            if of:
                known.setdefault(of, [table[c][k].as_py() for c in "xyz"])
                continue
            tile = np.frombuffer(table["x"][k].as_py(), np.int64)
            total = tile.copy() if total is None else np.add(total, tile, out=total)
        n = next((table["n"][k].as_py() for k, of in enumerate(side) if not of), 1)
        return work(None if total is None else total.reshape(-1, n), known)

    return rows.groupBy("a", "b").applyInArrow(one, schema)


def _heads(pairs: DataFrame, of: DataFrame, key: str, side: int) -> DataFrame:
    """Ids, labels and keys of a block, for every tile it is part of."""
    heads = of.where("chunk = 0").select(F.col("block").alias(key), F.col("ids").alias("x"), F.col("of").alias("y"), F.col("keys").alias("z"))
    return pairs.join(heads, key).select("a", "b", F.lit(side).alias("side"), F.lit(0).alias("n"), "x", "y", "z")


def _ints(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k``: higher scores, then smaller ids (``ids`` ascend)."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.argsort(-scores[some], kind="stable")[:k]]
    return np.argsort(-scores, kind="stable")[:k]


_BEST = "anchor_id bigint, anchor_key bigint, positive_id bigint, positive_score bigint"


def positives(pairs: DataFrame, anchors: DataFrame, others: DataFrame, chunk: int, count: int = POSITIVES) -> DataFrame:
    """``(anchor_id, anchor_key, positive_id, positive_score)``: the first other rows of each anchor's label."""

    def work(tile: np.ndarray | None, known: dict) -> pa.Table:
        cols: list[list[np.ndarray]] = [[], [], [], []]
        if tile is not None:
            (ids, labels, keys), (others_, other_labels, _) = ([_ints(x) for x in known[s]] for s in (1, 2))
            for i in range(len(ids)):
                some = np.flatnonzero((other_labels == labels[i]) & (others_ != ids[i]))
                best = some[_first(tile[i, some], others_[some], count)]
                for col, x in zip(cols, (np.full(len(best), ids[i]), np.full(len(best), keys[i]), others_[best], tile[i, best]), strict=True):
                    col.append(x)
        return pa.Table.from_arrays([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in cols], ["anchor_id", "anchor_key", "positive_id", "positive_score"])

    # Same labels only: pairs of blocks that share one.
    near = pairs.where("same").select("a", "b")
    best = _added(tiles(near, anchors, others, chunk), [_heads(near, anchors, "a", 1), _heads(near, others, "b", 2)], work, _BEST)
    order = Window.partitionBy("anchor_id", "anchor_key").orderBy(F.col("positive_score").desc(), "positive_id")
    return best.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= count).drop("_k")


def _wanted(found: DataFrame, anchors: DataFrame) -> DataFrame:
    """The positives of each anchor block, packed: anchor, key, positive, its score."""

    def pack(table: pa.Table) -> pa.Table:
        data = np.stack([table[c].to_numpy() for c in ("anchor_id", "anchor_key", "positive_id", "positive_score")])
        return pa.Table.from_arrays([table["a"].slice(0, 1), pa.array([data.astype(np.int64).tobytes()], pa.binary())], ["a", "z"])

    def opened(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, keys = _ints(row["ids"]), _ints(row["keys"])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), row["block"])), pa.array(ids), pa.array(keys)], ["a", "anchor_id", "anchor_key"])

    places = anchors.where("chunk = 0").select("block", "ids", "keys").mapInArrow(opened, "a bigint, anchor_id bigint, anchor_key bigint").distinct()
    return found.join(places, ["anchor_id", "anchor_key"]).groupBy("a").applyInArrow(pack, "a bigint, z binary")


_FOUND = "anchor_id bigint, anchor_key bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", size: int = ROWS, anchors_size: int = ANCHORS, chunk: int = CHUNK) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows where ``anchor`` holds; components count as ``floor(256 * x)`` and scores
    are integer inner products. An anchor's positives are its first five rows of its label with
    another id; for each, its first ten rows of other labels with a score of 30 to 90 hundredths
    of the positive's. Higher scores come first, of equal ones the smaller id.

    Rows with a null id, label, vector or component, or one that isn't finite, take no part, nor
    do empty results have rows: an anchor without positives, a positive without negatives, an
    empty table. Rows that agree in id, label and components count once; rows of one id that
    differ each count and are mined each, under their one id. Shorter vectors
    are as if zeros followed. Scores must fit 64 bits. Other columns are ignored.
    """
    known = stored(quantized(rows, id_col, label_col, vector_col, anchor), "negatives-rows")
    others, anchors = blocks(known, size, chunk), blocks(known.where("anchor"), anchors_size, chunk)
    heads = anchors.where("chunk = 0").select(F.col("block").alias("a"), F.explode("labels").alias("label"))
    theirs = others.where("chunk = 0").select(F.col("block").alias("b"), F.explode("labels").alias("label"))
    same = heads.join(theirs, "label").select("a", "b").distinct().withColumn("same", F.lit(True))
    # A block of anchors meets every block of rows, the stated queries against all rows: it goes to
    # each of some groups of blocks, so that no task holds all pairs.
    told = anchors.where("chunk = 0").select(F.col("block").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(GROUPS - 1))).alias("_g"))
    every = told.join(others.where("chunk = 0").select(F.col("block").alias("b"), F.pmod(F.xxhash64("block"), F.lit(GROUPS)).cast("int").alias("_g")), "_g").drop("_g")
    pairs = stored(every.join(same, ["a", "b"], "left").fillna(False, ["same"]).repartition("a", "b"), "negatives-tiles")
    found = stored(positives(pairs, anchors, others, chunk), "negatives-positives")
    wanted = stored(_wanted(found, anchors), "negatives-wanted")

    def work(tile: np.ndarray | None, known: dict) -> pa.Table:
        cols: list[list] = [[] for _ in range(6)]
        if tile is not None and 3 in known:
            (ids, labels, keys), (others_, other_labels, _) = ([_ints(x) for x in known[s]] for s in (1, 2))
            asked = _ints(known[3][2]).reshape(4, -1)
            place = {x: i for i, x in enumerate(zip(ids.tolist(), keys.tolist(), strict=True))}
            rows_of: dict[int, list[int]] = {}
            for k, x in enumerate(zip(asked[0].tolist(), asked[1].tolist(), strict=True)):
                rows_of.setdefault(place[x], []).append(k)
            for i, of in rows_of.items():
                some = np.flatnonzero(other_labels != labels[i])
                scores = tile[i, some]
                for k in of:
                    score = int(asked[3, k])
                    lo, hi = -(-LOW * score // 100), HIGH * score // 100
                    inside = np.flatnonzero((scores >= lo) & (scores <= hi))
                    best = inside[_first(scores[inside], others_[some[inside]], NEGATIVES)]
                    for col, x in zip(cols, (*asked[:, k], others_[some[best]], scores[best]), strict=True):
                        col.append(x if isinstance(x, np.ndarray) else np.full(len(best), x))
        return pa.Table.from_arrays([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in cols], ["anchor_id", "anchor_key", "positive_id", "positive_score", "negative_id", "negative_score"])

    asked = pairs.select("a", "b").join(wanted, "a").select("a", "b", F.lit(3).alias("side"), F.lit(0).alias("n"), F.lit(None).cast("binary").alias("x"), F.lit(None).cast("binary").alias("y"), "z")
    all_of = pairs.select("a", "b")
    best = _added(tiles(all_of, anchors, others, chunk), [_heads(all_of, anchors, "a", 1), _heads(all_of, others, "b", 2), asked], work, _FOUND)
    order = Window.partitionBy("anchor_id", "anchor_key", "positive_id", "positive_score").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEGATIVES)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
