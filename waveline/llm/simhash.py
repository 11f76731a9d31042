"""SimHash near-dedup: fingerprints, a byte-position inverted index with count filtering, components.

Two 64-bit fingerprints at ``max_bits`` (2) or fewer differing bits differ in at most two of
their eight positional bytes, so they share at least six. The index holds, for every
fingerprint, the postings of its positional bytes; lists of single bytes would have 1/256 of
all fingerprints each and pairs as the square of that, so a list is keyed by four positional
bytes at once (two of the four byte pairs; six lists a fingerprint). With two pairs of bytes
free to differ, every pair of close fingerprints meets in at least one list. Pairs that meet
get their shared positional bytes tallied, those with fewer than the guaranteed minimum are
dropped, and the rest are verified by their differing bits.

A list of more than ``max_list`` fingerprints (large groups of near copies) isn't paired: its
members go through an exact linear path instead. Each emits itself and its 64 one-bit
neighbours; two fingerprints are at two or fewer bits if and only if they emit a common word,
and at most 65 can emit the same one, so linking the emitters of a word to its smallest makes
the same components without pairs.

Two bits find copies that are all but exact. ``similar_nodes`` is for a set similarity instead
(Jaccard of word shingles, 0.8 in the pipeline), where 64-bit fingerprints differ in ten bits on
average and up to twenty, so that no byte need be shared. There, the fingerprint is 200
positional bytes, each of another minimum hash, and a pair shares each of them with the chance
of its similarity: lists are keyed by five positional bytes at once (40 lists; a pair at 0.8
misses all with a chance of 1e-7), the shared bytes of pairs that meet are tallied, those under
the minimum that a pair at 0.8 reaches (chance of less 2e-8) are dropped, and the rest are
verified by their whole shingle sets.
"""

from __future__ import annotations

import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waveline.llm.common import bounded_broadcast, checkpoint, small_batches
from waveline.llm.components import connected_components, joined_components

SEED, SHINGLE, MAX_BITS, MAX_LIST = 42, 3, 2, 64
#: Lists that a set is in, and positional bytes that key a list.
BANDS, BAND = 40, 5
BYTES = BANDS * BAND
#: Members of a block of a list, and bytes of their packed sets, on average at most, where a list's
#: members are compared with each other; a larger set is a block of its own.
BLOCK, BLOCK_BYTES = 256, 1 << 20
_MULT, _ADD = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BYTES, 1)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
#: Positional bytes by twos, and the two of these four that key a list.
_BLOCKS = list(combinations(range(4), 2))


def shingle_hashes(data: bytes, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Hashes of a UTF-8 text's shingles in order; of all its words if they are fewer; none without words."""
    words = data.lower().split()  # of bytes: only A-Z change, only ASCII white space divides
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n < 2:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[:n].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return np.fromiter((xxhash.xxh64_intdigest(joined[s:e], seed) for s, e in spans), np.uint64, n)


def fingerprint(data: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned SimHash of a UTF-8 text: a bit is set if over half of the shingle hashes have it."""
    hashes = shingle_hashes(data, shingle, seed)
    if not len(hashes):
        return 0
    bits = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65536):
        part = np.unpackbits(hashes[k : k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits += part.sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` of every row, fp a signed long; a null text has no words."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            fps = np.fromiter((fingerprint(t or b"") for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return small_batches(docs).select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"doc_id {kind}, fp bigint")


def _bytes_shared(a: Column, b: Column) -> Column:
    differing = a.bitwiseXOR(b)
    return sum((F.shiftrightunsigned(differing, 8 * k).bitwiseAND(255) == 0).cast("int") for k in range(8))


def _postings(fps: DataFrame) -> DataFrame:
    """(list, fp): the list's number in the high word, its four positional bytes in the low."""
    part = lambda k: F.shiftrightunsigned("fp", 16 * k).bitwiseAND(0xFFFF)
    keys = [F.lit(n << 32) + part(i) * 65536 + part(j) for n, (i, j) in enumerate(_BLOCKS)]
    return fps.select(F.explode(F.array(*keys)).alias("list"), "fp")


def links(fps: DataFrame, max_bits: int = MAX_BITS, max_list: int = MAX_LIST) -> DataFrame:
    """Edges ``(a, b)`` over distinct fingerprints whose components are those of all pairs at ``max_bits`` or fewer.

    Pairs from lists of at most ``max_list`` come whole; those of longer lists as stars.
    """
    if max_bits > 2:
        raise ValueError("lists of four positional bytes find pairs at two differing bits at most")
    least = 8 - max_bits
    postings = _postings(fps)
    sizes = checkpoint(postings.groupBy("list").agg(F.count("*").alias("n")).where("n > 1"))
    met = postings.join(sizes, "list")
    light = met.where(F.col("n") <= max_list).select("list", "fp")
    a, b = light.select("list", F.col("fp").alias("a")), light.select("list", F.col("fp").alias("b"))
    pairs = a.join(b, "list").where("a < b").where(_bytes_shared(F.col("a"), F.col("b")) >= least)
    edges = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b")
    if not sizes.where(F.col("n") > max_list).head(1):
        return edges
    heavy = met.where(F.col("n") > max_list).select("fp").distinct()
    flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(1 << k if k < 63 else -(1 << 63))) for k in range(64)]
    if max_bits == 2:
        near = heavy.select(F.explode(F.array(*flips)).alias("word"), "fp")
        stars = near.groupBy("word").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)  # 65 at most
        stars = stars.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a <> b")
    else:  # one bit: a fingerprint meets a neighbour's own word
        own = heavy.select(F.col("fp").alias("b"))
        near = heavy.select(F.explode(F.array(*flips[1:])).alias("b"), F.col("fp").alias("a"))
        stars = near.join(own, "b").select("a", "b").where(F.lit(max_bits == 1))
    return edges.unionByName(stars.distinct())


def minima(own: np.ndarray) -> np.ndarray:
    """The least value of a set under each of the hash functions."""
    least = np.full(BYTES, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(own), 256):
        mixed = (own[k : k + 256] ^ (own[k : k + 256] >> np.uint64(29))) * _MULT + _ADD
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(32))).min(axis=1))
    return least


def pack_set(own: np.ndarray) -> bytes:
    """A sorted set of hashes by their upper 40 bits: steps as byte planes, compressed."""
    steps = np.diff(own >> np.uint64(24), prepend=np.uint64(0))
    return zlib.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :5].T).tobytes(), 1)


def unpack_set(data: bytes) -> np.ndarray:
    """The 40-bit hashes of a packed set, sorted."""
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(5, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :5] = planes.T
    return np.cumsum(wide.view(np.uint64).ravel())


def sketch(data: bytes, shingle: int) -> tuple[int, bytes | None, bytes]:
    """A node, the same for texts of one shingle set; its positional bytes; the packed set itself."""
    own = np.unique(shingle_hashes(data, shingle))
    node = xxhash.xxh64_intdigest(own.tobytes(), SEED)
    return node, (minima(own) >> np.uint64(13)).astype(np.uint8).tobytes() if len(own) else None, pack_set(own)


def sketches(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, node, bytes, shingles)`` of every row; a null text has no words and no bytes."""

    def run(batches):
        for batch in batches:
            found = [sketch(t or b"", shingle) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            nodes = np.array([f[0] for f in found], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes), pa.array([f[1] for f in found], pa.binary()), pa.array([f[2] for f in found], pa.binary())], ["doc_id", "node", "bytes", "shingles"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    rows = small_batches(docs).select(F.col(id_col), F.col(text_col))
    return rows.mapInArrow(run, f"doc_id {kind}, node bigint, bytes binary, shingles binary")


def least_tally(similarity: float) -> int:
    """The positional bytes that a pair at this similarity shares at least, but for a chance of 2e-8."""
    rate = similarity + (1 - similarity) / 256
    return int(BYTES * rate - 5.5 * (BYTES * rate * (1 - rate)) ** 0.5)


def _nodes(wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """``(node, bytes, shingles)`` of the ``wanted`` nodes, once each."""
    few = bounded_broadcast(checkpoint(wanted.distinct()))
    return rows.select("node", "bytes", "shingles").join(few, "node", "left_semi").groupBy("node").agg(F.first("bytes").alias("bytes"), F.first("shingles").alias("shingles"))


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets have at least this Jaccard similarity."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= similarity * (len(a) + len(b) - common) - 1e-9


def _verified(pairs: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` that share enough positional bytes, and by whole shingle sets are similar enough."""
    known = checkpoint(_nodes(pairs.select(F.explode(F.array("a", "b")).alias("node")), rows))
    wide = pairs.join(known.select(F.col("node").alias("a"), F.col("bytes").alias("ta"), F.col("shingles").alias("sa")), "a")
    wide = wide.join(known.select(F.col("node").alias("b"), F.col("bytes").alias("tb"), F.col("shingles").alias("sb")), "b")
    least = least_tally(similarity)

    def run(batches):
        for batch in batches:
            ta, tb = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, BYTES) for k in (2, 3))
            met = np.flatnonzero((ta == tb).sum(axis=1) >= least).tolist()
            keep = [i for i in met if alike(unpack_set(batch.column(4)[i].as_py()), unpack_set(batch.column(5)[i].as_py()), similarity)]
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], ["a", "b"])

    return checkpoint(small_batches(wide).select("a", "b", "ta", "tb", "sa", "sb").mapInArrow(run, "a bigint, b bigint"))


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set of the left shares with each of the right: a product over those that several sets have."""
    of = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    found, place, n = np.unique(of, return_inverse=True, return_counts=True)
    column = np.cumsum(n > 1) - 1
    use = (n > 1)[place]
    row, place = row[use], column[place[use]]
    width, out = int((n > 1).sum()), np.zeros((len(left), len(right)))
    for lo in range(0, width, 1 << 14):
        part = (place >= lo) & (place < lo + (1 << 14))
        matrix = np.zeros((len(left) + len(right), min(1 << 14, width - lo)), np.float32)
        matrix[row[part], place[part] - lo] = 1
        out += matrix[: len(left)] @ matrix[len(left) :].T
    return out


def _joining(table: pa.Table, similarity: float) -> pa.Table:
    """Of two blocks of a list, links that join components: no more than there are members."""
    side, nodes, parts = (table[c].to_numpy() for c in ("side", "node", "component"))
    sets = [unpack_set(x) for x in table["shingles"].to_pylist()]
    left, right = np.flatnonzero(side & 1), np.flatnonzero(side & 2)
    common = common_counts([sets[i] for i in left], [sets[i] for i in right])
    sizes = np.array([len(x) for x in sets])
    met = common >= similarity * (sizes[left][:, None] + sizes[right] - common) - 1e-9
    met &= parts[left][:, None] != parts[right]
    of = {p: p for p in set(parts.tolist())}

    def root(p):
        while of[p] != p:
            of[p] = of[of[p]]
            p = of[p]
        return p

    out = []
    for i, j in np.argwhere(met).tolist():
        p, q = root(parts[left[i]].item()), root(parts[right[j]].item())
        if p != q:
            of[p] = q
            out.append((nodes[left[i]].item(), nodes[right[j]].item()))
    return pa.table({"a": pa.array([x[0] for x in out], pa.int64()), "b": pa.array([x[1] for x in out], pa.int64())})


def similar_nodes(rows: DataFrame, similarity: float) -> DataFrame:
    """``(node, component)`` of the sketched nodes that have a neighbour at this similarity.

    First the members of each list are compared with its smallest only, which settles groups of
    near copies by stars. Where that leaves a list's members in several components, those outside
    the largest one are compared with all others, exactly and in blocks of BLOCK members; a pair
    of blocks gives only links that join components. No pair that could be a link is left out.
    """
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring(F.col("bytes"), k * BAND + 1, BAND)) for k in range(BANDS)])
    postings = rows.where("bytes is not null").select("node", F.octet_length("shingles").alias("size"), F.explode(keys).alias("list"))
    hubs = checkpoint(postings.groupBy("list").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub <> last").select("list", "hub"))
    met = checkpoint(postings.join(hubs, "list").distinct())
    edges = _verified(checkpoint(met.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()), rows, similarity)
    part = checkpoint(connected_components(edges))
    of = checkpoint(met.join(part, "node", "left").select("list", "node", "size", F.coalesce("component", "node").alias("component")))
    blocks = lambda n, size: F.ceil(F.greatest(n / BLOCK, size / BLOCK_BYTES)).cast("int")
    sizes = of.groupBy("list", "component").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    lists = sizes.groupBy("list").agg(F.max(F.struct("n", "component", "size")).alias("most"), F.sum("n").alias("n"), F.sum("size").alias("size"), F.count("*").alias("parts"))
    lists = lists.where("parts > 1 and n > 2")  # of two, one is the hub
    strays = blocks(F.col("n") - F.col("most.n"), F.col("size") - F.col("most.size"))
    lists = checkpoint(lists.select("list", F.col("most.component").alias("main"), blocks(F.col("most.n"), F.col("most.size")).alias("mains"), strays.alias("strays")))
    placed = of.join(lists, "list")
    stray = F.col("component") != F.col("main")
    own = F.pmod(F.xxhash64("node"), F.when(stray, F.col("strays")).otherwise(F.col("mains"))).cast("int") + F.when(stray, 0).otherwise(F.col("strays"))
    # Blocks of strays come first; a pair of blocks i <= j has strays as i, and any block as j.
    placed = placed.select("list", "node", "component", own.alias("own"), F.when(stray, F.col("strays") + F.col("mains")).otherwise(F.col("strays")).alias("n"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    side = F.when(F.col("own") == F.col("other"), 3).when(F.col("own") < F.col("other"), 1).otherwise(2)
    other = other.select("list", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "component", side.cast("int").alias("side"))
    known = checkpoint(_nodes(placed.select("node"), rows).select("node", "shingles"))
    more = other.join(known, "node").groupBy("list", "i", "j").applyInArrow(lambda t: _joining(t, similarity), "a bigint, b bigint")
    return joined_components(part, more)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, max_list: int = MAX_LIST) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row, component_id the smallest doc_id reachable.

    Null or wordless texts have fingerprint zero and link like any other. Repeated rows come
    back as often as they went in. A null id gets a fingerprint and its component, and never
    names one. An empty table gives none. Other columns are ignored.
    """
    rows = checkpoint(fingerprints(docs, id_col, text_col))
    fps = checkpoint(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    of = _named(fps, connected_components(links(fps.select("fp"), max_bits, max_list)))
    return rows.join(of, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _named(fps: DataFrame, found: DataFrame) -> DataFrame:
    """``(fp, component_id)`` of fingerprints with their least id, by the components found among them."""
    of = fps.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    of = checkpoint(of.select("fp", "least", F.coalesce("component", "fp").alias("component")))
    named = checkpoint(of.groupBy("component").agg(F.min("least").alias("component_id")))
    return checkpoint(of.join(named, "component").select("fp", "component_id"))


def similar(docs: DataFrame, shingle: int, similarity: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, component_id)`` of every row, components by the Jaccard similarity of shingle sets.

    Ids, null texts and repeated rows are as in ``near_duplicates``; texts of fewer words than
    a shingle have the whole as one, texts without words are copies of each other.
    """
    rows = checkpoint(sketches(docs, shingle, id_col, text_col))
    least = checkpoint(rows.groupBy(F.col("node").alias("fp")).agg(F.min("doc_id").alias("least")))
    of = _named(least, similar_nodes(rows, similarity))
    return rows.select("doc_id", F.col("node").alias("fp")).join(of, "fp").select("doc_id", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float | None = None) -> DataFrame:
    """``docs`` without the rows whose component has a smaller id; all columns stay.

    Components are of close fingerprints, or of shingle sets if a ``similarity`` is given. Null
    and wordless texts are copies of each other. Rows that repeat an id that stays all stay, and
    so does a null id, which is compared but never dropped. An empty table gives no rows. Ids to
    drop are broadcast if they are few in bytes; else whole rows are shuffled.
    """
    found = near_duplicates(docs, id_col, text_col) if similarity is None else similar(docs, shingle, similarity, id_col, text_col)
    gone = checkpoint(found.where("doc_id <> component_id").select(F.col("doc_id").alias(id_col)).distinct())
    return docs.join(bounded_broadcast(gone), id_col, "left_anti").select(*docs.columns)
