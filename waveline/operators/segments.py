"""Raw traces to gap-free segments: which channels, which runs, which samples."""

from __future__ import annotations

import operator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waveline.durable import checkpoint, measured_broadcast, spread
from waveline.functions.names import BANDS, ROLES, band_of, role_letter
from waveline.operators import blocks
from waveline.operators.signal import resample
from waveline.schemas import SEGMENT

RATE_TOLERANCE = 1e-6


def pick_channels(traces: DataFrame, keys: list[str] = ("station", "chunk")) -> DataFrame:
    """``(keys, band, z, n, e)``: the three channel codes of each chunk, all of one band.

    The first band in order of preference, then alphabetically, that has all three roles; a
    role's letters by preference. Chunks without such a band have no row.
    """
    channels = traces.select(*keys, band_of("channel").alias("band"), role_letter("channel").alias("letter")).distinct()
    has = {c: F.max(F.when(F.col("letter") == c, F.col("band"))).isNotNull() for letters in ROLES.values() for c in letters}
    chosen = [F.coalesce(*[F.when(has[c], F.concat("band", F.lit(c))) for c in letters]).alias(role.lower()) for role, letters in ROLES.items()]
    bands = channels.groupBy(*keys, "band").agg(*chosen).where("z is not null and n is not null and e is not null")
    rank = F.lit(len(BANDS))
    for k, b in enumerate(BANDS):
        rank = F.when(F.col("band") == b, k).otherwise(rank)
    best = F.row_number().over(Window.partitionBy(*keys).orderBy(rank, "band"))
    return bands.withColumn("_k", best).where("_k = 1").drop("_k")


def select_traces(traces: DataFrame, code: str) -> DataFrame:
    """A full code selects one channel; a bare role letter every band's."""
    return traces.where(F.upper("channel") == code.upper() if len(code) > 1 else role_letter("channel") == code.upper())


def trace_runs(traces: DataFrame, keys: list[str], fs: float, t0: str = "t0", n: str = "n", seq: str | None = None) -> DataFrame:
    """``traces`` with ``run`` (a number by key) and ``contained``.

    A trace continues a run if it starts at most half a sample after the furthest end so far.
    It is contained if all its samples are covered by traces before it. Of equal starts the
    smaller ``seq`` comes first, or, without one, the longer trace.
    """
    dt = 1.0 / fs
    end = F.col(t0) + F.col(n) * dt
    by = [F.col(t0), F.col(n).desc() if seq is None else F.col(seq)]
    # One order serves all: runs are numbered along it, so what came before in a trace's own run is the greatest of (run, last).
    order = Window.partitionBy(*keys).orderBy(*by)
    before, so_far = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    ahead = F.max(end).over(before)
    cut = F.when(ahead.isNull() | (F.col(t0) > ahead + 0.5 * dt), 1).otherwise(0)
    rows = spread(traces, *keys).withColumn("_cut", cut).withColumns({"run": F.sum("_cut").over(so_far).cast("int") - 1, "_first": F.max(F.when(F.col("_cut") == 1, F.col(t0))).over(so_far)})
    rows = rows.withColumn("_last", F.rint((F.col(t0) - F.col("_first")) / dt).cast("long") + F.col(n))
    rows = rows.withColumn("_ahead", F.max(F.struct("run", "_last")).over(before))
    covered = (F.col("_ahead.run") == F.col("run")) & (F.col("_last") <= F.col("_ahead._last"))
    return rows.withColumn("contained", F.coalesce(covered, F.lit(False))).drop("_cut", "_first", "_last", "_ahead")


def pack_traces(traces: DataFrame) -> DataFrame:
    """Traces ``(station, chunk, channel, seq, t0, fs, data)`` with lists of doubles, in packed pieces."""
    rows = blocks.pack(traces.select("station", "chunk", "channel", "seq", "t0", "fs", "data"))
    size = (F.octet_length("data") / 8).cast("int")
    return rows.select("station", "chunk", "channel", F.col("seq").cast("int").alias("seq"), "t0", "fs", (F.col("block").cast("long") * blocks.BLOCK).alias("at"), size.alias("n"), "data")


def trace_heads(traces: DataFrame) -> DataFrame:
    """``(station, chunk, channel, seq, t0, fs, raw)``: each trace without its samples, ``raw`` of them."""
    return traces.groupBy("station", "chunk", F.upper("channel").alias("channel"), "seq").agg(F.first("t0").alias("t0"), F.first("fs").alias("fs"), F.sum(F.col("n").cast("long")).alias("raw"))


_TRACE_KEYS = ["station", "chunk", "channel", "seq"]


def _resampled(pieces: DataFrame, fs: float) -> DataFrame:
    """Whole traces at the rate ``fs``, in pieces again. A trace of another rate is one task's."""
    size = blocks.BLOCK

    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        data = resample(np.concatenate(blocks.packed_arrays(table["data"])), table["fs"][0].as_py(), fs)
        at = range(0, len(data), size)
        same = [pa.array([table[c][0].as_py()] * len(at), table[c].type) for c in _TRACE_KEYS]
        return pa.Table.from_arrays([*same, pa.array(list(at), pa.int64()), blocks.packed_column([data[k : k + size] for k in at])], [*_TRACE_KEYS, "at", "data"])

    return pieces.groupBy(*_TRACE_KEYS).applyInArrow(one, "station string, chunk string, channel string, seq int, at bigint, data binary")


def join_traces(traces: DataFrame, fs: float, channels: DataFrame | None = None) -> DataFrame:
    """Gap-free segments of every chunk and channel, as packed blocks.

    ``traces`` are pieces as in ``schemas.TRACE``; with ``channels`` (of ``pick_channels``) only the
    chosen ones count. Runs, places and lengths are found on headers alone. Each piece is then cut
    at the blocks' borders and moves once, to the task that paints its block: in order of start,
    then of ``seq``, a trace that reaches further overwrites, a contained one is left out.
    ``traces`` is read twice, once for its headers: it should be stored.
    """
    keys, size = ["station", "chunk", "channel"], blocks.BLOCK
    off = F.abs(F.col("fs") - fs) > RATE_TOLERANCE
    heads = trace_heads(traces)
    if channels is not None:
        wanted = channels.select("station", "chunk", F.explode(F.array("z", "n", "e")).alias("channel"))
        heads = heads.join(wanted, keys)
    heads = heads.withColumn("off", off).withColumn("n", F.when(off, F.rint(F.col("raw") * (fs / F.col("fs"))).cast("long")).otherwise(F.col("raw"))).where("n > 0")
    runs = trace_runs(heads, keys, fs, seq="seq")
    in_run = Window.partitionBy(*keys, "run")
    runs = runs.withColumn("first", F.min("t0").over(in_run)).withColumn("place", F.rint((F.col("t0") - F.col("first")) * fs).cast("long"))
    runs = runs.withColumn("length", F.max(F.col("place") + F.col("n")).over(in_run)).withColumn("rank", F.row_number().over(in_run.orderBy("t0", "seq")))
    runs = checkpoint(runs.where("not contained").select(*_TRACE_KEYS, "off", "run", "first", "place", "length", "rank"))
    pieces = traces.select("station", "chunk", F.upper("channel").alias("channel"), "seq", "fs", "at", "data")
    others = runs.where("off")
    plain = pieces.select(*_TRACE_KEYS, "at", "data").join(measured_broadcast(runs.where("not off")), _TRACE_KEYS)
    if others.head(1):
        turned = _resampled(pieces.join(measured_broadcast(others.select(*_TRACE_KEYS)), _TRACE_KEYS, "left_semi"), fs)
        plain = plain.unionByName(turned.join(measured_broadcast(others), _TRACE_KEYS))

    def cut(batches):
        for batch in batches:
            rows, numbers, begins, parts = [], [], [], []
            for i, (at, place, data) in enumerate(zip(batch.column("at").to_pylist(), batch.column("place").to_pylist(), blocks.packed_arrays(batch.column("data")), strict=True)):
                lo, hi = place + at, place + at + len(data)
                for k in range(lo // size, -(-hi // size)):
                    a, z = max(lo, k * size), min(hi, (k + 1) * size)
                    rows.append(i)
                    numbers.append(k)
                    begins.append(a - k * size)
                    parts.append(data[a - lo : z - lo])
            taken = batch.select([*keys, "run", "first", "length", "rank"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(numbers, pa.int32()), pa.array(begins, pa.int32()), blocks.packed_column(parts)], [*keys, "run", "first", "length", "rank", "block", "begin", "part"])

    order = [*keys, "run", "first", "at", "place", "data", "length", "rank"]
    named = "station string, chunk string, channel string"
    parts = plain.select(*order).mapInArrow(cut, f"{named}, run int, first double, length bigint, rank int, block int, begin int, part binary")

    def paint(table: pa.Table) -> pa.Table:
        of = {c: table[c][0].as_py() for c in (*keys, "run", "first", "length", "block")}
        out = np.empty(min(size, of["length"] - of["block"] * size))
        ranks, begins, data = table["rank"].to_numpy(), table["begin"].to_numpy(), blocks.packed_arrays(table["part"])
        for i in np.argsort(ranks, kind="stable").tolist():
            out[begins[i] : begins[i] + len(data[i])] = data[i]
        cols = [of["station"], of["chunk"], of["channel"], _role(of["channel"]), of["run"], of["first"], of["length"], of["block"], float(out.sum()), out.tobytes()]
        return pa.Table.from_arrays([pa.array([c], t) for c, t in zip(cols, _SEGMENT.types, strict=True)], schema=_SEGMENT)

    return parts.groupBy(*keys, "run", "block").applyInArrow(paint, SEGMENT)


_SEGMENT = pa.schema([("station", pa.string()), ("chunk", pa.string()), ("channel", pa.string()), ("role", pa.string()), ("seg_id", pa.int32()), ("t0", pa.float64()), ("n", pa.int64()), ("block", pa.int32()), ("total", pa.float64()), ("data", pa.binary())])


def _role(channel: str) -> str | None:
    return next((role for role, letters in ROLES.items() if channel[-1] in letters), None)


def span_of(segments: DataFrame, keys: list[str], fs: float) -> DataFrame:
    """``(keys, first, last)``: a record's first sample and its last segment's end, at its own rate."""
    return segments.groupBy(*keys).agg(F.min("t0").alias("first"), F.max_by(F.col("t0") + F.col("n") / F.lit(fs), "t0").alias("last"))


def holding(requests: DataFrame, heads: DataFrame, keys: list[str], fs: float, start: str, wants: dict[str, int], roles: dict[str, str] | None = None, bucket: float | None = None, after: dict[str, float] | None = None, carry: list[str] = (), deal: list[str] = ()) -> DataFrame:
    """``requests`` with, for each of ``wants``, ``(seg_id, at)``: the first segment that wholly holds so many samples from ``start``.

    With ``roles`` each want is asked of one component's segments only, with ``after`` it begins so many
    seconds after ``start``; ``carry`` names further columns of the headers, ``deal`` the request's columns
    that the result is dealt to tasks by, if these are asked together afterwards. Requests meet the segments'
    headers by buckets of time, all lengths and roles at once; where none holds a length whole its
    column is null, and a request that no segment holds has no row. A bucket, if not given, is twice as long as
    the segments are on average, so that a header is copied one and a half times on average, however long they are.
    """
    ids, carried = [*requests.columns], ["role"] if roles else []
    right = heads.where(F.col("n") >= min(wants.values())).select(*keys, *[F.col(c).alias(f"_{c}") for c in carried], "seg_id", F.col("t0").alias("_t0"), F.col("n").alias("_len"), *[F.col(c).alias(f"_h_{c}") for c in carry if c not in ("t0", "n")])
    if bucket is None:
        bucket = 2 * max(right.agg(F.avg("_len")).head()[0] or 0.0, 1.0) / fs
    offsets = {c: (after or {}).get(c, 0.0) for c in wants}
    least = {x: min(n for c, n in wants.items() if offsets[c] == x) for x in sorted(set(offsets.values()))}
    begins = [F.floor((F.col(start) + x) / bucket) for x in least]
    left = requests.withColumn("_b", begins[0] if len(begins) == 1 else F.explode(F.array_distinct(F.array(*begins))))
    begin = F.floor((F.col("_t0") - 1 / fs) / bucket)  # a start may lie up to half a sample ahead
    right = right.withColumn("_b", F.explode(F.sequence(begin, F.floor((F.col("_t0") + F.col("_len") / fs) / bucket))))
    at = {x: F.rint((F.col(start) + x - F.col("_t0")) * fs).cast("long") for x in least}
    fits = lambda x, n: (at[x] >= 0) & (at[x] + F.lit(n) <= F.col("_len"))
    met = left.join(right, [*keys, "_b"]).where(reduce(operator.or_, [fits(x, n) for x, n in least.items()]))
    holds = {c: fits(offsets[c], n) & (F.col("_role") == roles[c] if roles else F.lit(True)) for c, n in wants.items()}
    first = [F.min(F.when(ok, F.struct("seg_id", at[offsets[c]].alias("at"), *[F.col({"t0": "_t0", "n": "_len"}.get(h, f"_h_{h}")).alias(h) for h in carry]))).alias(c) for c, ok in holds.items()]
    if deal or len(begins) > 1:
        return (met.repartition(*deal) if deal else met).groupBy(*ids).agg(*first)
    # A request has one bucket: grouped by it too, rows stay where they met.
    return met.groupBy(*ids, "_b").agg(*first).drop("_b")


def containing(requests: DataFrame, segments: DataFrame, keys: list[str], fs: float, start: str, want: int) -> DataFrame:
    """``requests`` with ``samples``, a list: the first segment that wholly holds ``want`` samples from ``start``.

    A request that no segment holds whole has no row. Samples are fetched of the one segment chosen.
    """
    found = holding(requests, blocks.heads(segments), keys, fs, start, {"_x": want})
    found = found.select(*requests.columns, "_x.seg_id", F.col("_x.at").alias("_at"), F.lit(want).alias("_want"))
    return blocks.values(blocks.fetch(found, segments, keys, "_at", "_want")).drop("_at", "seg_id", "_want")
