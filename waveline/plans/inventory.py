"""What is worth running: holdings by station, joint coverage by pair, outstanding work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waveline.functions.geo import haversine_km
from waveline.operators.intervals import intersect, whole_days
from waveline.sources.tables import FETCHED, PENDING, spans_in_state

MIN_JOINT_DAYS, MIN_CHUNKS = 60, 2
#: All pairs of stations are formed by so many blocks of either side.
PAIR_BLOCKS = 8
#: Blocks of stations whose recordings are compared; a key is a month and two blocks.
JOINT_BLOCKS = 16


def span_days(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Whole days of each span, added up."""
    return spans.groupBy(*keys).agg(F.sum(whole_days("lo", "hi")).alias("days"))


def survey(ledger: DataFrame, chunks: DataFrame) -> DataFrame:
    """Ledgers against what is on disk, a row of each station known to either, most chunks first.

    ``chunks`` is ``(station, chunk, bytes)``. Chunks and bytes are the disk's, days the
    ledgers'. Stations with neither chunks nor fetched spans are left out.
    """
    fetched, pending = (spans_in_state(ledger, s) for s in (FETCHED, PENDING))
    spans = fetched.groupBy("station").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("spans"), F.sum(whole_days("lo", "hi")).alias("fetched_days"))
    owed = span_days(pending, ["station"]).withColumnRenamed("days", "pending_days")
    disk = chunks.groupBy("station").agg(F.count("*").alias("chunks"), F.sum("bytes").alias("bytes"))
    rows = spans.join(disk, "station", "full_outer").join(owed, "station", "left")
    if "source" in ledger.columns:
        rows = rows.join(ledger.groupBy("station").agg(F.array_sort(F.collect_set("source")).alias("sources")), "station", "left")
    rows = rows.fillna(0, ["chunks", "bytes", "fetched_days", "pending_days"]).where("chunks > 0 or fetched_days is not null and spans is not null")
    more = {"gigabytes": F.col("bytes") / 1e9, "first": F.to_date(F.timestamp_seconds(F.get("spans", F.lit(0))["lo"])), "last": F.to_date(F.timestamp_seconds(F.try_element_at("spans", F.lit(-1))["hi"]))}
    return rows.withColumns(more).orderBy(F.desc("chunks"), "station")


def usable(rows: DataFrame, min_chunks: int = MIN_CHUNKS) -> DataFrame:
    return rows.where(F.col("chunks") >= min_chunks)


def total(rows: DataFrame) -> DataFrame:
    """The survey's bottom line."""
    return rows.agg(F.count("*").alias("stations"), F.sum("chunks").alias("chunks"), F.sum("bytes").alias("bytes"), F.sum("fetched_days").alias("fetched_days"), F.sum("pending_days").alias("pending_days"))


def joint_days(spans: DataFrame) -> DataFrame:
    """``(station_a, station_b, joint_days)``, a < b: whole days of each common part, added up.

    ``spans`` is ``(station, lo, hi)``. Stations meet in the months they share, so pairs that
    never recorded together aren't formed; they are dealt to blocks, and spans of two blocks meet
    under a key of both, so that a month isn't one task's and each pair is formed once.
    """
    own, last = F.pmod(F.xxhash64("station"), F.lit(JOINT_BLOCKS)).cast("int"), F.lit(JOINT_BLOCKS - 1)
    a = spans.select(F.col("station").alias("_a"), "lo", "hi", own.alias("_i"), F.explode(F.sequence(own, last)).alias("_j"))
    b = spans.select(F.col("station").alias("_b_"), "lo", "hi", F.explode(F.sequence(F.lit(0), own)).alias("_i"), own.alias("_j"))
    both = intersect(a, b, ["_i", "_j"], bucket=30 * 86400.0, carry=(["_a"], ["_b_"])).where("_i < _j or _a < _b_")
    return both.groupBy(F.least("_a", "_b_").alias("station_a"), F.greatest("_a", "_b_").alias("station_b")).agg(F.sum(whole_days("lo", "hi")).alias("joint_days"))


def separations(stations: DataFrame, max_separation: float | None = None) -> DataFrame:
    """``(station_a, station_b, separation_km)`` of every two stations, a < b, at most ``max_separation`` apart.

    With a limit, stations meet by latitude bands of its height. Without one the result is all
    pairs by definition; they are formed in ``PAIR_BLOCKS`` squared parts, by an equi-join.
    """
    place = stations.select("station", "lat", "lon")
    if max_separation is None:
        blocks, own = F.explode(F.sequence(F.lit(0), F.lit(PAIR_BLOCKS - 1))), F.pmod(F.xxhash64("station"), F.lit(PAIR_BLOCKS)).cast("int")
        a = place.select(F.col("station").alias("station_a"), F.col("lat").alias("_lat_a"), F.col("lon").alias("_lon_a"), own.alias("_i"), blocks.alias("_j"))
        b = place.select(F.col("station").alias("station_b"), F.col("lat").alias("_lat_b"), F.col("lon").alias("_lon_b"), blocks.alias("_i"), own.alias("_j"))
        met = a.join(b, ["_i", "_j"])
    else:
        height = max_separation / 111.0 + 0.01
        a = place.select(F.col("station").alias("station_a"), F.col("lat").alias("_lat_a"), F.col("lon").alias("_lon_a"), F.floor(F.col("lat") / height).alias("_band"))
        b = place.select(F.col("station").alias("station_b"), F.col("lat").alias("_lat_b"), F.col("lon").alias("_lon_b"), F.explode(F.sequence(F.floor(F.col("lat") / height) - 1, F.floor(F.col("lat") / height) + 1)).alias("_band"))
        met = a.join(b, "_band")
    pairs = met.where("station_a < station_b").select("station_a", "station_b", haversine_km("_lat_a", "_lon_a", "_lat_b", "_lon_b").alias("separation_km"))
    return pairs if max_separation is None else pairs.where(F.col("separation_km") <= max_separation)


def station_pairs(spans: DataFrame, stations: DataFrame, order: DataFrame | None = None, min_joint_days: int = MIN_JOINT_DAYS, max_separation: float | None = None) -> DataFrame:
    """``(separation_km, joint_days, station_a, station_b)`` of the pairs worth a test, nearest first.

    With ``order`` (station, rank) the first station of a pair is the one of lower rank, else
    the alphabetically first.
    """
    place = stations.select("station", "lat", "lon")
    days = joint_days(spans).where(F.col("joint_days") >= min_joint_days)
    for s in "ab":
        days = days.join(place.select(F.col("station").alias(f"station_{s}"), F.col("lat").alias(f"_lat_{s}"), F.col("lon").alias(f"_lon_{s}")), f"station_{s}")
    out = days.withColumn("separation_km", haversine_km("_lat_a", "_lon_a", "_lat_b", "_lon_b"))
    if max_separation is not None:
        out = out.where(F.col("separation_km") <= max_separation)
    if order is not None:
        for s in "ab":
            out = out.join(order.select(F.col("station").alias(f"station_{s}"), F.col("rank").alias(f"_rank_{s}")), f"station_{s}")
        swap = F.col("_rank_b") < F.col("_rank_a")
        out = out.withColumns({"station_a": F.when(swap, F.col("station_b")).otherwise(F.col("station_a")), "station_b": F.when(swap, F.col("station_a")).otherwise(F.col("station_b"))})
    return out.select("separation_km", "joint_days", "station_a", "station_b").orderBy("separation_km", "joint_days", "station_a", "station_b")


def required(chunks: DataFrame, products: list[str]) -> DataFrame:
    """``(station, chunk, product)``: what there should be."""
    return chunks.select("station", "chunk", F.explode(F.array(*map(F.lit, products))).alias("product"))


def outstanding(chunks: DataFrame, done: DataFrame, products: list[str]) -> DataFrame:
    """``(station, chunk, product)``: what isn't there yet."""
    return required(chunks, products).join(done.select("station", "chunk", "product"), ["station", "chunk", "product"], "left_anti")


def work_matrix(chunks: DataFrame, done: DataFrame, products: list[str], baselines: DataFrame | None = None) -> DataFrame:
    """A row of each station: its chunks, how many lack each product, whether it has a baseline,
    how many must be decoded at all, and what separate passes would decode.

    ``range`` counts as a product that is all there or not: an incomplete one needs every chunk.
    """
    missing = outstanding(chunks, done, products)
    counts = missing.groupBy("station").pivot("product", products).agg(F.count(F.lit(1)))
    counts = counts.select("station", *[F.coalesce(F.col(f"`{p}`"), F.lit(0)).alias(f"missing_{p}") for p in products])
    size = chunks.groupBy("station").agg(F.count("*").alias("chunks"))
    decode = missing.groupBy("station").agg(F.count_distinct("chunk").alias("decode"))
    rows = size.join(counts, "station", "left").join(decode, "station", "left").fillna(0)
    if "range" in products:
        rows = rows.withColumn("decode", F.when(F.col("missing_range") > 0, F.col("chunks")).otherwise(F.col("decode")))
        passes = F.lit(len(products) - 1) + (F.col("missing_range") > 0).cast("int")
    else:
        passes = F.lit(len(products))
    rows = rows.withColumn("naive", F.col("chunks") * passes)
    if baselines is not None:
        has = baselines.select("station").distinct().withColumn("baseline", F.lit(True))
        rows = rows.join(has, "station", "left").fillna(False, ["baseline"])
    return rows.orderBy("station")


def limit_chunks(chunks: DataFrame, n: int) -> DataFrame:
    """The first ``n`` chunks of each station."""
    from pyspark.sql import Window

    w = Window.partitionBy("station").orderBy("chunk")
    return chunks.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n).drop("_k")
