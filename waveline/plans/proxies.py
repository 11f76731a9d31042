"""Views of the star-schema tables in the shape of the engine's inputs, the same in SQL.

The tables hold no recordings; each view makes one of the engine's inputs of them by a fixed
rule, so that every operator can be run on them and checked by another engine. Every view has all
rows of its table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waveline.durable import stored
from waveline.operators.segments import pack_traces


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch(c: str) -> Column:
    """Epoch seconds of a time stamp without zone, whatever the session's zone."""
    return F.expr(f"cast(cast({c} - TIMESTAMP_NTZ'1970-01-01 00:00:00' as interval second) as decimal(20, 6))").cast("double")


def scores(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("event_type").alias("station"), epoch("ts").alias("t"), (F.col("value") / (1 + F.col("value"))).alias("p"))


def stations(spark: SparkSession, d: str) -> DataFrame:
    codes = F.array(*map(F.lit, ["click", "error", "purchase", "signup", "view"]))
    r = F.col("r_regionkey")
    return table(spark, d, "region").select(F.get(codes, r).alias("station"), (37 + 0.7 * r).alias("lat"), (30 + 1.1 * r).alias("lon"))


def catalog(spark: SparkSession, d: str) -> DataFrame:
    """Every event, spread over a region of which a station reaches a tenth."""
    k, i = F.get_json_object("props", "$.k").cast("int"), F.col("event_id")
    return table(spark, d, "events").select("event_id", epoch("ts").alias("t"), (30 + i * 7919 % 1000 * 0.02).alias("lat"), (10 + i * 104729 % 1000 * 0.04).alias("lon"), F.nullif(k % 30, F.lit(0)).cast("double").alias("depth"), F.least(F.col("value") / 40, F.lit(7.0)).alias("mag"))


def _code(key) -> Column:
    return F.concat(F.lit("S"), F.lpad(key.cast("string"), 2, "0"))


def ledger(spark: SparkSession, d: str) -> DataFrame:
    lo = epoch("o_orderdate")
    state = F.when(F.col("o_orderstatus") == "F", "fetched").when(F.col("o_orderstatus") == "P", "pending").otherwise("submitted")
    return table(spark, d, "orders").select(_code(F.col("o_custkey") % 25).alias("station"), state.alias("state"), lo.alias("lo"), (lo + (F.col("o_orderkey") % 40 + 1) * 21600.0).alias("hi"), F.concat(F.lit("campaign"), F.col("o_orderkey") % 3).alias("source"))


def ledger_stations(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    return table(spark, d, "nation").select(_code(k).alias("station"), (36 + 0.35 * k).alias("lat"), (28 + k * k % 17 * 0.9).alias("lon"))


def traces(spark: SparkSession, d: str) -> DataFrame:
    codes = F.array(*map(F.lit, ["HHZ", "HHN", "HHE"]))
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("station"), F.get(codes, F.col("l_linenumber") % 3).alias("channel"), epoch("l_shipdate").alias("t0"), F.floor(F.col("l_quantity") / 25 * 86400).cast("long").alias("n"))


def samples(base: pd.Series, n: pd.Series) -> pd.Series:
    """A segment's samples, packed, by a rule of its start."""
    ends = np.cumsum(n.to_numpy())
    first = base.to_numpy() - 7 * (ends - n.to_numpy())
    data = ((np.repeat(first, n.to_numpy()) + 7 * np.arange(ends[-1] if len(ends) else 0)) % 1000).astype(np.float64).tobytes()
    return pd.Series([data[8 * (e - m) : 8 * e] for e, m in zip(ends.tolist(), n.tolist(), strict=True)], dtype=object)


def headers(spark: SparkSession, d: str) -> DataFrame:
    """Every line item as a gap-free segment of one sample in ten minutes, three roles of a station.

    A segment is short enough for one block. Samples are made of the headers by ``segment_samples``
    where they are read: stored, they would far outweigh the table.
    """
    roles = F.array(*map(F.lit, ["Z", "N", "E"]))
    t0, n = F.floor(epoch("l_shipdate") / 600) * 600.0, F.floor(F.col("l_quantity") / 25 * 144).cast("long") + 1
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("station"), F.get(roles, F.col("l_linenumber") % 3).alias("role"), t0.alias("t0"), n.alias("n"))
    return rows.withColumn("seg_id", F.row_number().over(Window.partitionBy("station", "role").orderBy("t0", "n"))).withColumn("block", F.lit(0))


def segments(spark: SparkSession, d: str) -> DataFrame:
    """``headers``, stored for what reads them several times."""
    return stored(headers(spark, d), "segments")


def segment_samples() -> Column:
    """The samples of a segment of ``segments``, as a column."""
    return F.pandas_udf(samples, "binary")((F.col("t0") / 600).cast("long") + F.col("n"), F.col("n"))


def arrivals_at(spark: SparkSession, d: str) -> DataFrame:
    """Every order as an event of every supplier in it, a day into its first part."""
    rows = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("station"), F.col("l_orderkey").alias("event_id")).agg(F.min(epoch("l_shipdate")).alias("t"))
    return rows.select("station", "event_id", (F.col("t") + 20000).alias("p_epoch"), (F.col("t") + 20300).alias("cut_epoch"))


def recorded(spark: SparkSession, d: str) -> DataFrame:
    """Every vector as a trace of 64 samples, three channels of ten stations, some overlapping, some together and some apart; their order is that of the ids."""
    k = F.col("vec_id")
    codes = F.array(*map(F.lit, ["HHZ", "HHN", "HHE"]))
    rows = table(spark, d, "embeddings").select(F.concat(F.lit("L"), F.col("label")).alias("station"), F.lit("L_2024-01-01").alias("chunk"), F.get(codes, (k % 3).cast("int")).alias("channel"), (F.floor(k / 30) * 0.5 + k * 7 % 8 * 0.0625).alias("t0"), F.lit(64.0).alias("fs"), F.transform("embedding", lambda x: x.cast("double")).alias("data"), k.cast("int").alias("seq"))
    return stored(pack_traces(rows), "traces")


def channels(spark: SparkSession, d: str) -> DataFrame:
    bands, roles = F.array(*map(F.lit, ["HN", "HH", "BH", "XX"])), F.array(*map(F.lit, ["Z", "N", "1", "E", "2"]))
    band = F.get(bands, (F.col("l_suppkey") * 7 + F.col("l_orderkey")) % 4)
    return table(spark, d, "lineitem").select((F.col("l_suppkey") * 10 + F.col("l_orderkey") % 10).alias("station"), F.lower(F.concat(band, F.get(roles, F.col("l_partkey") % 5))).alias("channel"))


def snr(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("event_id"), (F.col("l_extendedprice") / 10000).alias("snr"), epoch("l_shipdate").alias("time"), F.col("l_linenumber").alias("part"))


def windows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("window_id"), F.concat(F.lit("L"), F.col("label")).alias("station"), F.transform("embedding", lambda x: x.cast("double")).alias("x"))


def files(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    stem = F.concat(F.lit("ST"), k % 7, F.lit("_2024-"), F.lpad((k % 12 + 1).cast("string"), 2, "0"), F.lit("-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"))
    name = F.when(k % 4 == 0, F.concat(stem, F.lit(".zip"))).when(k % 4 == 1, F.concat(stem, F.lit(".zip.part"))).when(k % 4 == 2, F.concat(stem, F.lit(".dup"), k % 5, F.lit(".zip"))).otherwise(F.concat(F.lit("notes"), k, F.lit(".txt")))
    return table(spark, d, "documents").select(F.concat(F.lit("ST"), k % 7).alias("folder"), name.alias("name"), F.concat(F.lit("/a/ST"), k % 7, F.lit("/"), name).alias("path"), F.col("n_chars").alias("bytes"))


def chunks(spark: SparkSession, d: str) -> DataFrame:
    """Every order as a chunk; two stations of the ledger have none, two others aren't in the ledger."""
    return table(spark, d, "orders").select(_code(F.col("o_custkey") % 25 + 2).alias("station"), F.concat(F.lit("c"), F.col("o_orderkey")).alias("chunk"), (F.col("o_orderkey") % 1000 + 1).alias("bytes"))


PRODUCTS = ["scores6s", "range", "cut6", "cut10"]


def done(spark: SparkSession, d: str) -> DataFrame:
    key = [_code(F.col("o_custkey") % 25 + 2).alias("station"), F.concat(F.lit("c"), F.col("o_orderkey")).alias("chunk")]
    product = F.explode(F.array(*map(F.lit, PRODUCTS)))
    out = table(spark, d, "orders").select(*key, "o_orderkey", "o_custkey", product.alias("product"))
    return out.where("case product when 'scores6s' then o_orderkey % 2 = 0 when 'range' then o_custkey % 25 < 12 when 'cut6' then o_orderkey % 3 <> 0 else o_orderkey % 5 <> 0 end").select("station", "chunk", "product")


#: The same views in SQL.
SQL = {
    "v_scores": "SELECT event_type AS station, epoch_us(ts) / 1e6 AS t, value / (1 + value) AS p FROM events",
    "v_stations": "SELECT (['click', 'error', 'purchase', 'signup', 'view'])[r_regionkey + 1] AS station, 37 + CAST(0.7 AS DOUBLE) * r_regionkey AS lat, 30 + CAST(1.1 AS DOUBLE) * r_regionkey AS lon FROM region",
    "v_catalog": "SELECT event_id, epoch_us(ts) / 1e6 AS t, 30 + (event_id * 7919 % 1000) * CAST(0.02 AS DOUBLE) AS lat, 10 + (event_id * 104729 % 1000) * CAST(0.04 AS DOUBLE) AS lon, CAST(nullif(CAST(json_extract_string(props, '$.k') AS INT) % 30, 0) AS DOUBLE) AS depth, least(value / 40, 7.0) AS mag FROM events",
    "v_ledger": "SELECT 'S' || lpad(CAST(o_custkey % 25 AS VARCHAR), 2, '0') AS station, CASE o_orderstatus WHEN 'F' THEN 'fetched' WHEN 'P' THEN 'pending' ELSE 'submitted' END AS state, epoch_us(o_orderdate) / 1e6 AS lo, epoch_us(o_orderdate) / 1e6 + (o_orderkey % 40 + 1) * 21600.0 AS hi, 'campaign' || (o_orderkey % 3) AS source FROM orders",
    "v_ledger_stations": "SELECT 'S' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS station, 36 + CAST(0.35 AS DOUBLE) * n_nationkey AS lat, 28 + (n_nationkey * n_nationkey % 17) * CAST(0.9 AS DOUBLE) AS lon FROM nation",
    "v_traces": "SELECT l_suppkey AS station, (['HHZ', 'HHN', 'HHE'])[l_linenumber % 3 + 1] AS channel, epoch_us(l_shipdate) / 1e6 AS t0, CAST(floor(l_quantity / 25 * 86400) AS BIGINT) AS n FROM lineitem",
    "v_channels": "SELECT l_suppkey * 10 + l_orderkey % 10 AS station, lower((['HN', 'HH', 'BH', 'XX'])[(l_suppkey * 7 + l_orderkey) % 4 + 1] || (['Z', 'N', '1', 'E', '2'])[l_partkey % 5 + 1]) AS channel FROM lineitem",
    "v_snr": "SELECT l_orderkey AS event_id, l_extendedprice / 10000 AS snr, epoch_us(l_shipdate) / 1e6 AS time, l_linenumber AS part FROM lineitem",
    "v_windows": "SELECT vec_id AS window_id, 'L' || label AS station, CAST(embedding AS DOUBLE[]) AS x FROM embeddings",
    "v_segments": "SELECT *, row_number() OVER (PARTITION BY station, role ORDER BY t0, n) AS seg_id, CAST(t0 / 600 AS BIGINT) + n AS base FROM (SELECT l_suppkey AS station, (['Z', 'N', 'E'])[l_linenumber % 3 + 1] AS role, floor(epoch_us(l_shipdate) / 1e6 / 600) * 600.0 AS t0, CAST(floor(l_quantity / 25 * 144) AS BIGINT) + 1 AS n FROM lineitem)",
    "v_arrivals_at": "SELECT l_suppkey AS station, l_orderkey AS event_id, min(epoch_us(l_shipdate) / 1e6) + 20000 AS p_epoch, min(epoch_us(l_shipdate) / 1e6) + 20300 AS cut_epoch FROM lineitem GROUP BY l_suppkey, l_orderkey",
    "v_recorded": "SELECT vec_id, 'L' || label AS station, (['HHZ', 'HHN', 'HHE'])[vec_id % 3 + 1] AS channel, floor(vec_id / 30) * 0.5 + (vec_id * 7 % 8) * 0.0625 AS t0, CAST(embedding AS DOUBLE[]) AS x FROM embeddings",
    "v_files": "SELECT 'ST' || (doc_id % 7) AS folder, CASE doc_id % 4 WHEN 0 THEN stem || '.zip' WHEN 1 THEN stem || '.zip.part' WHEN 2 THEN stem || '.dup' || (doc_id % 5) || '.zip' ELSE 'notes' || doc_id || '.txt' END AS name, n_chars AS bytes FROM (SELECT *, 'ST' || (doc_id % 7) || '_2024-' || lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 2, '0') || '-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') AS stem FROM documents)",
    "v_chunks": "SELECT 'S' || lpad(CAST(o_custkey % 25 + 2 AS VARCHAR), 2, '0') AS station, 'c' || o_orderkey AS chunk, o_orderkey % 1000 + 1 AS bytes FROM orders",
    "v_done": "SELECT 'S' || lpad(CAST(o_custkey % 25 + 2 AS VARCHAR), 2, '0') AS station, 'c' || o_orderkey AS chunk, product FROM orders, (VALUES ('scores6s'), ('range'), ('cut6'), ('cut10')) AS p(product) WHERE CASE product WHEN 'scores6s' THEN o_orderkey % 2 = 0 WHEN 'range' THEN o_custkey % 25 < 12 WHEN 'cut6' THEN o_orderkey % 3 <> 0 ELSE o_orderkey % 5 <> 0 END",
}


def with_views(*names: str) -> str:
    """A WITH clause of the views named, to go before further parts or a SELECT."""
    return "WITH " + ", ".join(f"{n} AS ({SQL[n]})" for n in names) + " "
