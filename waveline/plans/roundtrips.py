"""Registered queries that write what the engine writes, and read it back as the engine does.

Each makes its files of a whole table in the shared checkpoint folder; the SQL is over the table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waveline.durable import checkpoint_dir
from waveline.functions import arrays, names
from waveline.functions.numbers import rounded
from waveline.operators import arrivals, baseline, blocks, score, segments, signal, snr, windows
from waveline.plans import proxies as V
from waveline.plans import queries as Q
from waveline.plans import run
from waveline.plans.proxies import with_views
from waveline.plans.queries import query, r6
from waveline.sources import store, tables


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _csv(df: DataFrame, name: str, files: int | None = 1) -> str:
    """One file with a header, in the frame's order; or as many as there are partitions."""
    path = _folder(df.sparkSession, name)
    (df.coalesce(files) if files else df).write.option("header", "true").csv(path)
    return path


def _station_file(spark, d) -> str:
    """Every nation as a station, blanks about its code; all are listed twice, the first time elsewhere."""
    k = F.col("n_nationkey")
    rows = V.table(spark, d, "nation").select(F.concat(F.lit(" "), V._code(k), F.lit(" ")).alias("Code"), F.explode(F.array(F.lit(0), F.lit(1))).alias("turn"), (36 + 0.35 * k).alias("lat"), (28 + k * k % 17 * 0.9).alias("lon"))
    rows = rows.orderBy("turn", "Code").select("Code", F.when(F.col("turn") == 1, F.col("lat")).otherwise(0.0).alias("Latitude"), F.col("lon").alias("Longitude"), F.lit("x").alias("Extra"))
    return _csv(rows, "stations")


@query(with_views("v_ledger_stations") + "SELECT station, round(lat, 6) AS lat, round(lon, 6) AS lon FROM v_ledger_stations")
def station_file(spark, d):
    return r6(tables.read_stations(spark, _station_file(spark, d)), "lat", "lon")


@query("SELECT 's' || n_nationkey AS station, round(36 + CAST(0.35 AS DOUBLE) * n_nationkey, 6) AS lat, CAST(n_nationkey AS DOUBLE) AS lon FROM nation WHERE n_nationkey = 7")
def station_place(spark, d):
    """One station's coordinates, looked up by its code."""
    k = F.col("n_nationkey")
    path = _csv(V.table(spark, d, "nation").select(F.concat(F.lit("s"), k).alias("Code"), (36 + 0.35 * k).alias("Latitude"), k.cast("double").alias("Longitude")), "places")
    return r6(spark.createDataFrame([("s7", *tables.station_coords(spark, path, "s7"))], "station string, lat double, lon double"), "lat")


@query(with_views("v_catalog") + "SELECT c.event_id, floor(c.t) AS t, round(c.lat, 6) AS lat, round(c.mag, 6) AS mag, depth, 'place, ' || c.event_id AS location FROM v_catalog c WHERE c.event_id % 97 <> 0")
def catalogue_file(spark, d):
    """The catalogue as a file of dates and quoted places, every 97th date no date."""
    e = V.catalog(spark, d)
    date = F.when(F.col("event_id") % 97 == 0, "no date").otherwise(F.date_format(F.timestamp_seconds(F.floor("t")), "dd/MM/yyyy HH:mm:ss"))
    path = _csv(e.repartition(8).select(F.col("event_id").alias("EventID"), date.alias("Date"), F.col("lat").alias("Latitude"), F.col("lon").alias("Longitude"), F.col("depth").alias("Depth"), F.col("mag").alias("Magnitude"), F.concat(F.lit("place, "), "event_id").alias("Location")), "catalogue", None)
    return r6(tables.read_events(spark, path).select("event_id", "t", "lat", "mag", "depth", "location"), "lat", "mag")


@query("""SELECT 'S' || (o_custkey % 13) AS station, coalesce(CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END, '?') AS state, epoch_us(o_orderdate) / 1e6 AS lo, epoch_us(o_orderdate) / 1e6 + 86400.0 AS hi
FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey % 83 <> 0""")
def ledger_files(spark, d):
    """Ledger files of all orders, every 97th line torn, every 83rd without a station."""
    iso = lambda s: F.date_format(F.col("o_orderdate") + F.expr(f"interval {s} days"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    station = F.when(F.col("o_orderkey") % 83 != 0, F.concat(F.lit("S"), F.col("o_custkey") % 13))
    line = F.to_json(F.struct(station.alias("station"), F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("state"), iso(0).alias("start"), iso(1).alias("end")))
    path = _folder(spark, "ledgers")
    V.table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 97 == 0, F.substring(line, 1, 9)).otherwise(line).alias("value")).write.text(path)
    return tables.read_ledgers(spark, [path]).drop("source")


@query(with_views("v_scores") + "SELECT t, round(CAST(CAST(p AS REAL) AS DOUBLE), 5) AS p FROM v_scores WHERE station = 'click'")
def score_series(spark, d):
    """All scores written by station, arm and chunk; one station's series read back."""
    layout = store.Layout(_folder(spark, "out"))
    rows = V.scores(spark, d).withColumns({"arm": F.lit("6s"), "chunk": F.concat(F.lit("c"), F.floor(F.col("t") / 864000)), "p": F.col("p").cast("float")})
    store.write_scores(rows, layout)
    return tables.read_scores(spark, layout.scores, "click", "6s").withColumn("p", rounded(F.col("p").cast("double"), 5))


@query(with_views("v_snr") + "SELECT event_id, round(max(snr), 6) AS snr FROM v_snr GROUP BY event_id")
def snr_file(spark, d):
    """Readings from a file, the larger of an event."""
    return r6(tables.read_snr(spark, _csv(V.snr(spark, d).select("event_id", "snr", "part").repartition(8), "snr", None)), "snr")


@query(with_views("v_snr") + "SELECT event_id, round(snr, 6) AS snr, chunk FROM (SELECT *, 'p' || part AS chunk, row_number() OVER (PARTITION BY event_id ORDER BY part, time, snr) AS k FROM (SELECT event_id, part, time, max(snr) AS snr FROM v_snr GROUP BY ALL)) WHERE k = 1")
def snr_parts_table(spark, d):
    """Readings written by station and chunk, rolled up to one of each event."""
    layout = store.Layout(_folder(spark, "out"))
    rows = V.snr(spark, d).groupBy("event_id", "part", "time").agg(F.max("snr").alias("snr"))
    rows = rows.select(F.lit("S").alias("station"), F.concat(F.lit("p"), "part").alias("chunk"), "event_id", F.timestamp_seconds("time").alias("time"), F.lit(1.0).alias("mag"), F.lit(1.0).alias("dist_km"), F.lit(None).cast("double").alias("depth"), "snr", F.lit("x").alias("location"))
    store.write_snr_parts(rows, layout)
    return r6(run.snr_table(spark, layout).select("event_id", "snr", "chunk"), "snr")


@query(with_views("v_done") + "SELECT station, chunk, product, CAST(length(product) AS BIGINT) AS outputs FROM v_done")
def completion_table(spark, d):
    """Completions recorded twice, the second time with what counts."""
    layout = store.Layout(_folder(spark, "out"))
    done = V.done(spark, d)
    store.mark_completed(done.withColumn("outputs", F.lit(0)), layout)
    store.mark_completed(done.withColumn("outputs", F.length("product")), layout)
    return store.completed(spark, layout)


@query(with_views("v_stations") + f"SELECT least(a.station, b.station) || '-' || greatest(a.station, b.station) AS pair, b.station AS station_a, a.station AS station_b, round({Q._km('a', 'b')}, 6) AS separation_km, '6s' AS arm FROM v_stations a JOIN v_stations b ON a.station < b.station")
def pair_table(spark, d):
    """Pairs written under a key that doesn't depend on their order."""
    from waveline.plans import inventory

    layout = store.Layout(_folder(spark, "out"))
    turned = inventory.separations(V.stations(spark, d)).select(F.col("station_b").alias("station_a"), F.col("station_a").alias("station_b"), "separation_km")
    store.write_pairs(turned, layout, "6s")
    return r6(spark.read.parquet(layout.pairs), "separation_km")


def _units(spark, d) -> DataFrame:
    """Noise of every station and role: a role's vectors are those of its remainder; odd stations lack one role."""
    label = F.substring("station", 2, 9).cast("int")
    rows = V.windows(spark, d).withColumn("role", F.get(F.array(*map(F.lit, "ZNE")), (F.col("window_id") % 3).cast("int")))
    pieces = rows.select("station", "role", arrays.total("x").alias("s"), arrays.total(F.transform("x", lambda v: v * v)).alias("ss"), F.size("x").cast("long").alias("n"))
    return baseline.noise_statistics(pieces).where(~((label % 2 == 1) & (F.col("role") == "E")))


_UNITS = "units AS (SELECT 'L' || label AS station, (['Z', 'N', 'E'])[vec_id % 3 + 1] AS role, sum(list_sum(x)) / sum(64) AS mu, sqrt(greatest(sum(list_sum(list_transform(x, lambda v: v * v))) / sum(64) - pow(sum(list_sum(x)) / sum(64), 2), 0)) AS sigma FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings) GROUP BY ALL)"


@query(f"WITH {_UNITS} SELECT station, role, round(mu, 6) + 0.0 AS mu, round(sigma, 6) AS sigma FROM units WHERE NOT (CAST(substr(station, 2) AS INT) % 2 = 1 AND role = 'E')")
def baseline_table(spark, d):
    """Baselines written by station and read back."""
    layout = store.Layout(_folder(spark, "out"))
    store.write_baseline(_units(spark, d), layout)
    return r6(spark.read.parquet(layout.baseline).select("station", "role", "mu", "sigma"), "mu", "sigma").withColumn("mu", F.col("mu") + 0.0)


@query(f"WITH {_UNITS} SELECT role, round(mu, 6) + 0.0 AS mu, round(sigma, 6) AS sigma FROM units WHERE station = 'L4'")
def baseline_file(spark, d):
    """One station's baseline as the JSON file of earlier tools."""
    rows = _units(spark, d).where("station = 'L4'")
    whole = rows.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("role", F.struct("mu", "sigma", "sigma_trimmed", "sigma_median", "n_samples", "n_pieces"))))).alias("value"))
    path = _folder(spark, "baseline")
    whole.coalesce(1).write.text(path)
    found, _ = tables.read_baseline(spark, path)
    return r6(found.select("role", "mu", "sigma"), "mu", "sigma").withColumn("mu", F.col("mu") + 0.0)


@query(Q._CONDITIONED + f""", {_UNITS},
full_of AS (SELECT station FROM units WHERE NOT (CAST(substr(station, 2) AS INT) % 2 = 1 AND role = 'E') GROUP BY station HAVING count(*) = 3),
scaled AS (SELECT window_id, u.station, avg(abs((y - mu) / sigma)) AS p FROM clean JOIN embeddings ON vec_id = window_id JOIN units u ON u.station = 'L' || label JOIN full_of f ON f.station = u.station GROUP BY ALL)
SELECT station, 'v' || window_id AS chunk, round(least(p / 4, 1), 3) AS p FROM scaled""")
def score_by_baseline(spark, d):
    """Scores in the units of each station's noise; stations without all three roles have none."""
    rows = V.windows(spark, d).select("station", F.concat(F.lit("v"), F.col("window_id")).alias("chunk"), F.explode(F.array(*map(F.lit, "ZNE"))).alias("role"), F.lit(0).alias("seg_id"), F.lit(0.0).alias("t0"), F.lit(64).cast("long").alias("n"), F.col("x").alias("data"))
    arm = names.Arm("16s", 16.0, "", "", 16.0, 4.0)
    out = score.score(blocks.pack(rows), arm, _quarter, "pooled", _units(spark, d), low=0.2, high=1.5)
    return out.select("station", "chunk", rounded(F.col("p").cast("double"), 3).alias("p"))


def _quarter(block):
    """A stub scorer: a quarter of the mean of absolute samples, at most one."""
    import numpy as np

    return np.minimum(np.abs(block.astype(np.float64)).mean(axis=(1, 2)) / 4, 1.0)


@query(with_views("v_scores", "v_catalog", "v_stations") + f", {Q._ARRIVALS}, ext AS (SELECT station, min(t) AS first, min(t) + 864000 AS last FROM v_scores GROUP BY station) SELECT a.station, a.event_id FROM (SELECT station, event_id, p_epoch - tt_p AS t FROM arrivals) a JOIN ext USING (station) WHERE round(a.t, 3) BETWEEN first AND last")
def origins_in_record(spark, d):
    """Events whose origin lies inside a station's record of ten days."""
    extent = V.scores(spark, d).groupBy("station").agg(F.min("t").alias("first"), (F.min("t") + 864000).alias("last"))
    return arrivals.inside(Q._arrivals(spark, d), extent, ["station"]).select("station", "event_id")


@query(with_views("v_channels") + "SELECT channel, count(*) AS n, 'by role' AS how FROM v_channels WHERE upper(right(channel, 1)) = 'Z' GROUP BY channel UNION ALL SELECT channel, count(*), 'by code' FROM v_channels WHERE upper(channel) = 'HH1' GROUP BY channel")
def channel_selection(spark, d):
    """A bare role takes every band's channel, a full code one."""
    rows = V.channels(spark, d)
    parts = [segments.select_traces(rows, code).groupBy("channel").agg(F.count("*").alias("n")).withColumn("how", F.lit(how)) for code, how in (("z", "by role"), ("hh1", "by code"))]
    return parts[0].unionByName(parts[1])


@query(with_views("v_windows") + "SELECT station, count(*) AS pieces, CAST(sum(n) AS BIGINT) AS samples FROM (SELECT station, unnest([least(k, 48), greatest(k - 48, 0)]) AS n FROM (SELECT station, window_id % 64 + 1 AS k FROM v_windows)) WHERE n >= 40 GROUP BY station")
def short_pieces(spark, d):
    """Segments cut into pieces of twelve seconds; what is under ten seconds is left out."""
    data = F.slice("x", F.lit(1), (F.col("window_id") % 64 + 1).cast("int"))
    rows = V.windows(spark, d).select("station", F.lit("c").alias("chunk"), F.lit("Z").alias("role"), F.col("window_id").alias("seg_id"), F.lit(0.0).alias("t0"), F.size(data).cast("long").alias("n"), data.alias("data"))
    return baseline.piece_moments(blocks.pack(rows), 4.0, 0.2, 1.5, 12.0).groupBy("station").agg(F.count("*").alias("pieces"), F.sum("n").alias("samples"))


@query(with_views("v_windows") + """, f AS (SELECT window_id, unnest(range(17)) AS k, x FROM v_windows),
dft AS (SELECT window_id, k, list_sum(list_transform(range(64), lambda i: x[i + 1] * cos(2 * pi() * k * i / 64))) AS re, -list_sum(list_transform(range(64), lambda i: x[i + 1] * sin(2 * pi() * k * i / 64))) AS im FROM f),
t AS (SELECT *, unnest(range(32)) AS j FROM dft)
SELECT window_id, CAST(j AS INT) AS i, round(sum((re * cos(2 * pi() * k * j / 32) - im * sin(2 * pi() * k * j / 32)) * CASE WHEN k IN (0, 16) THEN 1 ELSE 2 END) / 64, 6) + 0.0 AS y FROM t GROUP BY window_id, j""")
def resampled(spark, d):
    """Every vector at half its rate, by its Fourier series."""
    import numpy as np
    import pyarrow as pa

    def work(batches):
        for batch in batches:
            out = [signal.resample(np.array(x, np.float64), 2.0, 1.0) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.float64()))], ["window_id", "y"])

    rows = V.windows(spark, d).select("window_id", "x").mapInArrow(work, "window_id bigint, y array<double>")
    return rows.select("window_id", F.posexplode("y").alias("i", "y")).withColumn("y", rounded("y", 6) + 0.0)


@query("SELECT station, event_id, length_s, tag, first_z, total FROM (" + Q.SQL["cut_all_or_nothing"] + ")")
def stored_windows(spark, d):
    """Cut windows written by length and chunk, and read back with their samples."""
    layout = store.Layout(_folder(spark, "out"))
    cut = windows.cut(V.arrivals_at(spark, d), V.segments(spark, d), ["station"], 1 / 600, lengths=(3600.0, 7200.0), pre=1200.0, noise_offset=9000.0, derived=V.segment_samples())
    store.write_windows(cut.withColumn("chunk", F.lit("c")), layout)
    total = F.aggregate(F.flatten("samples"), F.lit(0).cast("long"), lambda a, v: a + v)
    back = spark.read.parquet(layout.windows)
    return back.select(F.col("station").cast("bigint").alias("station"), "event_id", F.col("length_s").cast("double").alias("length_s"), "tag", F.get(F.get("samples", F.lit(0)), F.lit(0)).alias("first_z"), total.alias("total"))


@query(Q._CONDITIONED.replace("(v - m * i - c) * CASE WHEN i < 3 THEN 0.5 - 0.5 * cos(2 * pi() * i / 5) WHEN i > 60 THEN 0.5 - 0.5 * cos(2 * pi() * (63 - i) / 5) ELSE 1 END AS v", "v - (avg(v) OVER (PARTITION BY window_id)) AS v") + " SELECT window_id, CAST(i AS INT) AS i, round(y, 6) + 0.0 AS y FROM clean")
def conditioned_segments(spark, d):
    """Every vector as a vertical segment, as signal to noise is measured on: mean off, band-passed."""
    rows = V.windows(spark, d).select(F.col("window_id").alias("seg_id"), F.lit(0.0).alias("t0"), F.size("x").cast("long").alias("n"), F.col("x").alias("data"))
    out = blocks.values(blocks.filtered(blocks.pack(rows), [], 4.0, 0.2, 1.5), "data")
    return out.select(F.col("seg_id").alias("window_id"), F.posexplode("data").alias("i", "y")).withColumn("y", rounded("y", 6) + 0.0)
