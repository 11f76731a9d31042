"""The registered queries: each operator on the proxy views, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waveline.functions import arrays, names
from waveline.functions.geo import haversine_km
from waveline.functions.numbers import rounded
from waveline.operators import alarms, arrivals, baseline, blocks, coincidence, intervals, segments, snr
from waveline.plans import inventory
from waveline.plans import proxies as V
from waveline.plans.proxies import with_views
from waveline.sources import archive, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
STEP, SPAN_STEP = 3600.0, 900.0


def query(sql: str | None = None):
    """Register a function by its name, with its SQL if there is any."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return put


def r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: rounded(c, 6) for c in cols})


def island_sql(source: str, keys: str, lo: str, hi: str, gap: str, out: str) -> str:
    """Islands of a source in SQL, in one level."""
    return f"""SELECT {keys}, {out} FROM (
      SELECT *, sum(cut) OVER (PARTITION BY {keys} ORDER BY {lo}, {hi}) AS island FROM (
        SELECT *, CASE WHEN ahead IS NULL OR {lo} - ahead > {gap} THEN 1 ELSE 0 END AS cut FROM (
          SELECT *, max({hi}) OVER (PARTITION BY {keys} ORDER BY {lo}, {hi} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ahead FROM {source}))) GROUP BY {keys}, island"""


# --- sources -----------------------------------------------------------------------------------


@query(with_views("v_files") + "SELECT folder AS station, replace(name, '.zip', '') AS chunk, regexp_extract(name, '_(\\d{4}-\\d{2}-\\d{2})', 1) AS chunk_date, name, bytes FROM v_files WHERE regexp_matches(name, '^[A-Z0-9]+_\\d{4}-\\d{2}-\\d{2}\\.zip$')")
def chunk_discovery(spark, d):
    return archive.find_chunks(V.files(spark, d)).drop("path")


@query(with_views("v_files") + "SELECT folder AS station, CASE WHEN ends_with(name, '.part') OR starts_with(name, 'incoming.') THEN 'download in flight' WHEN contains(name, '.dup') THEN 'duplicate delivery' ELSE 'unrecognised name' END AS reason, count(*) AS files FROM v_files WHERE NOT regexp_matches(name, '^[A-Z0-9]+_\\d{4}-\\d{2}-\\d{2}\\.zip$') GROUP BY ALL")
def rejected_files(spark, d):
    return archive.rejected(V.files(spark, d)).groupBy("station", "reason").agg(F.count("*").alias("files"))


@query(with_views("v_files") + "SELECT name, nullif(regexp_extract(name, '_(\\d{4}-\\d{2}-\\d{2})(\\.zip)?$', 1), '') AS chunk_date FROM v_files")
def chunk_date(spark, d):
    return V.files(spark, d).select("name", names.chunk_date("name").alias("chunk_date"))


@query("""SELECT 'S' || (o_custkey % 13) AS station, coalesce(CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END, '?') AS state, epoch_us(o_orderdate) / 1e6 AS lo, epoch_us(o_orderdate) / 1e6 + 86400.0 AS hi
FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0 AND o_orderkey % 83 <> 0""")
def ledger_json_scan(spark, d):
    """JSON lines made of orders, some torn, blank or without a station."""
    iso = lambda s: F.date_format(F.col("o_orderdate") + F.expr(f"interval {s} days"), "yyyy-MM-dd'T'HH:mm:ss")
    station = F.when(F.col("o_orderkey") % 83 != 0, F.concat(F.lit("S"), F.col("o_custkey") % 13))
    row = F.to_json(F.struct(station.alias("station"), F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("state"), F.concat(iso(0), F.lit("Z")).alias("start"), F.concat(iso(1), F.lit("Z")).alias("end")))
    k = F.col("o_orderkey")
    line = F.when(k % 97 == 0, F.substring(row, 1, 9)).when(k % 89 == 0, "").otherwise(row)
    return tables.parse_ledger_lines(V.table(spark, d, "orders").select(line.alias("line")))


@query(with_views("v_ledger") + f"SELECT station, round(lo, 6) AS lo, round(hi, 6) AS hi FROM ({island_sql('(SELECT station, lo, hi FROM v_ledger WHERE state = ' + chr(39) + 'fetched' + chr(39) + ')', 'station', 'lo', 'hi', '0', 'min(lo) AS lo, max(hi) AS hi')})")
def ledger_coalesce(spark, d):
    return r6(tables.spans_in_state(V.ledger(spark, d), tables.FETCHED), "lo", "hi")


_FETCHED = f"fetched AS ({island_sql('(SELECT station, lo, hi FROM v_ledger WHERE state = ' + chr(39) + 'fetched' + chr(39) + ')', 'station', 'lo', 'hi', '0', 'min(lo) AS lo, max(hi) AS hi')})"
_OWED = f"owed AS ({island_sql('(SELECT station, lo, hi FROM v_ledger WHERE state IN (' + chr(39) + 'pending' + chr(39) + ', ' + chr(39) + 'claimed' + chr(39) + ', ' + chr(39) + 'submitted' + chr(39) + '))', 'station', 'lo', 'hi', '0', 'min(lo) AS lo, max(hi) AS hi')})"


@query(with_views("v_ledger") + f", {_FETCHED} SELECT station, CAST(sum(floor((hi - lo) / 86400)) AS BIGINT) AS days FROM fetched GROUP BY station")
def ledger_span_days(spark, d):
    return inventory.span_days(tables.spans_in_state(V.ledger(spark, d), tables.FETCHED), ["station"])


_JOINT = "joint AS (SELECT a.station AS station_a, b.station AS station_b, CAST(sum(floor((least(a.hi, b.hi) - greatest(a.lo, b.lo)) / 86400)) AS BIGINT) AS joint_days FROM fetched a JOIN fetched b ON a.station < b.station AND a.lo < b.hi AND b.lo < a.hi GROUP BY ALL)"


@query(with_views("v_ledger") + f", {_FETCHED}, {_JOINT} SELECT * FROM joint")
def joint_days(spark, d):
    return inventory.joint_days(tables.spans_in_state(V.ledger(spark, d), tables.FETCHED))


def _km(a: str, b: str) -> str:
    return f"2 * 6371.0 * asin(sqrt(pow(sin((radians({b}.lat) - radians({a}.lat)) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin((radians({b}.lon) - radians({a}.lon)) / 2), 2)))"


@query(with_views("v_ledger", "v_ledger_stations") + f", {_FETCHED}, {_JOINT} SELECT round({_km('a', 'b')}, 6) AS separation_km, joint_days, station_a, station_b FROM joint JOIN v_ledger_stations a ON a.station = station_a JOIN v_ledger_stations b ON b.station = station_b WHERE joint_days >= 60")
def station_pairs(spark, d):
    """The flagship: ledgers to disjoint spans to joint coverage to the pairs worth testing."""
    return r6(inventory.station_pairs(tables.spans_in_state(V.ledger(spark, d), tables.FETCHED), V.ledger_stations(spark, d)), "separation_km")


@query(with_views("v_ledger", "v_chunks") + f""", {_FETCHED}, {_OWED},
disk AS (SELECT station, count(*) AS chunks, sum(bytes) AS bytes FROM v_chunks GROUP BY station)
SELECT station, CAST(coalesce(d.chunks, 0) AS BIGINT) AS chunks, CAST(coalesce(d.bytes, 0) AS BIGINT) AS bytes, CAST(coalesce(f.days, 0) AS BIGINT) AS fetched_days, CAST(coalesce(o.days, 0) AS BIGINT) AS pending_days, f.spans, src.sources
FROM (SELECT station, sum(floor((hi - lo) / 86400)) AS days, count(*) AS spans FROM fetched GROUP BY station) f FULL JOIN disk d USING (station)
LEFT JOIN (SELECT station, sum(floor((hi - lo) / 86400)) AS days FROM owed GROUP BY station) o USING (station)
LEFT JOIN (SELECT station, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM v_ledger GROUP BY station) src USING (station)""")
def inventory_survey(spark, d):
    rows = inventory.survey(V.ledger(spark, d), V.chunks(spark, d))
    return rows.select("station", "chunks", "bytes", "fetched_days", "pending_days", F.size("spans").cast("long").alias("spans"), F.array_join("sources", ",").alias("sources"))


@query(with_views("v_ledger", "v_chunks") + f", {_FETCHED}, disk AS (SELECT station, count(*) AS chunks, sum(bytes) AS bytes FROM v_chunks GROUP BY station) SELECT count(*) AS stations, CAST(sum(chunks) AS BIGINT) AS chunks, CAST(sum(bytes) AS BIGINT) AS bytes, CAST(sum(days) AS BIGINT) AS fetched_days FROM disk LEFT JOIN (SELECT station, sum(floor((hi - lo) / 86400)) AS days FROM fetched GROUP BY station) USING (station) WHERE chunks >= 2")
def usable_total(spark, d):
    return inventory.total(inventory.usable(inventory.survey(V.ledger(spark, d), V.chunks(spark, d)))).drop("pending_days")


# --- scalar functions --------------------------------------------------------------------------


@query(with_views("v_catalog") + "SELECT c.event_id, round(" + _km("s", "c") + ", 6) AS dist FROM v_catalog c, (SELECT CAST(38.4 AS DOUBLE) AS lat, CAST(27.1 AS DOUBLE) AS lon) s")
def haversine(spark, d):
    return V.catalog(spark, d).select("event_id", rounded(haversine_km(38.4, 27.1, "lat", "lon"), 6).alias("dist"))


@query(with_views("v_catalog") + "SELECT * FROM (SELECT c.event_id, round(" + _km("s", "c") + ", 6) AS dist, round(mag, 6) AS mag FROM v_catalog c, (SELECT CAST(38.4 AS DOUBLE) AS lat, CAST(30.1 AS DOUBLE) AS lon) s) WHERE dist <= 200 AND mag >= 2")
def catalog_reach(spark, d):
    return r6(tables.load_catalog(V.catalog(spark, d), 38.4, 30.1, 200.0, 2.0).select("event_id", "dist", "mag"), "dist", "mag")


@query(with_views("v_stations") + f"SELECT a.station AS station_a, b.station AS station_b, round({_km('a', 'b')}, 6) AS separation_km FROM v_stations a JOIN v_stations b ON a.station < b.station")
def separation(spark, d):
    return r6(inventory.separations(V.stations(spark, d)), "separation_km")


@query(with_views("v_channels") + "SELECT DISTINCT channel, upper(left(channel, length(channel) - 1)) AS band, upper(right(channel, 1)) AS letter, CASE upper(right(channel, 1)) WHEN 'Z' THEN 'Z' WHEN 'N' THEN 'N' WHEN '1' THEN 'N' WHEN 'E' THEN 'E' WHEN '2' THEN 'E' END AS role FROM v_channels")
def role_split(spark, d):
    return V.channels(spark, d).select("channel", names.band_of("channel").alias("band"), names.role_letter("channel").alias("letter"), names.role_of("channel").alias("role")).distinct()


@query(with_views("v_catalog") + "SELECT event_id, 'event_' || event_id AS tag, trunc(least(mag, 6) * 2) / 2.0 AS band FROM v_catalog")
def magnitude_band(spark, d):
    return V.catalog(spark, d).select("event_id", names.event_tag("event_id").alias("tag"), names.magnitude_band("mag").alias("band"))


@query("SELECT p_partkey, regexp_replace('1d_linear_' || p_brand || '_pid' || p_partkey || '_seed' || p_size || '.pth', '_pid\\d+_seed\\d+\\.pth$', '') AS run FROM part")
def run_identity(spark, d):
    name = F.concat(F.lit("1d_linear_"), F.col("p_brand"), F.lit("_pid"), F.col("p_partkey"), F.lit("_seed"), F.col("p_size"), F.lit(".pth"))
    return V.table(spark, d, "part").select("p_partkey", names.run_identity(name).alias("run"))


@query("""WITH spec AS (SELECT p_partkey, p_size, string_split('a' || p_partkey || ':' || p_size || '.5:dir:cnn' || CASE p_partkey % 3 WHEN 0 THEN ':' || (p_size % 7 + 1) WHEN 1 THEN '' ELSE ':1:2' END, ':') AS f FROM part)
SELECT p_partkey, CASE WHEN ok THEN f[1] END AS name, CASE WHEN ok THEN CAST(f[2] AS DOUBLE) END AS window_seconds, CASE WHEN ok THEN coalesce(CAST(f[5] AS DOUBLE), CAST(f[2] AS DOUBLE)) END AS step_seconds, CASE WHEN ok THEN CAST(round_even(CAST(f[2] AS DOUBLE) * 100, 0) AS INT) END AS win
FROM (SELECT *, len(f) IN (4, 5) AS ok FROM spec)""")
def arm_parse(spark, d):
    k = F.col("p_partkey")
    tail = F.when(k % 3 == 0, F.concat(F.lit(":"), F.col("p_size") % 7 + 1)).when(k % 3 == 1, "").otherwise(":1:2")
    spec = F.concat(F.lit("a"), k, F.lit(":"), F.col("p_size"), F.lit(".5:dir:cnn"), tail)
    cols = names.arm_columns(spec)
    return V.table(spark, d, "part").select("p_partkey", *[cols[c].alias(c) for c in ("name", "window_seconds", "step_seconds", "win")])


@query(with_views("v_windows") + "SELECT window_id, round(list_sum(list_transform(x, lambda v: asinh(v * 1000))), 6) AS total FROM v_windows")
def asinh_transform(spark, d):
    return V.windows(spark, d).select("window_id", rounded(arrays.total(F.transform("x", lambda v: arrays.asinh(v * 1000))), 6).alias("total"))


@query(with_views("v_windows") + "SELECT window_id, CAST(i AS INT) AS i, round(v * CASE WHEN i < 3 THEN 0.5 - 0.5 * cos(2 * pi() * i / 5) WHEN i > 60 THEN 0.5 - 0.5 * cos(2 * pi() * (63 - i) / 5) ELSE 1 END, 9) + 0.0 AS y FROM (SELECT window_id, unnest(x) AS v, unnest(range(64)) AS i FROM v_windows)")
def taper_vector(spark, d):
    """Every vector with its ends tapered."""
    rows = V.windows(spark, d).select("window_id", F.posexplode(arrays.taper("x", 64)).alias("i", "y"))
    return rows.withColumn("y", rounded("y", 9) + 0.0)


@query(with_views("v_windows") + """, e AS (SELECT window_id, unnest(x) AS v, unnest(range(64)) AS i FROM v_windows),
fit AS (SELECT window_id, regr_slope(v, i) AS m, regr_intercept(v, i) AS c FROM e GROUP BY window_id)
SELECT window_id, CAST(i AS INT) AS i, round(v - m * i - c, 6) + 0.0 AS y FROM e JOIN fit USING (window_id)""")
def detrend_linear(spark, d):
    rows = V.windows(spark, d).select("window_id", F.posexplode(arrays.detrend_linear("x")).alias("i", "y"))
    return rows.withColumn("y", rounded("y", 6) + 0.0)


@query(with_views("v_windows") + "SELECT window_id, CAST(unnest(range(64)) AS INT) AS i, round(unnest(list_transform(x, lambda v: (v - list_avg(x)) / greatest(list_stddev_pop(x), 1e-12))), 6) + 0.0 AS y FROM v_windows")
def standardize_perwindow(spark, d):
    rows = V.windows(spark, d).select("window_id", F.posexplode(arrays.standardize_perwindow("x")).alias("i", "y"))
    return rows.withColumn("y", rounded("y", 6) + 0.0)


@query("SELECT s_suppkey, round(greatest(coalesce(CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal / 100 END, s_acctbal), 1e-12), 9) AS sigma FROM supplier")
def sigma_for(spark, d):
    trimmed = F.when(F.col("s_suppkey") % 3 != 0, F.col("s_acctbal") / 100)
    return V.table(spark, d, "supplier").select("s_suppkey", rounded(arrays.sigma_for("s_acctbal", trimmed), 9).alias("sigma"))


# --- segments ----------------------------------------------------------------------------------


@query(with_views("v_channels") + """, c AS (SELECT DISTINCT station, upper(left(channel, length(channel) - 1)) AS band, upper(right(channel, 1)) AS l FROM v_channels),
b AS (SELECT station, band, max(CASE WHEN l = 'Z' THEN band || l END) AS z, coalesce(max(CASE WHEN l = 'N' THEN band || l END), max(CASE WHEN l = '1' THEN band || l END)) AS n, coalesce(max(CASE WHEN l = 'E' THEN band || l END), max(CASE WHEN l = '2' THEN band || l END)) AS e FROM c GROUP BY ALL)
SELECT station, band, z, n, e FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY coalesce(list_position(['HH', 'BH', 'EH', 'SH', 'HN', 'BN', 'EN'], band), 8), band) AS k FROM b WHERE z IS NOT NULL AND n IS NOT NULL AND e IS NOT NULL) WHERE k = 1""")
def band_pick(spark, d):
    return segments.pick_channels(V.channels(spark, d), ["station"])


_RUNS = island_sql("(SELECT *, t0 + n AS fin FROM v_traces)", "station, channel", "t0", "fin", "0.5", "min(t0) AS t0, max(fin) AS fin, count(*) AS traces")


@query(with_views("v_traces") + f"SELECT station, channel, t0, round(fin, 6) AS fin, traces FROM ({_RUNS})")
def trace_runs(spark, d):
    runs = segments.trace_runs(V.traces(spark, d), ["station", "channel"], 1.0)
    out = runs.groupBy("station", "channel", "run").agg(F.min("t0").alias("t0"), F.max(F.col("t0") + F.col("n")).alias("fin"), F.count("*").alias("traces"))
    return r6(out.drop("run"), "fin")


@query(with_views("v_traces") + """SELECT station, channel, count(*) AS traces, count(*) FILTER (contained) AS contained FROM (
  SELECT *, coalesce(t0 + n <= max(t0 + n) OVER (PARTITION BY station, channel ORDER BY t0, n DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS contained FROM v_traces) GROUP BY ALL""")
def contained_traces(spark, d):
    rows = segments.trace_runs(V.traces(spark, d), ["station", "channel"], 1.0)
    return rows.groupBy("station", "channel").agg(F.count("*").alias("traces"), F.count_if("contained").alias("contained"))


def _segments(spark, d) -> DataFrame:
    runs = segments.trace_runs(V.traces(spark, d), ["station", "channel"], 1.0)
    segs = runs.groupBy("station", "channel", "run").agg(F.min("t0").alias("t0"), (F.max(F.col("t0") + F.col("n")) - F.min("t0")).cast("long").alias("n"))
    return segs.select("station", names.role_of("channel").alias("role"), F.col("run").alias("seg_id"), "t0", "n")


_SEGS = f"segs AS (SELECT station, right(channel, 1) AS role, t0, t0 + CAST(fin - t0 AS BIGINT) AS fin FROM ({_RUNS}))"
_SPANS = """spans AS (SELECT z.station, greatest(z.t0, n.t0, e.t0) AS t0, least(z.fin, n.fin, e.fin) AS fin, z.t0 AS zt, n.t0 AS nt, e.t0 AS et FROM segs z JOIN segs n ON z.station = n.station AND z.t0 < n.fin AND n.t0 < z.fin JOIN segs e ON e.station = z.station AND e.t0 < least(z.fin, n.fin) AND greatest(z.t0, n.t0) < e.fin
  WHERE z.role = 'Z' AND n.role = 'N' AND e.role = 'E' AND least(z.fin, n.fin, e.fin) - greatest(z.t0, n.t0, e.t0) >= 3600)"""


@query(with_views("v_traces") + f", {_SEGS}, {_SPANS} SELECT station, t0, CAST(t0 - zt AS BIGINT) AS off_z, CAST(t0 - nt AS BIGINT) AS off_n, CAST(t0 - et AS BIGINT) AS off_e, CAST(fin - t0 AS BIGINT) AS n FROM spans")
def common_spans3(spark, d):
    return intervals.common_spans(_segments(spark, d), ["station"], 1.0, 3600).select("station", "t0", "off_z", "off_n", "off_e", "n")


@query(with_views("v_traces") + f""", {_SEGS}, {_SPANS}, near AS (SELECT station, t0 + 1000.5 AS lo, t0 + 30000.25 AS hi FROM spans),
met AS (SELECT s.station, s.t0, CAST(s.fin - s.t0 AS BIGINT) AS n, greatest(s.t0, near.lo) AS lo, least(s.fin, near.hi) AS hi FROM spans s JOIN near ON s.station = near.station AND s.t0 < near.hi AND near.lo < s.fin),
k AS (SELECT *, CAST(ceil((lo - t0) / 900) AS BIGINT) AS k0 FROM met WHERE hi - lo >= 1800),
w AS (SELECT *, CAST(floor(CAST(trunc((hi - t0) - k0 * 900 - 1800) AS BIGINT) / 900.0) AS BIGINT) + 1 AS nw FROM k)
SELECT station, t0 + k0 * 900.0 AS t0, CAST(nw * 900 + 1800 - 900 AS BIGINT) AS n, CAST(k0 * 900 AS BIGINT) AS shift FROM w WHERE nw >= 1""")
def clip_spans(spark, d):
    spans = intervals.common_spans(_segments(spark, d), ["station"], 1.0, 3600).select("station", "t0", "n")
    near = spans.select("station", (F.col("t0") + 1000.5).alias("lo"), (F.col("t0") + 30000.25).alias("hi"))
    return intervals.clip_spans(spans, near, ["station"], 1.0, 1800, 900).select("station", "t0", "n", "shift")


@query(with_views("v_traces") + f", {_SEGS}, {_SPANS} SELECT station, count(*) AS windows, min(t) AS first, max(t) AS last FROM (SELECT station, t0 + 900.0 * unnest(range(CAST(floor((fin - t0 - 1800) / 900) AS BIGINT) + 1)) AS t FROM spans WHERE fin - t0 >= 1800) GROUP BY station")
def window_times(spark, d):
    spans = intervals.common_spans(_segments(spark, d), ["station"], 1.0, 3600).select("station", "t0", "n")
    rows = intervals.window_times(spans, 1.0, 1800, 900)
    return rows.groupBy("station").agg(F.count("*").alias("windows"), F.min("t").alias("first"), F.max("t").alias("last"))


@query(with_views("v_traces") + f", {_SEGS} SELECT station, min(t0) AS first, max_by(fin, t0) AS last FROM segs WHERE role = 'Z' GROUP BY station")
def span_of(spark, d):
    return segments.span_of(_segments(spark, d).where("role = 'Z'"), ["station"], 1.0)


# --- scores and alarms -------------------------------------------------------------------------

_COVER = "cover AS (" + island_sql("v_scores", "station", "t", "t", f"2.5 * {SPAN_STEP}", f"min(t) AS lo, max(t) + {SPAN_STEP} AS hi") + ")"


@query(with_views("v_scores") + f", {_COVER} SELECT station, round(lo, 6) AS lo, round(hi, 6) AS hi FROM cover")
def coverage_spans(spark, d):
    return r6(intervals.coverage_spans(V.scores(spark, d), ["station"], SPAN_STEP), "lo", "hi")


_BOTH = "both_on AS (SELECT a.station AS station_a, b.station AS station_b, greatest(a.lo, b.lo) AS lo, least(a.hi, b.hi) AS hi FROM cover a JOIN cover b ON a.station < b.station AND a.lo < b.hi AND b.lo < a.hi)"


@query(with_views("v_scores") + f", {_COVER}, {_BOTH} SELECT station_a, station_b, round(lo, 6) AS lo, round(hi, 6) AS hi FROM both_on")
def intersect_spans(spark, d):
    cover = intervals.coverage_spans(V.scores(spark, d), ["station"], SPAN_STEP).withColumn("_k", F.lit(0))
    a, b = (cover.withColumnRenamed("station", f"station_{s}") for s in "ab")
    both = intervals.intersect(a, b, ["_k"], carry=(["station_a"], ["station_b"])).where("station_a < station_b")
    return r6(both.drop("_k"), "lo", "hi")


@query(with_views("v_scores", "v_catalog") + f", {_COVER} SELECT s.station, c.event_id FROM v_catalog c, (SELECT DISTINCT station FROM v_scores) s WHERE EXISTS (SELECT 1 FROM cover v WHERE v.station = s.station AND c.t BETWEEN v.lo AND v.hi)")
def point_in_spans(spark, d):
    scores = V.scores(spark, d)
    cover = intervals.coverage_spans(scores, ["station"], SPAN_STEP)
    codes = F.explode(F.array(*map(F.lit, ["click", "error", "purchase", "signup", "view"]))).alias("station")
    return intervals.points_in(V.catalog(spark, d).select("event_id", "t", codes), cover, ["station"]).select("station", "event_id")


def _declared(thr: float, name: str) -> str:
    hits = f"(SELECT * FROM v_scores WHERE p > {thr})"
    isl = island_sql(hits, "station", "t", "t", STEP, "min(struct_pack(np := -p, t := t)) AS peak")
    return f"{name} AS (SELECT station, peak.t AS t, -peak.np AS p FROM ({isl}))"


@query(with_views("v_scores") + f", {_declared(0.99, 'dec')} SELECT station, round(t, 6) AS t, round(p, 6) AS p FROM dec")
def declarations(spark, d):
    return r6(alarms.declarations(V.scores(spark, d), ["station"], 0.99, STEP), "t", "p")


@query(with_views("v_scores") + f", {_declared(0.99, 'dec')} SELECT a.station, round(a.t, 6) AS t, round(a.p, 6) AS p FROM dec a WHERE a.station <> 'view' AND EXISTS (SELECT 1 FROM dec b WHERE b.station = 'view' AND abs(b.t - a.t) <= 1800)")
def confirmed_band_semi(spark, d):
    dec = alarms.declarations(V.scores(spark, d), ["station"], 0.99, STEP).withColumn("_k", F.lit(0))
    return r6(intervals.within(dec.where("station <> 'view'"), dec.where("station = 'view'"), ["_k"], 1800.0).drop("_k"), "t", "p")


def _arrivals(spark, d) -> DataFrame:
    return arrivals.predicted_arrivals(V.catalog(spark, d), V.stations(spark, d), arrivals.straight_table(spark))


_ARRIVALS = f"""near AS (SELECT s.station, c.*, {_km('s', 'c')} AS dist FROM v_catalog c, v_stations s),
arr AS (SELECT station, event_id, t, dist, depth, sqrt(pow(round_even(dist / 5, 0) * 5, 2) + pow(round_even(greatest(coalesce(depth, 10), 0) / 5, 0) * 5, 2)) AS path FROM near WHERE dist <= 500),
arrivals AS (SELECT station, event_id, dist, path / 6 AS tt_p, path / 3.5 AS tt_s, t + path / 6 AS p_epoch, t + path / 3.5 AS s_epoch FROM arr)"""


def _reach_sql(p: str) -> str:
    """How far a ray of a slowness gets on its way up through three layers."""
    return " + ".join(f"CASE WHEN u{k} > 0 THEN u{k} * {p} / sqrt(greatest(1 / (v{k} * v{k}) - {p} * {p}, 1e-300)) ELSE 0 END" for k in (1, 2, 3))


_SPEEDS = ", ".join("(" + ", ".join([f"'{ph}'", *(f"{layer[1 + k]}::DOUBLE" for layer in arrivals.CRUST)]) + ")" for k, ph in enumerate("PS"))
_Z1, _Z2 = (top for top, *_ in arrivals.CRUST[1:])
#: Direct rays by halving their slowness and head waves in closed form, for the crust's three layers.
_RAYS = f"""near AS (SELECT s.station, c.*, {_km('s', 'c')} AS dist FROM v_catalog c, v_stations s),
arr AS (SELECT *, round_even(dist / 5, 0) AS di, round_even(greatest(coalesce(depth, 10), 0) / 5, 0) AS zi FROM near WHERE dist <= 500),
cell AS (SELECT *, 5 * di AS x, least(5 * zi, {_Z1}) AS u1, greatest(least(5 * zi, {_Z2}) - {_Z1}, 0) AS u2, greatest(5 * zi - {_Z2}, 0) AS u3 FROM (SELECT DISTINCT di, zi FROM arr), (VALUES {_SPEEDS}) AS y(phase, v1, v2, v3)),
ray AS (SELECT *, 0::DOUBLE AS lo, 1 / CASE WHEN u3 > 0 THEN v3 WHEN u2 > 0 THEN v2 ELSE v1 END AS hi, 0 AS n FROM cell
  UNION ALL SELECT * EXCLUDE (lo, hi, n, mid), CASE WHEN {_reach_sql('mid')} < x THEN mid ELSE lo END, CASE WHEN {_reach_sql('mid')} < x THEN hi ELSE mid END, n + 1 FROM (SELECT *, (lo + hi) / 2 AS mid FROM ray WHERE n < 60)),
slant AS (SELECT *, sqrt(1 / (v1 * v1) - 1 / (v2 * v2)) AS e12, sqrt(1 / (v1 * v1) - 1 / (v3 * v3)) AS e13, sqrt(1 / (v2 * v2) - 1 / (v3 * v3)) AS e23 FROM ray WHERE n = 60),
times AS (SELECT phase, di, zi, least(
  CASE WHEN zi = 0 THEN x / v1 ELSE lo * x + {' + '.join(f'CASE WHEN u{k} > 0 THEN u{k} * sqrt(1 / (v{k} * v{k}) - lo * lo) ELSE 0 END' for k in (1, 2, 3))} END,
  CASE WHEN 5 * zi <= {_Z1} AND x >= ({2 * _Z1} - u1) / v2 / e12 THEN x / v2 + ({2 * _Z1} - u1) * e12 ELSE 1e9 END,
  CASE WHEN 5 * zi <= {_Z2} AND x >= ({2 * _Z1} - u1) / v3 / e13 + ({2 * (_Z2 - _Z1)} - u2) / v3 / e23 THEN x / v3 + ({2 * _Z1} - u1) * e13 + ({2 * (_Z2 - _Z1)} - u2) * e23 ELSE 1e9 END) AS tt FROM slant)"""


@query(with_views("v_catalog", "v_stations").replace("WITH", "WITH RECURSIVE", 1) + f", {_RAYS} SELECT station, event_id, round(dist, 6) AS dist, round(p.tt, 6) AS tt_p, round(s.tt, 6) AS tt_s, round(s.tt - p.tt, 6) AS sp_seconds, CAST(round_even((t + p.tt) * 1000, 0) AS BIGINT) AS p_ms FROM arr JOIN times p USING (di, zi) JOIN times s USING (di, zi) WHERE p.phase = 'P' AND s.phase = 'S'")
def predicted_arrivals(spark, d):
    """Every event by the stations within reach, by rays through the crust's layers."""
    events = V.catalog(spark, d)
    found = arrivals.predicted_arrivals(events, V.stations(spark, d), arrivals.catalogue_table(events, layers=arrivals.CRUST))
    rows = r6(found, "dist", "tt_p", "tt_s", "sp_seconds")
    return rows.select("station", "event_id", "dist", "tt_p", "tt_s", "sp_seconds", F.rint(F.col("p_epoch") * 1000).cast("bigint").alias("p_ms"))


@query(with_views("v_catalog", "v_stations") + f", {_ARRIVALS}, cells AS (SELECT DISTINCT round_even(dist / 5, 0), round_even(greatest(coalesce(depth, 10), 0) / 5, 0) FROM arr) SELECT (SELECT count(*) FROM arr) AS calls, count(*) AS distinct_cells, (SELECT count(*) FROM arr) - count(*) AS hits, round(1 - count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM arr), 9) AS hit_rate FROM cells")
def travel_grid_statistics(spark, d):
    near = arrivals.near_stations(V.catalog(spark, d), V.stations(spark, d))
    return arrivals.grid_statistics(near).withColumn("hit_rate", rounded("hit_rate", 9))


@query(with_views("v_scores", "v_catalog", "v_stations") + f", {_ARRIVALS} SELECT s.station, count(*) AS windows, round(avg(p), 6) AS mean_p FROM v_scores s WHERE NOT EXISTS (SELECT 1 FROM arrivals a WHERE a.station = s.station AND s.t BETWEEN a.p_epoch - 310 AND a.p_epoch + 600) GROUP BY s.station")
def background_guard(spark, d):
    quiet = intervals.unexplained(V.scores(spark, d), _arrivals(spark, d), ["station"], 300.0, 10.0, 600.0)
    return quiet.groupBy("station").agg(F.count("*").alias("windows"), rounded(F.avg("p"), 6).alias("mean_p"))


@query(with_views("v_scores") + """, n AS (SELECT station, count(*) AS n FROM v_scores GROUP BY station), q AS (SELECT station, n, budget, 1 - budget * 30 / n AS q FROM n, (VALUES (100.0), (30.0), (10.0), (3.0), (1.0), (0.1)) AS b(budget) WHERE budget * 30 < n),
r AS (SELECT station, p, row_number() OVER (PARTITION BY station ORDER BY p) - 1 AS k FROM v_scores)
SELECT station, CAST(budget AS DOUBLE) AS budget, n, round(lo.p + (hi.p - lo.p) * (q * (n - 1) - floor(q * (n - 1))), 6) AS thr FROM q JOIN r lo USING (station) JOIN r hi USING (station) WHERE lo.k = floor(q * (n - 1)) AND hi.k = ceil(q * (n - 1))""")
def budget_thresholds(spark, d):
    scores = V.scores(spark, d)
    days = scores.select("station").distinct().withColumn("days", F.lit(30.0))
    return r6(alarms.thresholds(scores, ["station"], list(coincidence.BUDGETS), days).drop("days"), "thr")


@query(with_views("v_scores") + "SELECT station, median(d) AS step FROM (SELECT station, t - lag(t) OVER (PARTITION BY station ORDER BY t) AS d FROM v_scores) WHERE d IS NOT NULL GROUP BY station")
def median_step(spark, d):
    return alarms.median_step(V.scores(spark, d), ["station"])


@query(with_views("v_scores") + "SELECT station, count(*) AS windows, round(count(*) * 6 / 86400.0, 6) AS days, round(avg(CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END), 6) AS share_over_half FROM v_scores GROUP BY station")
def score_summary(spark, d):
    return r6(alarms.score_summary(V.scores(spark, d), ["station"], 6.0), "days", "share_over_half")


_COINCIDENCE = with_views("v_scores", "v_catalog", "v_stations", "v_snr") + f""", {_ARRIVALS},
pairs AS (SELECT a.station AS station_a, b.station AS station_b, {_km('a', 'b')} AS separation_km FROM v_stations a JOIN v_stations b ON a.station < b.station),
steps AS (SELECT station, median(d) AS step FROM (SELECT station, t - lag(t) OVER (PARTITION BY station ORDER BY t) AS d FROM v_scores) WHERE d IS NOT NULL GROUP BY station),
need AS (SELECT p.station_a, p.station_b, side, CASE side WHEN 'a' THEN station_a ELSE station_b END AS station, step FROM pairs p JOIN steps s ON s.station = p.station_a, (VALUES ('a'), ('b')) AS x(side)),
sc AS (SELECT n.*, v.t, v.p FROM need n JOIN v_scores v USING (station)),
cov AS ({island_sql('sc', 'station_a, station_b, side, step', 't', 't', '2.5 * step', 'min(t) AS lo, max(t) + step AS hi')}),
spans AS (SELECT a.station_a, a.station_b, greatest(a.lo, b.lo) AS lo, least(a.hi, b.hi) AS hi FROM cov a JOIN cov b ON a.station_a = b.station_a AND a.station_b = b.station_b AND a.side = 'a' AND b.side = 'b' AND a.lo < b.hi AND b.lo < a.hi),
facts AS (SELECT station_a, station_b, separation_km, 1800.0 AS w, sum(hi - lo) / 86400 AS days FROM spans JOIN pairs USING (station_a, station_b) GROUP BY ALL HAVING sum(hi - lo) / 86400 >= 1),
inspan AS (SELECT * FROM sc WHERE EXISTS (SELECT 1 FROM spans x WHERE x.station_a = sc.station_a AND x.station_b = sc.station_b AND sc.t BETWEEN x.lo AND x.hi)),
seen AS (SELECT n.station_a, n.station_b, n.side, n.station, r.event_id, r.p_epoch FROM need n JOIN arrivals r USING (station) WHERE EXISTS (SELECT 1 FROM spans x WHERE x.station_a = n.station_a AND x.station_b = n.station_b AND r.p_epoch BETWEEN x.lo AND x.hi)),
quiet AS (SELECT * FROM inspan i WHERE NOT EXISTS (SELECT 1 FROM seen e WHERE e.station_a = i.station_a AND e.station_b = i.station_b AND e.side = i.side AND i.t BETWEEN e.p_epoch - 310 AND e.p_epoch + 60)),
ranked AS (SELECT station_a, station_b, side, p, row_number() OVER (PARTITION BY station_a, station_b, side ORDER BY p) - 1 AS k, count(*) OVER (PARTITION BY station_a, station_b, side) AS n FROM quiet),
asked AS (SELECT station_a, station_b, side, n, budget, (1 - budget * days / n) * (n - 1) AS pos FROM (SELECT DISTINCT station_a, station_b, side, n FROM ranked) JOIN facts USING (station_a, station_b), (VALUES (100.0), (30.0), (10.0), (3.0), (1.0), (0.1)) AS b(budget) WHERE budget * days < n),
limits AS (SELECT q.station_a, q.station_b, q.side, q.budget, lo.p + (hi.p - lo.p) * (pos - floor(pos)) AS thr FROM asked q JOIN ranked lo ON q.station_a = lo.station_a AND q.station_b = lo.station_b AND q.side = lo.side AND lo.k = floor(pos) JOIN ranked hi ON q.station_a = hi.station_a AND q.station_b = hi.station_b AND q.side = hi.side AND hi.k = ceil(pos)),
thr AS (SELECT a.station_a, a.station_b, a.budget, a.thr AS thr_a, b.thr AS thr_b FROM limits a JOIN limits b ON a.station_a = b.station_a AND a.station_b = b.station_b AND a.budget = b.budget AND a.side = 'a' AND b.side = 'b'),
hits AS (SELECT q.station_a, q.station_b, q.side, l.budget, q.t, q.p FROM quiet q JOIN limits l ON q.station_a = l.station_a AND q.station_b = l.station_b AND q.side = l.side AND q.p > l.thr),
dec AS (SELECT station_a, station_b, side, budget, peak.t AS t FROM ({island_sql('hits', 'station_a, station_b, side, budget', 't', 't', STEP, 'min(struct_pack(np := -p, t := t)) AS peak')})),
counted AS (SELECT station_a, station_b, budget, count(*) FILTER (side = 'a') AS na, count(*) FILTER (side = 'b') AS nb, count(*) FILTER (side = 'a' AND EXISTS (SELECT 1 FROM dec o WHERE o.side = 'b' AND o.station_a = dec.station_a AND o.station_b = dec.station_b AND o.budget = dec.budget AND abs(o.t - dec.t) <= 1800)) AS n2 FROM dec GROUP BY ALL),
good AS (SELECT * FROM (SELECT s.*, count(DISTINCT side) OVER (PARTITION BY station_a, station_b, event_id) AS sides FROM seen s JOIN (SELECT event_id FROM v_snr GROUP BY event_id HAVING max(snr) >= 3) USING (event_id)) WHERE sides = 2),
best AS (SELECT g.station_a, g.station_b, g.side, g.event_id, max(i.p) AS best FROM good g LEFT JOIN inspan i ON i.station_a = g.station_a AND i.station_b = g.station_b AND i.side = g.side AND i.t BETWEEN g.p_epoch - 300 AND g.p_epoch + 600 GROUP BY ALL),
fired AS (SELECT station_a, station_b, budget, event_id, bool_and(coalesce(best > thr, false)) AS hit FROM best JOIN limits USING (station_a, station_b, side) GROUP BY ALL),
rec AS (SELECT station_a, station_b, budget, avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END) AS recall_both FROM fired GROUP BY ALL),
vals AS (SELECT t.*, f.separation_km, f.days, f.w, coalesce(na, 0) AS na, coalesce(nb, 0) AS nb, coalesce(n2, 0) AS n2, recall_both FROM thr t JOIN facts f USING (station_a, station_b) LEFT JOIN counted USING (station_a, station_b, budget) LEFT JOIN rec USING (station_a, station_b, budget)),
indep AS (SELECT *, na / (days * 86400) * (1 - exp(-(nb / (days * 86400)) * 2 * w)) * 86400 AS indep FROM vals)
"""


def _coincidence(spark, d) -> DataFrame:
    scores, places = V.scores(spark, d), V.stations(spark, d)
    return coincidence.measure(scores, inventory.separations(places), alarms.median_step(scores, ["station"]), _arrivals(spark, d), _readings(spark, d), 300.0, coincidence_seconds=1800.0, cluster_seconds=STEP, signal_post=600.0)


@query(_COINCIDENCE + "SELECT CAST(budget AS DOUBLE) AS budget_per_day, round(separation_km, 6) AS separation_km, round(days, 6) AS joint_days, CAST(w AS DOUBLE) AS coincidence_seconds, station_a, station_b, round(thr_a, 6) AS thr_a, round(thr_b, 6) AS thr_b, round(na / days, 6) AS a_per_day, round(nb / days, 6) AS b_per_day, round(n2 / days, 6) AS both_per_day, round(indep, 6) AS independent_per_day, round(CASE WHEN indep > 0 THEN n2 / days / indep END, 6) AS excess_over_independent FROM indep")
def coincidence_table(spark, d):
    numbers = ["separation_km", "joint_days", "thr_a", "thr_b", "a_per_day", "b_per_day", "both_per_day", "independent_per_day", "excess_over_independent"]
    return r6(_coincidence(spark, d).drop("recall_both"), *numbers)


@query(_COINCIDENCE + "SELECT station_a, station_b, CAST(budget AS DOUBLE) AS budget_per_day, round(recall_both, 6) AS recall_both FROM indep")
def recall_both(spark, d):
    return r6(_coincidence(spark, d).select("station_a", "station_b", "budget_per_day", "recall_both"), "recall_both")


def _readings(spark, d) -> DataFrame:
    """The larger reading of each event, at every station."""
    return snr.largest(V.snr(spark, d)).withColumn("station", F.explode(F.array(*map(F.lit, ["click", "error", "purchase", "signup", "view"]))))


@query(with_views("v_catalog", "v_stations", "v_snr") + f", {_ARRIVALS}, g AS (SELECT a.* FROM arrivals a JOIN (SELECT event_id FROM v_snr GROUP BY event_id HAVING max(snr) >= 3) USING (event_id)), two AS (SELECT a.station AS station_a, b.station AS station_b, abs(a.p_epoch - b.p_epoch) AS d FROM g a JOIN g b ON a.event_id = b.event_id AND a.station < b.station) SELECT station_a, station_b, count(*) AS events, round(min(d), 4) AS least, round(max(d), 4) AS greatest, round(median(d), 4) AS median FROM two GROUP BY ALL")
def arrival_differences(spark, d):
    pairs = inventory.separations(V.stations(spark, d))
    sides = [pairs.select("station_a", "station_b", F.lit(s).alias("side"), F.col(f"station_{s}").alias("station")) for s in "ab"]
    seen = _arrivals(spark, d).select("station", "event_id", "p_epoch").join(sides[0].unionByName(sides[1]), "station")
    out = coincidence.arrival_differences(coincidence.good_events(seen, _readings(spark, d)))
    return out.withColumns({c: rounded(c, 4) for c in ("least", "greatest", "median")})


# --- signal to noise, baseline, cutting --------------------------------------------------------


@query(with_views("v_snr") + "SELECT event_id, round(max(snr), 6) AS snr FROM v_snr GROUP BY event_id")
def load_snr_max(spark, d):
    return r6(snr.largest(V.snr(spark, d)), "snr")


@query(with_views("v_snr") + "SELECT event_id, round(snr, 6) AS snr, time, part FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY part, time, snr) AS k FROM v_snr) WHERE k = 1")
def snr_rollup_first(spark, d):
    return r6(snr.roll_up(V.snr(spark, d), [], ["part", "time", "snr"]), "snr")


@query(with_views("v_snr") + "SELECT part, count(*) AS events, round(median(snr), 6) AS median_snr, round(avg(CASE WHEN snr >= 3 THEN 1.0 ELSE 0.0 END), 6) AS share_over_3 FROM v_snr GROUP BY part")
def snr_summary(spark, d):
    return r6(snr.summary(V.snr(spark, d), ["part"]), "median_snr", "share_over_3")


@query(with_views("v_windows") + "SELECT window_id, round(sqrt(list_avg(list_transform(x[41:64], lambda v: v * v))) / sqrt(list_avg(list_transform(x[1:40], lambda v: v * v))), 6) AS snr FROM v_windows")
def snr_rms_ratio(spark, d):
    ratio = snr.ratio_of(arrays.rms(F.slice("x", 41, 24)), arrays.rms(F.slice("x", 1, 40)))
    return V.windows(spark, d).select("window_id", rounded(ratio, 6).alias("snr"))


def _pieces(spark, d) -> DataFrame:
    x = F.col("x")
    return V.windows(spark, d).select("station", F.lit("Z").alias("role"), arrays.total(x).alias("s"), arrays.total(F.transform(x, lambda v: v * v)).alias("ss"), F.size(x).cast("long").alias("n"))


_PIECES = "pieces AS (SELECT station, list_sum(x) AS s, list_sum(list_transform(x, lambda v: v * v)) AS ss, len(x) AS n, sqrt(greatest(list_sum(list_transform(x, lambda v: v * v)) / len(x) - pow(list_sum(x) / len(x), 2), 0)) AS sd FROM v_windows)"


@query(with_views("v_windows") + f", {_PIECES} SELECT station, round(sum(s) / sum(n), 6) AS mu, round(sqrt(greatest(sum(ss) / sum(n) - pow(sum(s) / sum(n), 2), 0)), 6) AS sigma, round(median(sd), 6) AS sigma_median, CAST(sum(n) AS BIGINT) AS n_samples, count(*) AS n_pieces FROM pieces GROUP BY station")
def baseline_moments(spark, d):
    return r6(baseline.noise_statistics(_pieces(spark, d)).select("station", "mu", "sigma", "sigma_median", "n_samples", "n_pieces"), "mu", "sigma", "sigma_median")


@query(with_views("v_windows") + f", {_PIECES}, lim AS (SELECT station, quantile_cont(sd, 0.9) AS lim FROM pieces GROUP BY station), q AS (SELECT station, sum(s) / sum(n) AS m, sum(ss) / sum(n) AS m2 FROM pieces JOIN lim USING (station) WHERE sd <= lim GROUP BY station), a AS (SELECT station, sqrt(greatest(sum(ss) / sum(n) - pow(sum(s) / sum(n), 2), 0)) AS sigma FROM pieces GROUP BY station) SELECT station, round(sqrt(greatest(m2 - m * m, 0)), 6) AS sigma_trimmed, sigma > 2 * sqrt(greatest(m2 - m * m, 0)) AS loud FROM q JOIN a USING (station)")
def baseline_trimmed(spark, d):
    return r6(baseline.noise_statistics(_pieces(spark, d)).select("station", "sigma_trimmed", "loud"), "sigma_trimmed")


@query(with_views("v_windows") + f", {_PIECES}, u AS (SELECT station, sum(s) / sum(n) AS mu, sqrt(greatest(sum(ss) / sum(n) - pow(sum(s) / sum(n), 2), 0)) AS sigma FROM pieces GROUP BY station) SELECT window_id, round(list_avg(list_transform(x, lambda v: (v - mu) / sigma)), 6) + 0.0 AS mean_z, round(list_max(list_transform(x, lambda v: (v - mu) / sigma)), 6) AS max_z FROM v_windows JOIN u USING (station)")
def standardize_station(spark, d):
    units = baseline.noise_statistics(_pieces(spark, d)).select("station", "mu", arrays.sigma_for("sigma").alias("sigma"))
    rows = V.windows(spark, d).join(units, "station").withColumn("z", arrays.standardize_by("x", F.col("mu"), F.col("sigma")))
    return rows.select("window_id", (rounded(arrays.mean("z"), 6) + 0.0).alias("mean_z"), rounded(F.array_max("z"), 6).alias("max_z"))


@query(with_views("v_chunks") + ", n AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY chunk) - 1 AS i, count(*) OVER (PARTITION BY station) AS n FROM v_chunks) SELECT station, chunk FROM n WHERE list_contains(list_transform(range(CAST(least(n, 6) AS BIGINT)), lambda j: round_even(j * (n - 1) / CAST(greatest(least(n, 6) - 1, 1) AS DOUBLE), 0)), CAST(i AS DOUBLE))")
def even_sample(spark, d):
    return baseline.even_sample(V.chunks(spark, d).select("station", "chunk"), ["station"], "chunk")


@query("SELECT station, freqmin, freqmax, freqmin IS NULL OR (freqmin = 1 AND freqmax = 45) AS fits FROM (SELECT s_suppkey AS station, CASE WHEN s_suppkey % 5 <> 0 THEN CAST(1 + s_suppkey % 2 AS DOUBLE) END AS freqmin, CASE WHEN s_suppkey % 5 <> 0 THEN 45.0::DOUBLE END AS freqmax FROM supplier)")
def passband_gate(spark, d):
    k = F.col("s_suppkey")
    rows = V.table(spark, d, "supplier").select(k.alias("station"), F.when(k % 5 != 0, (1 + k % 2).cast("double")).alias("freqmin"), F.when(k % 5 != 0, F.lit(45.0)).alias("freqmax"))
    return baseline.passband_fits(rows, 1.0, 45.0).drop("reason")


#: A segment's first sample of a window, the same in all cutting: the first segment that holds it whole.
_HELD = """held AS (SELECT q.*, g.seg_id, g.base, CAST(round_even((q.start - g.t0) / 600, 0) AS BIGINT) AS pos FROM asked q JOIN v_segments g ON g.station = q.station AND g.role = q.role
  WHERE round_even((q.start - g.t0) / 600, 0) >= 0 AND round_even((q.start - g.t0) / 600, 0) + q.want <= g.n),
got AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station, event_id, kind, want, role ORDER BY seg_id) AS k FROM held) WHERE k = 1)"""


@query(with_views("v_segments", "v_arrivals_at") + f""", ext AS (SELECT station, min(t0) AS lo, max(t0 + n * 600) AS hi FROM v_segments GROUP BY station),
near AS (SELECT e.* FROM v_arrivals_at e JOIN ext USING (station) WHERE p_epoch >= lo + 9000 AND p_epoch <= hi - 60),
asked AS (SELECT station, event_id, kind, role, want, CASE kind WHEN 'eq' THEN cut_epoch - 1200 ELSE p_epoch - 9000 END AS start FROM near, (VALUES ('eq'), ('noise')) AS x(kind), (VALUES ('Z'), ('N'), ('E')) AS y(role), (VALUES (6), (12)) AS w(want)),
{_HELD}, whole AS (SELECT station, event_id, kind, want, start, max(CASE role WHEN 'Z' THEN (base + pos * 7) % 1000 END) AS first_z, sum(list_sum(list_transform(range(want), lambda j: (base + (pos + j) * 7) % 1000))) AS total FROM got GROUP BY ALL HAVING count(*) = 3),
kept AS (SELECT *, count(*) OVER (PARTITION BY station, event_id) AS windows FROM whole)
SELECT station, event_id, want * 600.0::DOUBLE AS length_s, CASE kind WHEN 'noise' THEN 'noise_' ELSE '' END || 'event_' || event_id || '_raw' AS tag, start AS t0, CAST(first_z AS INT) AS first_z, CAST(total AS BIGINT) AS total FROM kept WHERE windows = 4""")
def cut_all_or_nothing(spark, d):
    """Every order's windows, with their samples, where all components hold them whole at both lengths."""
    from waveline.operators import windows

    out = windows.cut(V.arrivals_at(spark, d), V.segments(spark, d), ["station"], 1 / 600, lengths=(3600.0, 7200.0), pre=1200.0, noise_offset=9000.0, derived=V.segment_samples())
    total = F.aggregate(F.flatten("samples"), F.lit(0).cast("long"), lambda a, v: a + v)
    return out.select("station", "event_id", "length_s", "tag", "t0", F.get(F.get("samples", F.lit(0)), F.lit(0)).alias("first_z"), total.alias("total"))


@query(with_views("v_segments", "v_arrivals_at") + f""", asked AS (SELECT station, event_id, 'Z' AS role, kind, want, p_epoch + lo AS start FROM v_arrivals_at, (VALUES ('noise', 50, -36000), ('signal', 13, -600)) AS x(kind, want, lo)),
{_HELD}, parts AS (SELECT station, event_id, kind, sqrt(list_avg(list_transform(range(want), lambda j: pow((base + (pos + j) * 7) % 1000, 2)))) AS v FROM got)
SELECT e.station, e.event_id, round(s.v / nullif(n.v, 0), 6) AS snr, s.v / nullif(n.v, 0) IS NULL AS dropped FROM v_arrivals_at e LEFT JOIN parts s ON s.station = e.station AND s.event_id = e.event_id AND s.kind = 'signal' LEFT JOIN parts n ON n.station = e.station AND n.event_id = e.event_id AND n.kind = 'noise'""")
def snr_measure(spark, d):
    """Every order's signal over noise from samples; null where either straddles a gap."""
    vertical = V.headers(spark, d).where("role = 'Z'").drop("role")
    out = snr.measure(vertical, V.arrivals_at(spark, d), ["station"], 1 / 600, None, (-36000.0, -6000.0), (-600.0, 7200.0), V.segment_samples())
    return r6(out.select("station", "event_id", "snr", "dropped"), "snr")


# --- work to do --------------------------------------------------------------------------------

_MISSING = "need AS (SELECT c.station, c.chunk, product FROM v_chunks c, (VALUES ('scores6s'), ('range'), ('cut6'), ('cut10')) AS p(product)), missing AS (SELECT n.* FROM need n ANTI JOIN v_done d ON n.station = d.station AND n.chunk = d.chunk AND n.product = d.product)"


@query(with_views("v_chunks", "v_done") + f", {_MISSING} SELECT c.station, c.chunks, CAST(count(*) FILTER (product = 'scores6s') AS BIGINT) AS missing_scores6s, CAST(count(*) FILTER (product = 'range') AS BIGINT) AS missing_range, CAST(count(*) FILTER (product = 'cut6') AS BIGINT) AS missing_cut6, CAST(count(*) FILTER (product = 'cut10') AS BIGINT) AS missing_cut10 FROM (SELECT station, count(*) AS chunks FROM v_chunks GROUP BY station) c LEFT JOIN missing USING (station) GROUP BY ALL")
def work_matrix(spark, d):
    return inventory.work_matrix(V.chunks(spark, d), V.done(spark, d), V.PRODUCTS).drop("decode", "naive")


@query(with_views("v_chunks", "v_done") + f", {_MISSING}, m AS (SELECT station, count(DISTINCT chunk) AS part, count(*) FILTER (product = 'range') AS r FROM missing GROUP BY station) SELECT c.station, CAST(CASE WHEN coalesce(r, 0) > 0 THEN chunks ELSE coalesce(part, 0) END AS BIGINT) AS decode, CAST(chunks * (3 + CASE WHEN coalesce(r, 0) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS naive FROM (SELECT station, count(*) AS chunks FROM v_chunks GROUP BY station) c LEFT JOIN m USING (station)")
def decode_union(spark, d):
    return inventory.work_matrix(V.chunks(spark, d), V.done(spark, d), V.PRODUCTS).select("station", "decode", "naive")


@query(with_views("v_chunks", "v_done") + f", {_MISSING} SELECT station, chunk, product FROM missing")
def outstanding(spark, d):
    return inventory.outstanding(V.chunks(spark, d), V.done(spark, d), V.PRODUCTS)


@query(with_views("v_catalog", "v_snr") + "SELECT trunc(least(mag, 6) * 2) / 2.0 AS band, count(*) AS kept FROM v_catalog WHERE event_id IN (SELECT event_id FROM v_snr) GROUP BY ALL")
def kept_by_band(spark, d):
    """The catalogue's events that any reading is of, as if each reading were a window cut."""
    from waveline.operators import windows

    return windows.kept_by_band(V.snr(spark, d).select("event_id"), V.catalog(spark, d), [])


@query(with_views("v_scores", "v_catalog", "v_stations", "v_snr") + f", {_ARRIVALS} SELECT a.station, a.event_id, round(s.snr, 6) AS snr FROM arrivals a LEFT JOIN (SELECT event_id, max(snr) AS snr FROM v_snr GROUP BY event_id) s USING (event_id)")
def catalog_with_snr(spark, d):
    """The left join of the catalogue on its readings: one row of an event, unmeasured ones too."""
    known = _arrivals(spark, d).select("station", "event_id")
    return r6(snr.with_readings(known, snr.largest(V.snr(spark, d))).select("station", "event_id", "snr"), "snr")


@query(with_views("v_chunks") + "SELECT station, chunk FROM (SELECT *, row_number() OVER (PARTITION BY station ORDER BY chunk) AS k FROM v_chunks) WHERE k <= 3")
def limit_chunks(spark, d):
    return inventory.limit_chunks(V.chunks(spark, d), 3).select("station", "chunk")


# --- without SQL: samples, filters, networks, archives, streams ---------------------------------


@query(with_views("v_recorded") + """, t AS (SELECT *, t0 + 1 AS fin, row_number() OVER (ORDER BY vec_id) AS id FROM v_recorded),
-- Traces of one length: an equal start is the only containment.
heads AS (SELECT DISTINCT station, channel, t0, fin FROM t),
cut AS (SELECT *, CASE WHEN t0 - max(fin) OVER (PARTITION BY station, channel ORDER BY t0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 0.5 / 64 THEN 0 ELSE 1 END AS c FROM heads),
runs AS (SELECT *, sum(c) OVER (PARTITION BY station, channel ORDER BY t0) AS run FROM cut),
segs AS (SELECT station, channel, run, min(t0) AS start, max(fin) AS fin FROM runs GROUP BY ALL)
SELECT station, channel, right(channel, 1) AS role, start AS t0, CAST(round_even((fin - start) * 64, 0) AS BIGINT) AS n FROM segs""")
def join_traces(spark, d):
    """The segments' extents; their samples are ``painted_samples``."""
    traces = V.recorded(spark, d)
    segs = segments.join_traces(traces, 64.0)
    return blocks.heads(segs).select("station", "channel", "role", "t0", "n")


@query(with_views("v_recorded") + """, one AS (SELECT * FROM v_recorded QUALIFY row_number() OVER (PARTITION BY station, channel, t0 ORDER BY vec_id) = 1),
heads AS (SELECT *, CASE WHEN t0 - max(t0 + 1) OVER (PARTITION BY station, channel ORDER BY t0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 0.5 / 64 THEN 0 ELSE 1 END AS c FROM one),
runs AS (SELECT *, sum(c) OVER (PARTITION BY station, channel ORDER BY t0) AS run FROM heads),
placed AS (SELECT *, min(t0) OVER (PARTITION BY station, channel, run) AS start FROM runs),
every AS (SELECT station, channel, start, t0, CAST(round_even((t0 - start) * 64, 0) AS BIGINT) + unnest(range(64)) AS i, unnest(x) AS v FROM placed),
painted AS (SELECT station, channel, start, i, max_by(v, t0) AS v FROM every GROUP BY ALL)
SELECT station, channel, start AS t0, count(*) AS n, round(sum(v), 6) AS total, round(sum(v * (i % 17)), 5) AS weighted FROM painted GROUP BY station, channel, start""")
def painted_samples(spark, d):
    """Where traces overlap the later one's samples count; of those that start together the first in order."""
    segs = blocks.values(segments.join_traces(V.recorded(spark, d), 64.0), "data")
    offset = F.col("block").cast("long") * blocks.BLOCK
    weighted = arrays.total(F.transform("data", lambda v, i: v * ((i + offset) % 17)))
    each = segs.select("station", "channel", "t0", "n", arrays.total("data").alias("total"), weighted.alias("weighted"))
    return r6(each.groupBy("station", "channel", "t0", "n").agg(F.sum("total").alias("total"), rounded(F.sum("weighted"), 5).alias("weighted")), "total")


#: The band-pass of 0.2 to 1.5 Hz at 4 Hz (order 4), numerator and denominator, and
#: the filter's state after endless ones; worked out once from the filter's definition.
BAND_B = (0.21617864129329248, 0.0, -0.8647145651731699, 0.0, 1.297071847759755, 0.0, -0.8647145651731699, 0.0, 0.21617864129329248)
BAND_A = (1.0, -1.2621160475974185, -0.4963692347419646, 0.5682004127103971, 0.7945635395680457, -0.40531126513094773, -0.25445633966006, 0.05351212738169589, 0.04766255662918978)
BAND_Z = (-0.2161786412932912, -0.21617864129329273, 0.6485359238798766, 0.6485359238798774, -0.6485359238798767, -0.6485359238798772, 0.21617864129329237, 0.21617864129329242)


def _filter_sql(source: str, out: str) -> str:
    """One pass of the filter along ``(window_id, i, v)``, i from 1 on, as a recursive query."""
    y = f"{BAND_B[0]!r} * s.v + z1"
    z = [f"{BAND_B[k]!r} * s.v + {f'z{k + 1}' if k < 8 else '0'} - ({BAND_A[k]!r}) * ({y})" for k in range(1, 9)]
    start = [f"{BAND_Z[k]!r} * v AS z{k + 1}" for k in range(8)]
    return f"""{out}_r AS (SELECT window_id, CAST(0 AS BIGINT) AS i, CAST(0 AS DOUBLE) AS y, {', '.join(start)} FROM {source} WHERE i = 1
  UNION ALL SELECT r.window_id, r.i + 1, {y}, {', '.join(z)} FROM {out}_r r JOIN {source} s ON s.window_id = r.window_id AND s.i = r.i + 1),
{out} AS (SELECT window_id, i, y FROM {out}_r WHERE i > 0)"""


#: Windows of 64 samples at 4 Hz: line off, mean off, taper on, band-passed forward and backward.
_CONDITIONED = """WITH RECURSIVE """ + ", ".join(f"{n} AS ({V.SQL[n]})" for n in ("v_windows",)) + f""",
e AS (SELECT window_id, unnest(x) AS v, unnest(range(64)) AS i FROM v_windows),
fit AS (SELECT window_id, regr_slope(v, i) AS m, regr_intercept(v, i) AS c FROM e GROUP BY window_id),
flat AS (SELECT window_id, i, (v - m * i - c) * CASE WHEN i < 3 THEN 0.5 - 0.5 * cos(2 * pi() * i / 5) WHEN i > 60 THEN 0.5 - 0.5 * cos(2 * pi() * (63 - i) / 5) ELSE 1 END AS v FROM e JOIN fit USING (window_id)),
x AS (SELECT window_id, list(v ORDER BY i) AS x FROM flat GROUP BY window_id),
wide AS (SELECT window_id, unnest(range(1, 119)) AS i, unnest(list_transform(range(27), lambda k: 2 * x[1] - x[28 - k]) || x || list_transform(range(27), lambda k: 2 * x[64] - x[63 - k])) AS v FROM x),
{_filter_sql('wide', 'ahead')},
turned AS (SELECT window_id, 119 - i AS i, y AS v FROM ahead),
{_filter_sql('turned', 'back')},
clean AS (SELECT window_id, 118 - i - 27 AS i, y FROM back WHERE 118 - i - 27 BETWEEN 0 AND 63)"""


def _windows_as_segments(spark, d) -> DataFrame:
    rows = V.windows(spark, d).select("station", F.lit("c").alias("chunk"), F.lit("Z").alias("role"), F.col("window_id").alias("seg_id"), F.lit(0.0).alias("t0"), F.size("x").cast("long").alias("n"), F.col("x").alias("data"))
    return blocks.pack(rows)


@query(_CONDITIONED + " SELECT window_id, CAST(i AS INT) AS i, round(y, 6) + 0.0 AS y FROM clean")
def conditioned_windows(spark, d):
    """Every vector as a window: detrended, tapered and band-passed, as scoring and baselines do."""
    import numpy as np
    import pyarrow as pa

    from waveline.operators.signal import clean_block

    def work(batches):
        for batch in batches:
            block = np.array(batch.column(1).to_pylist(), np.float64).reshape(-1, 64)
            clean = clean_block(block, 4.0, 0.2, 1.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(clean), pa.list_(pa.float64()))], ["window_id", "y"])

    rows = V.windows(spark, d).select("window_id", "x").mapInArrow(work, "window_id bigint, y array<double>")
    return rows.select("window_id", F.posexplode("y").alias("i", "y")).withColumn("y", rounded("y", 6) + 0.0)


@query(_CONDITIONED + """, pieces AS (SELECT station, sum(y) AS s, sum(y * y) AS ss, count(*) AS n FROM clean JOIN v_windows USING (window_id) GROUP BY station, window_id),
sd AS (SELECT *, sqrt(greatest(ss / n - pow(s / n, 2), 0)) AS sd FROM pieces), lim AS (SELECT station, quantile_cont(sd, 0.9) AS lim FROM sd GROUP BY station),
quiet AS (SELECT station, sqrt(greatest(sum(ss) / sum(n) - pow(sum(s) / sum(n), 2), 0)) AS sigma_trimmed FROM sd JOIN lim USING (station) WHERE sd <= lim GROUP BY station)
SELECT station, round(sum(s) / sum(n), 6) + 0.0 AS mu, round(sqrt(greatest(sum(ss) / sum(n) - pow(sum(s) / sum(n), 2), 0)), 6) AS sigma, round(any_value(sigma_trimmed), 6) AS sigma_trimmed, round(median(sd), 6) AS sigma_median, CAST(sum(n) AS BIGINT) AS n_samples, count(*) AS n_pieces FROM sd JOIN quiet USING (station) GROUP BY station""")
def baseline_conditioned(spark, d):
    pieces = baseline.piece_moments(_windows_as_segments(spark, d), 4.0, 0.2, 1.5, 16.0)
    out = baseline.noise_statistics(pieces).select("station", "mu", "sigma", "sigma_trimmed", "sigma_median", "n_samples", "n_pieces")
    return r6(out, "mu", "sigma", "sigma_trimmed", "sigma_median").withColumn("mu", F.col("mu") + 0.0)


def _mean_absolute(block):
    """A scorer that another engine can repeat: the mean of absolute samples, at most one."""
    import numpy as np

    return np.minimum(np.abs(block.astype(np.float64)).mean(axis=(1, 2)), 1.0)


@query(_CONDITIONED + """, scaled AS (SELECT window_id, avg(abs(y / 0.5)) AS p FROM clean GROUP BY window_id)
SELECT 'L' || label AS station, 'v' || vec_id AS chunk, '16s' AS arm, CAST(0 AS DOUBLE) AS t, round(least(p, 1), 3) AS p FROM scaled JOIN embeddings ON vec_id = window_id""")
def score_windows(spark, d):
    """Every vector as a record of three equal components, scored window by window by a stub."""
    from waveline.operators import score

    rows = V.windows(spark, d).select("station", F.concat(F.lit("v"), F.col("window_id")).alias("chunk"), F.explode(F.array(*map(F.lit, "ZNE"))).alias("role"), F.lit(0).alias("seg_id"), F.lit(0.0).alias("t0"), F.lit(64).cast("long").alias("n"), F.col("x").alias("data"))
    arm = names.Arm("16s", 16.0, "", "", 16.0, 4.0)
    out = score.score(blocks.pack(rows), arm, _mean_absolute, "constant", low=0.2, high=1.5, constant=0.5)
    return out.withColumn("p", rounded(F.col("p").cast("double"), 3))


#: A small network of the engine's kind for a check by SQL: untrained weights, fixed by their seeds.
WIDTH, HIDDEN = 4, 4


def _networks(branch: str) -> list[dict]:
    """Two of a branch. What it finds in noise is taken off and the rest enlarged, so that windows
    get scores of their own: plain random weights score all alike."""
    import numpy as np

    from waveline.operators import detector

    noise = np.random.default_rng(0).normal(size=(200, 64, 1)) * [1.0, -1.0, 2.0]
    out = []
    for seed in (1, 2):
        w = {k: v if k.endswith("running_var") else v * 6 for k, v in detector.random_weights(branch, seed, HIDDEN, WIDTH).items()}
        found = detector.features(w, np.arcsinh(noise / noise.std(1, keepdims=True)), branch)
        w |= {"p1.weight": w["p1.weight"] / found.std(0), "w1": np.float64(1.0)}
        out.append(w | {"p1.bias": -w["p1.weight"] @ found.mean(0), "head.5.weight": w["head.5.weight"] * 2})
    return out


def _values(array) -> str:
    """An array's elements with their places, as rows of SQL."""
    import numpy as np

    return ", ".join("(" + ", ".join([*map(str, at), f"{float(v)!r}::DOUBLE"]) + ")" for at, v in np.ndenumerate(array))


def _gelu_sql(x: str) -> str:
    """By the error function's Taylor series, cut off where it is one: 60 terms hold for |x| up to 5."""
    z = f"(greatest(-5.0, least(5.0, ({x}) / sqrt(2.0))))"
    terms = f"list_sum(list_transform(range(60), lambda n: (1 - 2 * (n % 2)) * exp((2 * n + 1) * ln(greatest(abs{z}, 1e-9)) - lgamma(n + 1.0)) / (2 * n + 1)))"
    return f"(0.5 * ({x}) * (1 + sign{z} * 2 / sqrt(pi()) * {terms}))"


def _list(array) -> str:
    """An array as nested lists of SQL."""
    return "[" + ", ".join(_list(row) if row.ndim else f"{float(row)!r}::DOUBLE" for row in array) + "]"


def _affine_sql(weight, bias, x: str) -> str:
    """A matrix and a bias applied to a list."""
    return f"list_transform(range(1, {len(bias) + 1}), lambda j: {_list(bias)}[j] + list_dot_product({_list(weight)}[j], {x}))"


def _recurrent_sql(w: dict, source: str, length: int, out: str) -> str:
    """The two recurrences as a query each that repeats itself, step by step; then attention as a join of a window's steps with all its steps, a row of means at the end."""
    from waveline.operators.detector import EPS, HEADS

    each, sigmoid = f"range(1, {HIDDEN + 1})", lambda x: f"(1 / (1 + exp(-{x})))"
    parts = [f"{out}_x AS MATERIALIZED (SELECT window_id, t, list(v ORDER BY c) AS x FROM {source} GROUP BY window_id, t)"]
    for tail, name, place in (("", "ahead", "n"), ("_reverse", "back", f"{length - 1} - n")):
        w_ih, w_hh, bias = w[f"b1.lstm.weight_ih_l0{tail}"], w[f"b1.lstm.weight_hh_l0{tail}"], w[f"b1.lstm.bias_ih_l0{tail}"] + w[f"b1.lstm.bias_hh_l0{tail}"]
        gate = lambda k: f"g[{k * HIDDEN} + k]"
        parts.append(f"{out}_{name}_in AS MATERIALIZED (SELECT window_id, t, {_affine_sql(w_ih, bias, 'x')} AS given FROM {out}_x)")
        parts.append(f"""{out}_{name} AS (SELECT DISTINCT window_id, -1::BIGINT AS n, {_list(bias[:HIDDEN] * 0)} AS h, {_list(bias[:HIDDEN] * 0)} AS cell FROM {out}_x
  UNION ALL SELECT window_id, n, list_transform({each}, lambda k: {sigmoid(gate(3))} * tanh(cell[k])), cell FROM (
    SELECT window_id, n, g, list_transform({each}, lambda k: {sigmoid(gate(1))} * cell[k] + {sigmoid(gate(0))} * tanh({gate(2)})) AS cell FROM (
      SELECT window_id, n + 1 AS n, cell, list_transform(range(1, {4 * HIDDEN + 1}), lambda j: given[j] + list_dot_product({_list(w_hh)}[j], h)) AS g
      FROM {out}_{name} r JOIN (SELECT window_id AS of, {place.replace('n', 't')} AS step, given FROM {out}_{name}_in) ON of = window_id AND step = n + 1)))""")
    d, size = 2 * HIDDEN, 2 * HIDDEN // HEADS
    dot = " + ".join(f"a.y[{size} * head + {k}] * b.y[{d} + {size} * head + {k}]" for k in range(1, size + 1))
    means = ", ".join(f"sum(e * v{k}) / sum(e)" for k in range(1, size + 1))
    values = ", ".join(f"b.y[{2 * d} + {size} * head + {k}] AS v{k}" for k in range(1, size + 1))
    parts.append(f"{out}_both AS MATERIALIZED (SELECT window_id, a.n AS t, a.h || b.h AS x FROM {out}_ahead a JOIN {out}_back b USING (window_id) WHERE a.n >= 0 AND b.n = {length - 1} - a.n)")
    parts.append(f"{out}_qkv AS MATERIALIZED (SELECT window_id, t, {_affine_sql(w['b1.attn.in_proj_weight'], w['b1.attn.in_proj_bias'], 'x')} AS y FROM {out}_both)")
    parts.append(f"{out}_seen AS (SELECT window_id, t, head, [{means}] AS o FROM (SELECT window_id, a.t, head, exp(({dot}) / sqrt({size}.0)) AS e, {values} FROM {out}_qkv a JOIN {out}_qkv b USING (window_id), (SELECT unnest(range({HEADS})) AS head)) GROUP BY window_id, t, head)")
    parts.append(f"{out}_mixed AS (SELECT window_id, t, {_affine_sql(w['b1.attn.out_proj.weight'], w['b1.attn.out_proj.bias'], 'o')} AS o FROM (SELECT window_id, t, flatten(list(o ORDER BY head)) AS o FROM {out}_seen GROUP BY window_id, t))")
    parts.append(f"{out}_sum AS (SELECT window_id, t, list_transform(range(1, {d + 1}), lambda k: x[k] + o[k]) AS x FROM {out}_both JOIN {out}_mixed USING (window_id, t))")
    parts.append(f"{out}_level AS (SELECT window_id, t, list_transform(range(1, {d + 1}), lambda k: (x[k] - list_avg(x)) / sqrt(list_var_pop(x) + {EPS}) * {_list(w['b1.norm.weight'])}[k] + {_list(w['b1.norm.bias'])}[k]) AS x FROM {out}_sum)")
    parts.append(f"{out}_a AS (SELECT window_id, t, unnest(range({d})) AS c, unnest(x) AS v FROM {out}_level)")
    return ", ".join(parts)


def _network_sql(w: dict, out: str, branch: str) -> str:
    """A network's layers over ``h0`` (window_id, t, c, v), from its first to a probability."""
    from waveline.operators.detector import EPS

    parts, at, length = [], "h0", 64
    for k, place in enumerate(("0", "1", "3") if branch != "lstm" else ()):
        kernel, p = w[f"b1.conv.{place}.0.weight"], f"b1.conv.{place}.1."
        norm = [(w[p + "weight"][o] / (w[p + "running_var"][o] + EPS) ** 0.5, w[p + "bias"][o] - w[p + "running_mean"][o] * w[p + "weight"][o] / (w[p + "running_var"][o] + EPS) ** 0.5) for o in range(len(kernel))]
        length = (length + 1) // 2
        scale = ", ".join(f"({o}, {float(m)!r}::DOUBLE, {float(c)!r}::DOUBLE)" for o, (m, c) in enumerate(norm))
        half = kernel.shape[-1] // 2
        parts.append(f"{out}_c{k} AS (SELECT window_id, tt AS t, o AS c, sum(w * v) AS v FROM {at} h JOIN (VALUES {_values(kernel)}) AS x(o, ci, k, w) ON h.c = ci JOIN (SELECT unnest(range({length})) AS tt) ON h.t = 2 * tt + k - {half} GROUP BY ALL)")
        parts.append(f"{out}_g{k} AS (SELECT window_id, t, c, {_gelu_sql('v * m + b')} AS v FROM {out}_c{k} JOIN (VALUES {scale}) AS n(c, m, b) USING (c))")
        at = f"{out}_g{k}"
    if branch != "cnn":
        parts.append(_recurrent_sql(w, at, length, out))
        at = f"{out}_a"
    line = lambda name, source, weight, bias: f"{name} AS (SELECT window_id, o AS c, sum(w * v) + any_value(b) AS v FROM {source} JOIN (VALUES {_values(weight)}) AS x(o, c, w) USING (c) JOIN (VALUES {_values(bias)}) AS y(o, b) USING (o) GROUP BY window_id, o)"
    parts.append(f"{out}_m AS (SELECT window_id, c, avg(v) AS v FROM {at} GROUP BY window_id, c)")
    parts.append(line(f"{out}_p", f"{out}_m", w["p1.weight"] * w["w1"], w["p1.bias"] * w["w1"]))
    gain = ", ".join(f"({c}, {float(g)!r}::DOUBLE, {float(b)!r}::DOUBLE)" for c, (g, b) in enumerate(zip(w["head.0.weight"], w["head.0.bias"], strict=True)))
    parts.append(f"{out}_n AS (SELECT window_id, c, (v - avg(v) OVER (PARTITION BY window_id)) / sqrt(var_pop(v) OVER (PARTITION BY window_id) + {EPS}) * g + b AS v FROM {out}_p JOIN (VALUES {gain}) AS n(c, g, b) USING (c))")
    parts.append(line(f"{out}_q", f"{out}_n", w["head.2.weight"], w["head.2.bias"]))
    parts.append(f"{out}_r AS (SELECT window_id, c, {_gelu_sql('v')} AS v FROM {out}_q)")
    parts.append(line(f"{out}_s", f"{out}_r", w["head.5.weight"], w["head.5.bias"]))
    parts.append(f"{out} AS (SELECT window_id, 1 / (1 + exp(-v)) AS p FROM {out}_s)")
    return ", ".join(parts)


def _detector_sql(branch: str) -> str:
    nets = "".join(f", {_network_sql(w, f'net{k}', branch)}" for k, w in enumerate(_networks(branch)))
    return f"""{_CONDITIONED}, unit AS (SELECT window_id, i AS t, asinh((y - avg(y) OVER (PARTITION BY window_id)) / greatest(stddev_pop(y) OVER (PARTITION BY window_id), 1e-12)) AS v FROM clean),
h0 AS (SELECT window_id, t, c, v * f AS v FROM unit, (VALUES (0, 1), (1, -1), (2, 1)) AS x(c, f)){nets}
SELECT 'L' || label AS station, 'v' || vec_id AS chunk, round((a.p + b.p) / 2, 3) AS p FROM net0 a JOIN net1 b USING (window_id) JOIN embeddings ON vec_id = window_id"""


def _detected(spark, d, branch: str) -> DataFrame:
    """Every vector as a record of three components (the second reversed in sign, the third twice as large), by an ensemble of two small networks."""
    from waveline.operators import detector, score

    sides = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.lit(f).alias("f")) for r, f in (("Z", 1.0), ("N", -1.0), ("E", 2.0))])).alias("y")
    rows = V.windows(spark, d).select("station", F.concat(F.lit("v"), F.col("window_id")).alias("chunk"), "x", sides)
    rows = rows.select("station", "chunk", "y.role", F.lit(0).alias("seg_id"), F.lit(0.0).alias("t0"), F.lit(64).cast("long").alias("n"), F.transform("x", lambda v: v * F.col("y.f")).alias("data"))
    out = score.score(blocks.pack(rows), names.Arm("16s", 16.0, "", branch, 16.0, 4.0), detector.ensemble(_networks(branch), branch), "perwindow", low=0.2, high=1.5)
    return out.select("station", "chunk", rounded(F.col("p").cast("double"), 3).alias("p"))


@query(_detector_sql("cnn"))
def score_by_detector(spark, d):
    """Convolutions alone."""
    return _detected(spark, d, "cnn")


@query(_detector_sql("lstm"))
def score_by_recurrence(spark, d):
    """The recurrence over a window's samples, and attention."""
    return _detected(spark, d, "lstm")


@query(_detector_sql("cnn-lstm"))
def score_by_attention(spark, d):
    """Convolutions, then the recurrence over what they make, and attention."""
    return _detected(spark, d, "cnn-lstm")


@query(with_views("v_recorded") + "SELECT station, channel, t0, CAST(64 AS BIGINT) AS samples, CAST(list_sum(list_transform(x, lambda v: trunc(v * 1000))) AS BIGINT) AS total, true AS equal FROM v_recorded")
def mseed_round_trip(spark, d):
    """Every trace packed as a chunk file of compressed records, and decoded as the archive's files are."""
    import io
    import zipfile

    import numpy as np
    import pyarrow as pa

    from waveline.sources import archive, mseed

    def packed(batches):
        for batch in batches:
            out = []
            for station, channel, t0, data in zip(*(batch.column(c).to_pylist() for c in ("station", "channel", "t0", "data")), strict=True):
                file = io.BytesIO()
                with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr("data.mseed", mseed.write_traces([mseed.Trace(station[:5], channel, t0, 64.0, np.trunc(np.frombuffer(data) * 1000))], power=9))
                out.append(file.getvalue())
            yield pa.RecordBatch.from_arrays([batch.column("station"), batch.column("chunk"), pa.array(out, pa.binary())], ["station", "chunk", "content"])

    traces = V.recorded(spark, d).withColumn("chunk", F.concat(F.lit("v"), F.col("seq")))
    back = archive.decode(traces.select("station", "chunk", "channel", "t0", "data").mapInArrow(packed, "station string, chunk string, content binary"))
    back = blocks.values(back.select("station", "chunk", "channel", "t0", "n", "data"), "data")
    whole = blocks.values(traces.select("chunk", F.col("data").alias("given")), "given")
    equal = F.col("data") == F.transform("given", lambda v: F.signum(v) * F.floor(F.abs(v * 1000)) + 0.0)
    rows = back.join(whole, "chunk").groupBy("station", "chunk", "channel", "t0").agg(F.sum("n").alias("samples"), F.sum(arrays.total("data")).cast("bigint").alias("total"), F.every(equal).alias("equal"))
    return rows.drop("chunk")


@query(with_views("v_scores") + f", {_declared(0.99, 'dec')} SELECT station, round(t, 6) AS t, round(p, 6) AS p FROM dec")
def session_declarations(spark, d):
    """The streaming form of declarations, on a bounded input."""
    from waveline.streaming.declarations import streaming_declarations

    return r6(streaming_declarations(V.scores(spark, d), 0.99, STEP), "t", "p")
