"""Station, catalogue, ledger, score, baseline and signal-to-noise tables."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waveline.functions.geo import haversine_km
from waveline.operators.intervals import coalesce_intervals
from waveline.schemas import CATALOG, LEDGER
from waveline.sources.store import exists

FETCHED, PENDING, UNKNOWN = ("fetched",), ("pending", "claimed", "submitted"), "?"


def read_csv(spark: SparkSession, path: str, line_breaks: bool = False) -> DataFrame:
    """All columns as text, names without blanks and byte-order mark.

    Files are split between tasks, unless fields may hold line breaks inside their quotes.
    """
    df = spark.read.option("header", "true").option("multiLine", str(line_breaks).lower()).option("escape", '"').csv(path)
    return df.toDF(*[c.replace("\ufeff", "").strip() for c in df.columns])


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """``(station, lat, lon)``; blank codes go, of a code listed twice the last row counts."""
    rows = read_csv(spark, path).select(F.trim("Code").alias("station"), F.col("Latitude").cast("double").alias("lat"), F.col("Longitude").cast("double").alias("lon"))
    rows = rows.where("station is not null and station <> ''").withColumn("_i", F.monotonically_increasing_id())
    return rows.groupBy("station").agg(F.max_by("lat", "_i").alias("lat"), F.max_by("lon", "_i").alias("lon"))


def station_coords(spark: SparkSession, path: str, station: str) -> tuple[float, float]:
    """One station's coordinates, by its first row; an error names a station that isn't there."""
    row = read_csv(spark, path).where(F.col("Code") == station).select(F.col("Latitude").cast("double"), F.col("Longitude").cast("double")).head()
    if row is None:
        raise KeyError(f"{station} is not in {path}")
    return row[0], row[1]


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The catalogue as ``(event_id, time, t, lat, lon, depth, mag, location)``; rows without a valid date go.

    Numbers that aren't numbers are null, not NaN.
    """
    raw = read_csv(spark, path)
    number = lambda c: F.expr(f"nullif(try_cast({c} as double), double('NaN'))")
    time = F.try_to_timestamp(F.trim("Date"), F.lit("d/M/yyyy H:m:s"))
    rows = raw.select(F.expr("try_cast(EventID as bigint)").alias("event_id"), time.alias("time"), number("Latitude").alias("lat"), number("Longitude").alias("lon"), number("Depth").alias("depth"), number("Magnitude").alias("mag"), "Location")
    return rows.where("time is not null").select("event_id", "time", (F.unix_micros("time") / 1e6).alias("t"), "lat", "lon", "depth", "mag", F.col("Location").alias("location"))


def load_catalog(events: DataFrame, lat: float, lon: float, max_distance: float = 500.0, min_magnitude: float = 0.0) -> DataFrame:
    """Events in reach of one place and at least a magnitude, with ``dist``; no magnitude is not enough."""
    return events.withColumn("dist", haversine_km(F.lit(lat), F.lit(lon), "lat", "lon")).where((F.col("dist") <= max_distance) & (F.col("mag") >= min_magnitude))


def read_ledgers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(station, state, lo, hi, source)`` of every whole ledger line; missing files, torn and blank lines are passed over.

    A row without a state is in state ``?``; the source is the file's stem less ``_ledger``.
    """
    there = [p for p in paths if exists(spark, p)]
    schema = "station string, state string, lo double, hi double, source string"
    if not there:
        return spark.createDataFrame([], schema)
    raw = spark.read.schema(LEDGER).option("mode", "DROPMALFORMED").json(there)
    stem = F.regexp_replace(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1), "_ledger", "")
    epoch = lambda c: F.unix_micros(F.try_to_timestamp(c)) / 1e6
    rows = raw.select("station", F.coalesce("state", F.lit(UNKNOWN)).alias("state"), epoch(F.col("start")).alias("lo"), epoch(F.col("end")).alias("hi"), stem.alias("source"))
    return rows.where("station is not null and station <> ''")


def parse_ledger_lines(lines: DataFrame, column: str = "line") -> DataFrame:
    """The same rows from a column of JSON lines, such as a stream's."""
    row = F.from_json(column, LEDGER)
    epoch = lambda c: F.unix_micros(F.try_to_timestamp(c)) / 1e6
    rows = lines.select(row.alias("r")).select("r.station", F.coalesce("r.state", F.lit(UNKNOWN)).alias("state"), epoch(F.col("r.start")).alias("lo"), epoch(F.col("r.end")).alias("hi"))
    return rows.where("station is not null and station <> ''")


def spans_in_state(ledger: DataFrame, states: tuple[str, ...]) -> DataFrame:
    """``(station, lo, hi)``: disjoint spans of the rows in any of the states."""
    return coalesce_intervals(ledger.where(F.col("state").isin(*states) & F.col("lo").isNotNull()), ["station"])


def read_scores(spark: SparkSession, path: str, station: str, arm: str) -> DataFrame:
    """One station's score series of one arm, by time; none at all is an error that names it."""
    rows = spark.read.parquet(path).where((F.col("station") == station) & (F.col("arm") == arm)).select("t", "p")
    if not rows.head(1):
        raise FileNotFoundError(f"no scores of {station}, {arm} in {path}")
    return rows.orderBy("t")


def read_snr(spark: SparkSession, path: str) -> DataFrame:
    """``(event_id, snr)`` of a table in CSV, the larger reading of an event; no number is null."""
    from waveline.operators.snr import largest

    rows = read_csv(spark, path).select(F.expr("try_cast(event_id as bigint)").alias("event_id"), F.expr("nullif(try_cast(snr as double), double('NaN'))").alias("snr"))
    return largest(rows)


def read_baseline(spark: SparkSession, path: str) -> tuple[DataFrame, dict | None] | None:
    """A station's baseline JSON: its rows by role, and what it was made by (None in older files); None without a file."""
    import json

    text = spark.read.text(path, wholetext=True).head() if exists(spark, path) else None
    if text is None:
        return None
    stats = json.loads(text[0])
    conditioning = stats.pop("_conditioning", None)
    rows = [(role, v.get("mu"), v.get("sigma"), v.get("sigma_trimmed"), v.get("sigma_median"), v.get("n_samples"), v.get("n_pieces")) for role, v in stats.items()]
    schema = "role string, mu double, sigma double, sigma_trimmed double, sigma_median double, n_samples bigint, n_pieces bigint"
    return spark.createDataFrame(rows, schema), conditioning


def decode_scores(files: DataFrame) -> DataFrame:
    """``(path, t, p)`` of score series in ``(path, content)`` rows of ``.npz`` files (arrays ``t`` and ``p``)."""

    def work(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.load(io.BytesIO(content))
                n = len(found["t"])
                yield pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array(found["t"].astype(np.float64)), pa.array(found["p"].astype(np.float32))], ["path", "t", "p"])

    return files.select("path", "content").mapInArrow(work, "path string, t double, p float")


def read_score_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, t, p)`` of score series in files, read by Spark."""
    if not paths:
        return spark.createDataFrame([], "path string, t double, p float")
    return decode_scores(spark.read.format("binaryFile").load(paths))


__all__ = ["CATALOG", "load_catalog", "read_baseline", "read_events", "read_ledgers", "read_scores", "read_snr", "read_stations", "spans_in_state", "station_coords"]
