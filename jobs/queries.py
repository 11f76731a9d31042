"""The jobs as registered queries: run twice over the whole tables into a new shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import alarms, levels
from waveline.durable import checkpoint_dir
from waveline.functions.numbers import rounded


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def job1_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declarations of all events' values; the second run finds no new file."""
    base, settings = _folder(spark, "alarms"), alarms.Settings.load(alarms.CONFIG)
    for _ in range(2):  # a file stream takes folders and patterns; the table may be one file
        out = alarms.run(spark, f"{sf_dir}/events.parquet*", f"{base}/out", f"{base}/checkpoint", settings)
    return out.select("station", F.date_format("day", "yyyy-MM-dd").alias("day"), rounded("t", 6).alias("t"), rounded("p", 6).alias("p"))


def job2_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against its source's baseline; the second run replaces the first's partitions."""
    base, settings = _folder(spark, "levels"), levels.Settings.load(levels.CONFIG)
    for _ in range(2):
        out = levels.run(spark, f"{sf_dir}/documents.parquet", base, settings)
    return out.select("doc_id", "source", "lang", "n_words", *[rounded(c, 6).alias(c) for c in ("mean", "deviation", "off", "ratio")], "verdict")


def _alarms_sql(s: alarms.Settings, lateness_ms: int) -> str:
    gap = round(s.cluster_seconds * 1e6)
    return f"""
WITH hits AS (
  SELECT {s.station} AS station, epoch_us({s.time}) AS us, {s.score} AS p FROM events WHERE {s.score} > {s.threshold}
), cut AS (
  SELECT *, coalesce(us - lag(us) OVER (PARTITION BY station ORDER BY us) > {gap}, true) AS new FROM hits
), bursts AS (
  SELECT station, max(us) AS last, max(p) AS p, arg_max(us, (p, -us)) AS us
  FROM (SELECT *, sum(CAST(new AS INT)) OVER (PARTITION BY station ORDER BY us) AS burst FROM cut) GROUP BY station, burst
)
-- A burst is out once the watermark, of whole milliseconds, has passed its end.
SELECT station, strftime(make_timestamp(us), '%Y-%m-%d') AS day, round(us / 1e6, 6) AS t, round(p, 6) AS p
FROM bursts WHERE last + {gap} + 1 <= ((SELECT max(us) FROM hits) // 1000 - {lateness_ms}) * 1000
"""


def _levels_sql(s: levels.Settings) -> str:
    return rf"""
WITH lengths AS (
  SELECT doc_id, coalesce(source, '{levels.NONE}') AS source, coalesce(lang, '{levels.NONE}') AS lang, list_transform(regexp_extract_all(coalesce(text, ''), '{levels.WORD}'), lambda w: length(w)) AS x FROM documents
), pieces AS (
  SELECT doc_id, source, lang, CAST(len(x) AS BIGINT) AS n, CAST(coalesce(list_sum(x), 0) AS DOUBLE) AS s, CAST(coalesce(list_sum(list_transform(x, lambda v: v * v)), 0) AS DOUBLE) AS ss FROM lengths
), sd AS (
  SELECT *, sqrt(greatest(ss / n - pow(s / n, 2), 0)) AS sd FROM pieces WHERE n > 0
), whole AS (
  SELECT source, lang, sum(s) / sum(n) AS mu, count(*) AS n_pieces, quantile_cont(sd, 0.9) AS lim FROM sd GROUP BY source, lang
), quiet AS (
  SELECT source, lang, sqrt(greatest(sum(ss) / sum(n) - pow(sum(s) / sum(n), 2), 0)) AS trimmed
  FROM sd JOIN whole USING (source, lang) WHERE CASE WHEN n_pieces > 1 THEN sd <= lim ELSE sd > 0 END GROUP BY source, lang
), read AS (
  SELECT p.*, mu, nullif(coalesce(trimmed, 0), 0) AS unit, s / nullif(n, 0) AS mean
  FROM pieces p LEFT JOIN whole USING (source, lang) LEFT JOIN quiet USING (source, lang)
), judged AS (
  SELECT *, CASE WHEN n > 0 THEN sqrt(greatest(ss / n - mean * mean, 0)) END AS deviation FROM read
), compared AS (
  SELECT *, (mean - mu) / (unit / sqrt(n)) AS off, deviation / unit AS ratio FROM judged
)
SELECT doc_id, source, lang, n AS n_words, round(mean, 6) AS mean, round(deviation, 6) AS deviation, round(off, 6) AS off, round(ratio, 6) AS ratio,
       CASE WHEN n = 0 THEN 'silent' WHEN n < {s.least_words} THEN 'short' WHEN ratio > {s.loud} THEN 'loud' WHEN abs(off) > {s.off} THEN 'off' ELSE 'normal' END AS verdict
FROM compared
"""


QUERIES = {"job1_alarms": job1_alarms, "job2_levels": job2_levels}
SQL = {"job1_alarms": _alarms_sql(alarms.Settings.load(alarms.CONFIG), 2 * 3600 * 1000), "job2_levels": _levels_sql(levels.Settings.load(levels.CONFIG))}
