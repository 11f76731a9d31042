"""Noise levels of a text archive: each source's baseline, and every document against it.

A document is a piece of record, its words' lengths are the samples. Of each source and language
the pooled and the trimmed deviation are worked out as for a station's noise; every document is
then read against them: how far its mean lies from the baseline's in standard errors, and how
its own deviation compares with the trimmed one. Documents that are silent (no word), short, loud
or off are marked, so that what is no prose (tables, keys, markup) can be looked at.

    python -m jobs.levels --source s3a://b/documents --output s3a://b/levels

Writes ``OUTPUT/baseline`` and ``OUTPUT/documents``, both partitioned by source. A run replaces the
partitions of the sources that it reads and leaves others; on the same input it gives the same.
"""

from __future__ import annotations

import argparse
import logging
import os
import tomllib
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waveline.durable import checkpoint
from waveline.operators.baseline import noise_statistics

log = logging.getLogger("jobs.levels")
CONFIG = os.path.join(os.path.dirname(os.path.abspath(__file__)), "levels.toml")
#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
NONE = "(none)"
BASELINE = "lang string, mu double, sigma double, sigma_trimmed double, sigma_median double, n_samples bigint, n_pieces bigint, loud boolean, source string"
DOCUMENTS = "doc_id bigint, lang string, n_words bigint, mean double, deviation double, off double, ratio double, verdict string, source string"


@dataclass(frozen=True)
class Settings:
    least_words: int = 5  # fewer are too short to judge
    loud: float = 2.0  # deviations over the trimmed one
    off: float = 6.0  # standard errors from the baseline's mean

    @classmethod
    def load(cls, path: str) -> Settings:
        with open(path, "rb") as f:
            given = tomllib.load(f)
        if unknown := set(given) - {x.name for x in fields(cls)}:
            raise ValueError(f"{path}: unknown settings {sorted(unknown)}")
        return cls(**given)


def pieces(documents: DataFrame) -> DataFrame:
    """``(doc_id, source, lang, s, ss, n)``: number, sum and sum of squares of the words' lengths in characters.

    Sums of whole numbers are exact in any order. A null text has no words; null sources and
    languages are ``(none)``.
    """
    lengths = F.transform(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0)), lambda w: F.length(w).cast("long"))
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("source", F.lit(NONE)).alias("source"), F.coalesce("lang", F.lit(NONE)).alias("lang"), lengths.alias("lengths"))
    add = lambda f: F.aggregate("lengths", F.lit(0).cast("long"), lambda a, v: a + f(v))
    return rows.select("doc_id", "source", "lang", add(lambda v: v).cast("double").alias("s"), add(lambda v: v * v).cast("double").alias("ss"), F.size("lengths").cast("long").alias("n"))


def readings(found: DataFrame, baseline: DataFrame, settings: Settings) -> DataFrame:
    """Each document against its source's and language's baseline, with a verdict."""
    keys = ["source", "lang"]
    # One row a source and language, and adaptive joins split sources of many documents.
    rows = found.join(baseline.select(*keys, "mu", "sigma_trimmed"), keys, "left")
    mean = F.try_divide("s", "n")
    deviation = F.when(F.col("n") > 0, F.sqrt(F.greatest(F.try_divide("ss", "n") - mean * mean, F.lit(0.0))))  # ``greatest`` passes over nulls
    unit = F.when(F.col("sigma_trimmed") > 0, F.col("sigma_trimmed"))
    rows = rows.withColumns({"mean": mean, "deviation": deviation})
    rows = rows.withColumns({"off": F.try_divide(F.col("mean") - F.col("mu"), F.try_divide(unit, F.sqrt("n"))), "ratio": F.try_divide("deviation", unit)})
    verdict = F.when(F.col("n") == 0, "silent").when(F.col("n") < settings.least_words, "short").when(F.col("ratio") > settings.loud, "loud").when(F.abs("off") > settings.off, "off").otherwise("normal")
    return rows.select("doc_id", "lang", F.col("n").alias("n_words"), "mean", "deviation", "off", "ratio", verdict.alias("verdict"), "source")


def _replace(rows: DataFrame, path: str) -> None:
    """Only the partitions that ``rows`` has are replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").parquet(path)


def run(spark: SparkSession, source: str, target: str, settings: Settings) -> DataFrame:
    """Both tables for the documents in ``source``; returns the documents' as it stands in ``target``."""
    documents = spark.read.parquet(source).select("doc_id", "text", "lang", "source")
    found = checkpoint(pieces(documents))  # a few numbers a document, read several times: texts are taken apart once
    _replace(noise_statistics(found.where("n > 0"), ["source", "lang"]), f"{target}/baseline")
    baseline = spark.read.schema(BASELINE).parquet(f"{target}/baseline")
    _replace(readings(found, baseline, settings), f"{target}/documents")
    out = spark.read.schema(DOCUMENTS).parquet(f"{target}/documents")
    of = {r.verdict: r["count"] for r in out.groupBy("verdict").count().collect()}
    log.info("read %s; %d baselines and %d documents in %s: %s", source, baseline.count(), sum(of.values()), target, of)
    return out


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="jobs.levels", description=__doc__.splitlines()[0])
    for name in ("source", "output"):
        parser.add_argument(f"--{name}", required=True, help="a path on any store that Spark reaches")
    parser.add_argument("--config", default=CONFIG, help="settings as TOML")
    given = parser.parse_args(args)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    from waveline.session import session

    spark = session("levels")
    try:
        run(spark, given.source, given.output, Settings.load(given.config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
