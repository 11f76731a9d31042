"""A training corpus from ``documents``: each stage is one corpus operator over all its predecessor kept.

Every stage but the last returns the columns of its input. Stages read what the one before
wrote: ``run`` keeps each result as Parquet in the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from waveline.llm import decontaminate, langid, mixing, simhash, substring
from waveline.llm.common import checkpoint_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, or null or empty, are no language (``und``) and go.

    All others stay, whatever their length, language or score. Null ids, languages and sources
    and repeated rows stay by their texts; an empty table gives none; all columns stay.
    """
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents at a Jaccard similarity of 0.8 or more, by shingles of five
    words, the one with the smallest id stays.

    A text of fewer words is one shingle; null and wordless texts are copies of each other. Rows
    that repeat the id that stays all stay; a null id links others and is never dropped. An
    empty table gives none; all columns stay.
    """
    return simhash.keep_one(docs, shingle=5, similarity=0.8)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 50-word windows that a smaller id has too are cut out; emptied texts go.

    Null, empty and short texts stay as they are; rows with one id don't clean each other, and a
    null id is neither compared nor cut. An empty table gives none; all columns stay.
    """
    return substring.drop_repeats(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which a benchmark item leaks go.

    Null and empty texts stay, as do all rows without items; null and repeated ids are judged by
    their own texts. An empty table gives none; all columns stay.
    """
    return decontaminate.drop_leaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled by probabilities raked to source, language and topic targets.

    Null sources and languages are a value of their own; a null text has no tokens; rows with
    one id, null ones too, come or go together if they are of one cell. An empty table gives
    none; all columns stay.
    """
    return mixing.sample(docs)


STAGES = [
    ("language", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", cut_repeats),
    ("benchmark leaks", drop_benchmark_leaks),
    ("mixing", mix_sources),
]

#: Language identification has no SQL form; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
    return docs
