"""File streams that pick up where they stopped: ledgers being appended to, chunks arriving."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waveline.schemas import LEDGER
from waveline.sources.tables import parse_ledger_lines


def ledger_stream(spark: SparkSession, folder: str) -> DataFrame:
    """``(station, state, lo, hi)`` of the ledger files that appear in a folder; torn lines are passed over."""
    return parse_ledger_lines(spark.readStream.text(folder).withColumnRenamed("value", "line"))


def drain(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> None:
    """Hand every new file to ``handle`` once, then stop; the next call goes on from there."""
    q = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def score_stream(spark: SparkSession, folder: str, schema: str = "station string, t double, p float", files_per_batch: int = 100) -> DataFrame:
    """Scored windows as their Parquet files arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


__all__ = ["LEDGER", "drain", "ledger_stream", "score_stream"]
