"""Helpers shared by the corpus operators: durable scratch data and broadcast size checks."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of at most this many bytes is broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 16 << 20

#: A word is a run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows and bytes of text that go to Python at once, at most; the session's own limits count if they are lower.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def _bytes_of(said: str) -> int:
    """Bytes of a size as Spark's settings give it (``64m``, ``67108864b``)."""
    m = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)b?\s*", said.lower())
    return int(m[1]) << 10 * " kmgtp".index(m[2] or " ") if m else 0


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, its session sending no more than ``BATCH_ROWS`` rows or ``BATCH_BYTES`` bytes to Python at once.

    A batch is held in the JVM, in Arrow and in Python at the same time, for every task of an
    executor, so batches of whole texts must be small; a row beyond the bytes goes alone. The
    settings are only lowered, and stay lowered, since results are lazy.
    """
    conf, prefix = df.sparkSession.conf, "spark.sql.execution.arrow."
    if not 0 < int(conf.get(f"{prefix}maxRecordsPerBatch", "10000")) <= BATCH_ROWS:
        conf.set(f"{prefix}maxRecordsPerBatch", str(BATCH_ROWS))
    if not 0 < _bytes_of(conf.get(f"{prefix}maxBytesPerBatch", "64m")) <= BATCH_BYTES:
        conf.set(f"{prefix}maxBytesPerBatch", f"{BATCH_BYTES}b")
    return df


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the cluster's; a temporary one only where Spark runs in this process."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="waveline-checkpoint-"))
    return context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the shared folder, its lineage cut."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back (columns prune)."""
    path = f"{checkpoint_dir(df.sparkSession)}/{re.sub('[^a-z0-9]+', '-', name)}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """``df`` stored as ``stored`` does, in buckets of ``key``: grouping it by that moves nothing.

    There are as many buckets as a shuffle has partitions. The table's name is dropped at once; its
    files stay, as those of ``stored`` do.
    """
    spark, unique = df.sparkSession, f"{re.sub('[^a-z0-9]+', '_', name)}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", f"{checkpoint_dir(spark)}/{unique}").option("compression", "snappy").saveAsTable(unique, format="parquet")
    out = spark.table(unique)
    spark.sql(f"DROP TABLE {unique}")
    return out


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of ``df`` if its rows have at most ``limit`` bytes together.

    ``df`` should be stored already: its rows are measured. Eight bytes a column, and what
    strings and binaries are long; other kinds of columns are never broadcast.
    """
    kinds = dict(df.dtypes)
    if any(k.startswith(("array", "map", "struct", "variant")) for k in kinds.values()):
        return df
    long = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c, k in kinds.items() if k in ("string", "binary")]
    size = df.agg(F.sum(sum(long, F.lit(8 * len(kinds) + 8)).cast("bigint"))).head()[0] or 0
    return F.broadcast(df) if size <= limit else df


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't use, whatever the case."""
    taken = {c.lower() for c in df.columns}
    name, k = stem, 0
    while name.lower() in taken:
        k += 1
        name = f"{stem}{k}"
    return name
