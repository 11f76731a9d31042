"""Packed archives: chunk files by station, their rejects, and their traces."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Collection, Iterable, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from waveline.functions.names import chunk_date, chunk_station, reject_reason
from waveline.operators import blocks
from waveline.schemas import TRACE
from waveline.sources.mseed import Piece, stream_pieces


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``(folder, name, path, bytes)`` of every file one level below ``root``, by Spark's own listing.

    Folders that start with an underscore are left out. Only the listing is read, no contents.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("bytes"))
    parts = F.split("path", "/")
    rows = files.select(F.element_at(parts, -2).alias("folder"), F.element_at(parts, -1).alias("name"), "path", "bytes")
    base = len(root.rstrip("/").split("/"))
    deep = F.size(parts) if "://" in root else F.size(F.split(F.regexp_replace("path", "^file:/*", "/"), "/"))
    return rows.where((deep == base + 2) & ~F.col("folder").startswith("_"))


def find_chunks(files: DataFrame, stations: list[str] | None = None) -> DataFrame:
    """``(station, chunk, chunk_date, name, path, bytes)`` of the conforming names, in order of name."""
    rows = files.where(chunk_station("name").isNotNull())
    if stations:
        rows = rows.where(F.col("folder").isin(*stations))
    out = rows.select(F.col("folder").alias("station"), F.regexp_replace("name", r"\.zip$", "").alias("chunk"), chunk_date("name").alias("chunk_date"), "name", "path", "bytes")
    return out.orderBy("station", "name")


def rejected(files: DataFrame, stations: list[str] | None = None) -> DataFrame:
    """``(station, name, reason)`` of the files that are no chunks."""
    rows = files.where(F.col("folder").isin(*stations)) if stations else files
    return rows.select(F.col("folder").alias("station"), "name", reject_reason("name").alias("reason")).where("reason is not null")


def unpack(file: BinaryIO, size: int, channels: Collection[str] | None = None) -> Iterator[Piece]:
    """The traces of the first mseed member of a zip, unmerged and in file order, in pieces of at most ``size`` samples.

    Records are decoded as the member inflates; no more than a piece and a window are held.
    """
    with zipfile.ZipFile(file) as z:
        name = next((n for n in z.namelist() if n.lower().endswith(".mseed")), None)
        if name is None:
            raise ValueError("no .mseed member")
        with z.open(name) as member:
            yield from stream_pieces(member, size, channels)


def _batches(station: str, chunk: str, pieces: Iterable[Piece], size: int) -> Iterator[pa.RecordBatch]:
    """Pieces as Arrow batches that go out as they fill, of some ``size`` samples each."""
    held: list[Piece] = []

    def batch() -> pa.RecordBatch:
        same = [pa.array([station] * len(held), pa.string()), pa.array([chunk] * len(held), pa.string())]
        cols = [([p.trace.channel for p in held], pa.string()), ([p.seq for p in held], pa.int32()), ([p.trace.t0 for p in held], pa.float64()), ([p.trace.fs for p in held], pa.float64()), ([p.at for p in held], pa.int64()), ([len(p.trace.data) for p in held], pa.int32()), ([np.asarray(p.trace.data, np.float64).tobytes() for p in held], pa.binary())]
        return pa.RecordBatch.from_arrays([*same, *[pa.array(v, t) for v, t in cols]], ["station", "chunk", "channel", "seq", "t0", "fs", "at", "n", "data"])

    for p in pieces:
        held.append(p)
        if sum(len(x.trace.data) for x in held) >= size or len(held) >= 1000:
            yield batch()
            held = []
    if held:
        yield batch()


def decode(rows: DataFrame) -> DataFrame:
    """The traces, in pieces, of ``(station, chunk, content)`` rows of packed chunk files."""
    size = blocks.BLOCK

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for station, chunk, content in zip(*(batch.column(k) for k in range(3)), strict=True):
                yield from _batches(station.as_py(), chunk.as_py(), unpack(io.BytesIO(content.as_buffer()), size), size)

    return rows.select("station", "chunk", "content").mapInArrow(work, TRACE)


def read_chunks(chunks: DataFrame) -> DataFrame:
    """The traces of ``(station, chunk, path)`` rows in pieces; one file is one task's row.

    Files are read by Spark, so any store it reaches will do; a packed file must fit a task's
    memory, its samples need not. The paths of ``chunks`` pass the driver, without contents: a
    batch run gives a group at a time.
    """
    spark = chunks.sparkSession
    paths = [r.path for r in chunks.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], TRACE)
    content = spark.read.format("binaryFile").load(paths).select("path", "content")
    return decode(content.join(F.broadcast(chunks.select("station", "chunk", "path")), "path"))


class _ChunkPartition(InputPartition):
    def __init__(self, path: str, station: str, chunk: str):
        self.path, self.station, self.chunk = path, station, chunk


class ChunkReader(DataSourceReader):
    """One partition of each chunk file; the options name stations, chunks and channels: no other file is opened, no other channel kept."""

    def __init__(self, root: str, stations: list[str] | None, chunks: list[str] | None, channels: list[str] | None = None):
        self.root, self.wanted, self.channels = root, {"station": stations, "chunk": chunks}, channels

    def partitions(self) -> list[InputPartition]:
        import re

        from waveline.functions.names import CHUNK_NAME

        out = []
        for folder in sorted(os.scandir(self.root), key=lambda e: e.name):
            if not folder.is_dir() or folder.name.startswith("_") or self.wanted["station"] is not None and folder.name not in self.wanted["station"]:
                continue
            for f in sorted(os.listdir(folder.path)):
                if re.match(CHUNK_NAME, f) and (self.wanted["chunk"] is None or f[:-4] in self.wanted["chunk"]):
                    out.append(_ChunkPartition(f"{folder.path}/{f}", folder.name, f[:-4]))
        return out

    def read(self, partition: _ChunkPartition):
        with open(partition.path, "rb") as f:  # read where the zip's directory says, as it inflates
            yield from _batches(partition.station, partition.chunk, unpack(f, blocks.BLOCK, self.channels), blocks.BLOCK)


class ChunkSource(DataSource):
    """``spark.read.format("waveline_chunks").load(root)`` for archives on a mounted file system."""

    @classmethod
    def name(cls) -> str:
        return "waveline_chunks"

    def schema(self) -> str:
        return TRACE

    def reader(self, schema) -> ChunkReader:
        named = [v.split(",") if (v := self.options.get(k)) else None for k in ("stations", "chunks", "channels")]
        return ChunkReader(self.options["path"], *named)


def register(spark: SparkSession) -> None:
    """Make the source known. Files are chosen by options, not by pushed filters: a reader that
    has been given filters is used again for other queries on the same frame."""
    spark.dataSource.register(ChunkSource)
