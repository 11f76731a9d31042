"""Earlier, file-based products as rows of the engine's tables, never over what is there.

Files are listed by Spark on any store and known by their paths (``find``). Each kind is then one
scan of its files, whatever their number, joined to what their paths say (``convert``): files are
left where they are, and rows of a key that the table already has are not written again. Of two
files of one key the first counts, in order of folders and paths; readings are kept of all.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waveline.schemas import BASELINE, COINCIDENCE, CONDITIONING
from waveline.sources import mseed, store, tables
from waveline.sources.store import Layout

#: Score folders that aren't named for a station, with the station and arm prefix meant.
SPECIAL: dict[str, tuple[str, str]] = {"dense": ("MANT", "dense.")}
#: The chunk that a station's one table of readings counts as.
WHOLE = "adopted"
KEYS = ("station", "arm", "chunk", "length", "tag", "station_a", "station_b")


@dataclass(frozen=True)
class Kind:
    """Files of one kind: a pattern over paths below a root, what its groups are, and how they become rows of a table."""

    pattern: str
    groups: tuple[str, ...]
    names: str  # of its files, so that no others are opened
    write: Callable[[DataFrame, DataFrame, Layout], int]


def find(spark: SparkSession, source: str, also: tuple[str, ...] = (), special: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """What there is to adopt, ``(kind, root, at, path)`` and its keys; ``special`` explains odd score
    folders. Folders of ``also`` are looked at for loose files only, and may be missing.

    Only the listing is read, no contents.
    """
    found = None
    for at, root in enumerate((source, *also)):
        if store.exists(spark, root):
            base = _qualified(spark, root)
            rows = _contents(spark, root, "*").select(F.lit(base).alias("root"), F.lit(at).alias("at"), "path", F.substring("path", F.lit(len(base) + 2), F.length("path")).alias("_rel"))
            rows = rows if at == 0 else rows.where(~F.contains("_rel", F.lit("/")))
            found = rows if found is None else found.unionByName(rows)
    if found is None:
        return spark.createDataFrame([], "kind string, root string, at int, path string, " + ", ".join(f"{k} string" for k in KEYS))
    kind = F.coalesce(*[F.when(F.rlike("_rel", F.lit(f"^{k.pattern}$")), name) for name, k in KINDS.items()])
    found = found.withColumn("kind", kind).where("kind is not null")
    part = lambda key: [F.when(F.col("kind") == n, F.regexp_extract("_rel", f"^{k.pattern}$", k.groups.index(key) + 1)) for n, k in KINDS.items() if key in k.groups]
    keys = {k: F.upper(F.coalesce(*part(k))) if k.startswith("station") else F.coalesce(*part(k)) for k in KEYS}
    found = found.select("kind", "root", "at", "path", *[c.alias(k) for k, c in keys.items()])
    for name, (station, prefix) in (SPECIAL if special is None else special).items():
        meant = (F.col("kind") == "scores") & (F.lower("station") == name)
        found = found.withColumns({"station": F.when(meant, station).otherwise(F.col("station")), "arm": F.when(meant, F.concat(F.lit(prefix), "arm")).otherwise(F.col("arm"))})
    return found


def convert(spark: SparkSession, found: DataFrame, layout: Layout) -> dict[str, int]:
    """Rows written of each kind that was found; what the tables hold already is left as it is."""
    found, out = store.kept(found), {}
    there = {r.kind: sorted(r.roots) for r in found.groupBy("kind").agg(F.collect_set("root").alias("roots")).collect()}  # as many as folders were named
    for name, kind in KINDS.items():
        if name in there:
            own = found.where(F.col("kind") == name)
            content = None
            for root in there[name]:
                rows = _contents(spark, root, kind.names).select("path", "content")
                content = rows if content is None else content.unionByName(rows)
            out[name] = kind.write(own, content, layout)
    return out


def _qualified(spark: SparkSession, root: str) -> str:
    """A folder as Spark's listing names it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")


def _contents(spark: SparkSession, root: str, names: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", names).load(root)


def _first(own: DataFrame, keys: list[str], had: DataFrame) -> DataFrame:
    """One file of each key, ``(path, keys)``, of keys that the table doesn't have."""
    picked = own.groupBy(*keys).agg(F.min_by("path", F.struct("at", "path")).alias("path"))
    return picked.join(had.select(*keys).distinct(), keys, "left_anti")


def _put(rows: DataFrame, write: Callable[[DataFrame], None]) -> int:
    rows = store.kept(rows)
    if n := rows.count():
        write(rows)
    return n


#: Text fields a line of a table may have.
FIELDS = 64


def _table(content: DataFrame) -> tuple[DataFrame, Callable[[str], Column]]:
    """The lines of CSV files, ``(path, ...)``, and how a field is had of them by its file's own header.

    Headers may differ in order, case, blanks and byte-order marks; a field that a file lacks is null.
    """
    cut = lambda line: F.from_csv(line, ", ".join(f"c{k} string" for k in range(FIELDS)), {"escape": '"'})
    fields = lambda row: F.array(*[F.col(f"{row}.c{k}") for k in range(FIELDS)])
    lines = content.select("path", F.split(F.col("content").cast("string"), "\r?\n").alias("_lines"))
    lines = lines.select("path", cut(F.get("_lines", F.lit(0))).alias("_h"), "_lines").select("path", F.transform(fields("_h"), lambda h: F.lower(F.trim(F.replace(h, F.lit("\ufeff"), F.lit(""))))).alias("_names"), "_lines")
    lines = lines.select("path", "_names", F.explode(F.slice("_lines", F.lit(2), F.greatest(F.size("_lines"), F.lit(1)))).alias("_line")).where(F.trim("_line") != "")
    rows = lines.select("path", "_names", cut("_line").alias("_v")).select("path", "_names", fields("_v").alias("_values"))
    return rows, lambda name: F.try_element_at("_values", F.nullif(F.array_position("_names", name), F.lit(0)).cast("int"))


def _baselines(own: DataFrame, content: DataFrame, layout: Layout) -> int:
    spark = own.sparkSession
    made_by = ("fs", "freqmin", "freqmax", "piece_seconds", "trim")
    numbers = ("mu", "sigma", "sigma_trimmed", "sigma_median", "n_samples", "n_pieces")
    parsed = F.from_json(F.col("content").cast("string"), f"map<string, struct<{', '.join(f'{c}: double' for c in (*numbers, *made_by))}>>")
    files = _first(own, ["station"], store.read_table(spark, layout.baseline, "station string"))
    roles = content.join(files, "path").select("station", parsed.alias("_all")).select("station", F.try_element_at("_all", F.lit("_conditioning")).alias("_by"), F.explode("_all").alias("role", "_of")).where("role <> '_conditioning'")
    whole = spark.createDataFrame([], f"{BASELINE}, {CONDITIONING}")
    made = {c: F.col(f"_of.{c}") for c in numbers} | {c: F.col(f"_by.{c}") for c in made_by} | {"bands": F.lit(None), "chunks": F.lit(None)}
    rows = roles.withColumns(made).select(*[F.col(f.name).cast(f.dataType) for f in whole.schema])
    return _put(rows, lambda df: store.write_baseline(df, layout))


def _readings(own: DataFrame, content: DataFrame, had: DataFrame) -> DataFrame:
    lines, field = _table(content)
    number = lambda c: F.nullif(field(c).try_cast("double"), F.lit(float("nan"))).alias(c)
    files = own.select("path", "station").distinct().join(had.select("station").distinct(), "station", "left_anti")
    return lines.join(files, "path").select(field("event_id").try_cast("bigint").alias("event_id"), number("snr"), field("time").try_cast("timestamp").alias("time"), *[number(c) for c in ("mag", "dist_km", "depth")], field("location").alias("location"), "station", F.lit(WHOLE).alias("chunk"))


def _snr(own: DataFrame, content: DataFrame, layout: Layout) -> int:
    had = store.read_table(own.sparkSession, layout.snr_parts, "station string")
    return _put(_readings(own, content, had), lambda df: store.write_snr_parts(df, layout))


def _snr_partial(own: DataFrame, content: DataFrame, layout: Layout) -> int:
    """Superseded readings are kept apart, for comparison."""
    path = layout.dataset("snr_partial")
    had = store.read_table(own.sparkSession, path, "station string")
    return _put(_readings(own, content, had), lambda df: df.write.mode("append").parquet(path))


def _scores(own: DataFrame, content: DataFrame, layout: Layout) -> int:
    spark, keys = own.sparkSession, ["station", "arm", "chunk"]
    of = "station string, arm string, chunk string"
    fresh = store.kept(_first(own, keys, store.read_table(spark, layout.scores, of)))
    rows = tables.decode_scores(content.join(fresh.select("path"), "path", "left_semi"))
    written = _put(rows.join(fresh, "path").drop("path"), lambda df: store.write_scores(df, layout))
    count = store.read_table(spark, layout.scores, of).groupBy(*keys).agg(F.count("*").alias("outputs"))
    done = fresh.join(count, keys, "left").fillna(0, ["outputs"])
    store.mark_completed(done.withColumn("product", F.concat(F.lit("scores:"), F.col("arm"))), layout)
    return written


def _windows(own: DataFrame, content: DataFrame, layout: Layout) -> int:
    own = own.withColumn("length_s", F.col("length").cast("double"))
    had = store.read_table(own.sparkSession, layout.windows, "station string, length_s double, tag string")
    fresh = store.kept(_first(own, ["station", "length_s", "tag"], had))

    def work(batches):
        for batch in batches:
            rows = []
            for path, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                traces = mseed.read_traces(packed)
                rows.append((path, traces[0].t0, [t.data.astype("int32").tolist() for t in traces]))
            types = (pa.string(), pa.float64(), pa.list_(pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["path", "t0", "samples"])

    rows = content.join(fresh.select("path"), "path", "left_semi").mapInArrow(work, "path string, t0 double, samples array<array<int>>").join(fresh, "path")
    rows = rows.select("station", F.lit(WHOLE).alias("chunk"), F.regexp_extract("tag", r"event_(\d+)_raw", 1).cast("bigint").alias("event_id"), "length_s", F.when(F.col("tag").startswith("noise_"), "noise").otherwise("eq").alias("kind"), "tag", "t0", "samples")
    return _put(rows, lambda df: store.write_windows(df, layout))


def _pairs(own: DataFrame, content: DataFrame, layout: Layout) -> int:
    """Tables of two stations, whichever of them is named first; what a table lacks is had of its file's name."""
    own = own.withColumn("pair", store.pair_key())
    files = _first(own, ["pair", "arm"], store.read_table(own.sparkSession, layout.pairs, "pair string, arm string"))
    files = own.join(files.select("path"), "path", "left_semi").select("path", "arm", *[F.col(c).alias(f"_{c}") for c in ("station_a", "station_b")]).distinct()
    lines, field = _table(content)
    named = {"station_a": F.col("_station_a"), "station_b": F.col("_station_b")}
    fields = [c.strip().split(" ") for c in COINCIDENCE.split(",")]
    rows = lines.join(files, "path").select(*[F.coalesce(field(c), named.get(c, F.lit(None))).try_cast(kind).alias(c) for c, kind in fields], "arm")
    return _put(rows, lambda df: store.write_pairs(df, layout))


#: How the earlier tools named their files.
KINDS = {
    "baseline": Kind(r"([^/_]+)_(?:[^/]*_)?baseline\.json", ("station",), "*baseline.json", _baselines),
    "snr": Kind(r"([^/_]+)_(?:[^/]*_)?range_full\.csv", ("station",), "*range_full.csv", _snr),
    "snr_partial": Kind(r"([^/_]+)_(?:[^/]*_)?range\.csv", ("station",), "*range.csv", _snr_partial),
    "scores": Kind(r"scores_([^/]+)/([^/]+)/([^/]+)\.npz", ("station", "arm", "chunk"), "*.npz", _scores),
    "windows": Kind(r"raw/continuous_windows/([\d.]+)s/([^/]+)/(?:.*/)?((?:noise_)?event_\d+_raw)\.mseed", ("length", "station", "tag"), "*event_*_raw.mseed", _windows),
    "pairs": Kind(r"runs_coinc/([a-z0-9]+)_([a-z0-9]+)_([a-z0-9]+)_coincidence\.csv", ("station_a", "station_b", "arm"), "*_coincidence.csv", _pairs),
}
