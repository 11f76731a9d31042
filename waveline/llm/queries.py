"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waveline.llm import decontaminate, extract, langid, media, mixing, negatives, simhash, substring, suffixes, tokencount, urlfilter, warc

#: The rules that op5 judges by.
URL_RULES = [
    urlfilter.Rule("block", "com", "/en/"),
    urlfilter.Rule("allow", "example.com", "/en/7"),
    urlfilter.Rule("allow", "net", "/de/"),
    urlfilter.Rule("block", "example.net", "/de/8"),
    urlfilter.Rule("block", "org", "/es/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = media.store_texts(_table(spark, sf_dir, "documents"))
    return media.sniff(stored, ["doc_id", "n_bytes"])


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(_table(spark, sf_dir, "documents")).drop("intervals")


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(_table(spark, sf_dir, "documents"))
    return rows.withColumns({c: F.round(c, 4) for c in ("weight", "probability")})


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(_table(spark, sf_dir, "pages"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(_table(spark, sf_dir, "pages"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup(_table(spark, sf_dir, "documents")).drop("spans")


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)


QUERIES = {"op1_simhash": op1_simhash, "op2_media": op2_media, "op3_langid": op3_langid, "op4_substring": op4_substring, "op5_urls": op5_urls, "op6_mixing": op6_mixing, "op7_tokens": op7_tokens, "op8_extract": op8_extract, "op9_warc": op9_warc, "op10_decontaminate": op10_decontaminate, "op11_suffixes": op11_suffixes, "op12_negatives": op12_negatives}

_OP4 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS s FROM w WHERE len(words) >= 50
), windows AS (
  SELECT doc_id, s, array_to_string(words[s:s + 49], ' ') AS x FROM starts
), firsts AS (
  SELECT x, min(doc_id) AS first FROM windows GROUP BY x HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM windows JOIN firsts USING (x) WHERE doc_id > first
), lost AS (
  SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id
), kept AS (
  SELECT w.doc_id, words, coalesce(len(gone), 0) AS n_removed,
         CASE WHEN gone IS NULL THEN words ELSE list_filter(words, lambda x, i: NOT list_contains(gone, i)) END AS kept
  FROM w LEFT JOIN lost ON w.doc_id = lost.doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM kept
"""

_OP5 = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN url IS NOT NULL AND position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut
), rules(action, rhost, rpath) AS (
  VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')
), fits AS (
  SELECT page_id, action, rhost || rpath AS rule,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, action DESC) AS k
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.action, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.page_id = f.page_id AND f.k = 1
"""

_OP9 = """
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), best AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS last FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to
FROM best
"""



def _rake_sql() -> str:
    """The sweeps as nested subqueries: each rake is one window sum over a margin."""
    topic = "CASE " + " ".join(f"WHEN contains(text, '{mark}') THEN '{name}'" for name, mark in mixing.TOPICS) + f" ELSE '{mixing.GENERAL}' END"
    targets = ", ".join(f"pow(sum(n) OVER (PARTITION BY {m}), {t}) AS {m}_raw" for m, t in mixing.TARGETS.items())
    # A margin's raw target, once for each of its values: divided by how many cells hold it.
    raws = ", ".join(f"{m}_raw / sum({m}_raw / {m}_cells) OVER () AS {m}_share" for m in mixing.TARGETS)
    counts = ", ".join(f"count(*) OVER (PARTITION BY {m}) AS {m}_cells" for m in mixing.TARGETS)
    now = f"SELECT *, sum(n) OVER () AS total, CAST(1 AS DOUBLE) AS f, CAST(1 AS DOUBLE) AS off, true AS go, {raws} FROM (SELECT *, {targets}, {counts} FROM cells)"
    for _ in range(mixing.SWEEPS):  # a sweep goes on if a ratio of the one before was off by more than the tolerance
        now = f"SELECT * REPLACE (max(off) OVER () > {mixing.TOLERANCE} AS go, CAST(0 AS DOUBLE) AS off) FROM ({now})"
        for m in mixing.TARGETS:
            ratio = f"CASE WHEN NOT go OR w <= 0 THEN 1 ELSE total * {m}_share / w END"
            now = f"SELECT * EXCLUDE (w) REPLACE (f * {ratio} AS f, greatest(off, abs({ratio} - 1)) AS off) FROM (SELECT *, sum(n * least(1, {mixing.BUDGET} * f)) OVER (PARTITION BY {m}) / {mixing.BUDGET} AS w FROM ({now}))"
    return f"""
WITH rows AS (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, {topic} AS topic,
         CAST(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens
  FROM (SELECT * REPLACE (coalesce(text, '') AS text) FROM documents)
), cells AS (
  SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS n FROM rows GROUP BY ALL
), raked AS ({now})
SELECT doc_id, source, lang, topic, n_tokens, round(least(1, {mixing.BUDGET} * f) / {mixing.BUDGET}, 4) AS weight, round(least(1, {mixing.BUDGET} * f), 4) AS probability,
       CAST(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / pow(2, 52) < least(1, {mixing.BUDGET} * f) AS sampled
FROM rows JOIN raked USING (source, lang, topic)
"""


_OP11 = """
WITH b AS (
  SELECT doc_id, encode(coalesce(text, '')) AS x, strlen(coalesce(text, '')) AS n FROM documents
), windows AS (
  SELECT doc_id, s, x[s + 1 : s + 50] AS w FROM (SELECT doc_id, x, unnest(range(0, n - 49)) AS s FROM b WHERE n >= 50)
), firsts AS (
  SELECT w, min(doc_id) AS first FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)
), late AS (
  SELECT doc_id, s, coalesce(s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50, true) AS new FROM windows JOIN firsts USING (w) WHERE doc_id > first
), runs AS (
  SELECT doc_id, min(s) AS lo, max(s) + 50 AS hi
  FROM (SELECT *, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM late) GROUP BY doc_id, run
), pieces AS (
  SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM runs
), cut AS (
  SELECT b.doc_id, string_agg(hex(x[before + 1 : lo]), '' ORDER BY lo) || hex(any_value(x)[max(hi) + 1 :]) AS kept, count(*) AS n_spans, sum(hi - lo) AS n_removed
  FROM pieces JOIN b ON b.doc_id = pieces.doc_id GROUP BY b.doc_id
)
SELECT b.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(coalesce(unhex(kept), x)) AS kept_sha256
FROM b LEFT JOIN cut ON b.doc_id = cut.doc_id
"""

_OP12 = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 10
"""


SQL = {"op4_substring": _OP4, "op5_urls": _OP5, "op6_mixing": _rake_sql(), "op9_warc": _OP9, "op11_suffixes": _OP11, "op12_negatives": _OP12}
