"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling.

Documents fall into cells of source, language and topic. Raking multiplies a cell's factor, one
margin after another, by what brings the margin's expected tokens to its target; a cell's
probability is ``min(1, budget * factor)``. Expected tokens are counted with that bound in
place, so what a cell that is taken whole cannot give, the others of its margin make up for:
the sampled shares meet the targets wherever any probabilities do. Sweeps end when none of a
sweep's ratios is further than ``TOLERANCE`` from 1, or after ``SWEEPS``; ``margins`` says how
far each share is from its target. A document is sampled by a hash of its id, so that the same ones come on every run.
All of it is DataFrame operations: margins and cells are partial sums before they are shuffled,
and the cells are broadcast only if they are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waveline.llm.common import WORD, bounded_broadcast, checkpoint, fresh, stored

SWEEPS, BUDGET, TOLERANCE = 20, 0.5, 1e-6
#: A margin's target shares: its own token shares to this power (1: as they are, 0: all equal).
TARGETS: dict[str, float | dict[str, float]] = {"source": 0.5, "lang": 0.7, "topic": 0.9}
#: The first topic whose mark a text contains, GENERAL if none; where documents have no topic column.
TOPICS = [("licence", "Licensed under"), ("secret", "password="), ("contact", "@"), ("table", " | "), ("noisy", "%%% "), ("shouting", "!! ")]
GENERAL, NONE = "prose", "(none)"


def topic_of(text: Column, topics: list[tuple[str, str]] = TOPICS) -> Column:
    out = F.lit(GENERAL)
    for name, mark in reversed(topics):
        out = F.when(F.contains(text, F.lit(mark)), name).otherwise(out)
    return out


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def chance(key: Column) -> Column:
    """A number in [0, 1) from a hash of the id; of the empty string for a null id."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("double") / float(1 << 52)


def cells_of(rows: DataFrame, margins: list[str]) -> DataFrame:
    """(margins..., n): the tokens of each cell."""
    return rows.groupBy(*margins).agg(F.sum("n_tokens").alias("n"))


def _shares(cells: DataFrame, margin: str, target: float | dict[str, float]) -> DataFrame:
    """(margin, share): target shares, adding up to 1 over the margin's values with tokens."""
    sums = cells.groupBy(margin).agg(F.sum("n").alias("n"))
    if isinstance(target, dict):
        weight = F.lit(0.0)
        for value, w in target.items():
            weight = F.when(F.col(margin) == value, float(w)).otherwise(weight)
        raw = F.when(F.col("n") > 0, weight).otherwise(0.0)
    else:
        raw = F.when(F.col("n") > 0, F.pow(F.col("n").cast("double"), F.lit(float(target)))).otherwise(0.0)
    sums = sums.select(margin, raw.alias("raw"))
    whole = sums.agg(F.sum("raw")).head()[0]
    return sums.select(margin, (F.col("raw") / F.lit(whole) if whole else F.lit(0.0)).alias("share"))


def probability(factor: Column, budget: float) -> Column:
    return F.least(F.lit(1.0), F.lit(budget) * factor)


def rake(cells: DataFrame, targets: dict[str, float | dict[str, float]] = TARGETS, sweeps: int = SWEEPS, budget: float = BUDGET) -> DataFrame:
    """``cells`` with ``factor``. Stored after every sweep, so that plans stay short.

    Values without tokens, or left out of a target's dict, get factor 0 where their margin is
    raked to nothing. Margins that no probabilities can reach (more tokens asked for than there
    are) leave the last sweep's compromise, those cells taken whole.
    """
    cells = stored(cells, "mixing-cells")
    total = float(cells.agg(F.sum("n")).head()[0] or 0)
    shares = {m: stored(_shares(cells, m, t), "mixing-shares") for m, t in targets.items()}
    small = {m: bounded_broadcast(shares[m]) is not shares[m] for m in targets}
    off = {m: fresh(cells, f"off_{m}") for m in targets}
    now = cells.withColumns({"factor": F.lit(1.0)} | {c: F.lit(0.0) for c in off.values()})
    for _ in range(sweeps):
        for m in targets:
            sums = now.groupBy(m).agg((F.sum(F.col("n") * probability(F.col("factor"), budget)) / budget).alias("w"))
            ratio = sums.join(shares[m], m).select(m, F.when(F.col("w") > 0, F.lit(total) * F.col("share") / F.col("w")).otherwise(1.0).alias("ratio"))
            now = now.join(F.broadcast(ratio) if small[m] else ratio, m)  # as many rows as the shares, which were measured
            now = now.withColumns({"factor": F.col("factor") * F.col("ratio"), off[m]: F.abs(F.col("ratio") - 1)}).drop("ratio")
        now = stored(now, "mixing-sweep")
        if (now.agg(F.max(F.greatest(*off.values(), F.lit(0.0)))).head()[0] or 0.0) <= TOLERANCE:
            break
    return now.drop(*off.values())


def margins(cells: DataFrame, targets: dict[str, float | dict[str, float]] = TARGETS, budget: float = BUDGET) -> DataFrame:
    """``(margin, value, target, expected)`` of raked cells: the share asked for, and that of the tokens expected in the sample."""
    out = None
    taken = F.col("n") * probability(F.col("factor"), budget)
    whole = cells.agg(F.sum(taken)).head()[0] or 0.0
    for m, t in targets.items():
        got = cells.groupBy(m).agg(F.sum(taken).alias("taken")).join(_shares(cells, m, t), m)
        got = got.select(F.lit(m).alias("margin"), F.col(m).alias("value"), F.col("share").alias("target"), (F.col("taken") / F.lit(whole) if whole else F.lit(0.0)).alias("expected"))
        out = got if out is None else out.unionByName(got)
    return out


def _category(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(NONE))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_col: str | None = None) -> DataFrame:
    """``(doc_id, source, lang, topic, n_tokens)``; null categories are one of their own.

    Topics are those of ``topic_col`` if given (a classifier's, say), else by the TOPICS marks.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    topic = _category(topic_col) if topic_col else topic_of(text)
    return docs.select(F.col(id_col).alias("doc_id"), _category(source_col).alias("source"), _category(lang_col).alias("lang"), topic.alias("topic"), n_words(text).alias("n_tokens"))


def mix(docs: DataFrame, targets: dict[str, float | dict[str, float]] = TARGETS, budget: float = BUDGET, sweeps: int = SWEEPS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_col: str | None = None) -> DataFrame:
    """``(doc_id, source, lang, topic, n_tokens, weight, probability, sampled)`` of every row.

    A weight is what a token of the cell counts for: its probability over the budget. Null texts
    have no tokens; null sources and languages are a value of their own. Rows with one id share
    its chance; an empty table gives no rows; other columns are ignored.
    """
    rows = checkpoint(features(docs, id_col, text_col, source_col, lang_col, topic_col))
    cells = rake(cells_of(rows, list(targets)), targets, sweeps, budget)
    weighted = rows.join(bounded_broadcast(cells.drop("n")), list(targets))
    p = probability(F.col("factor"), budget)
    return weighted.select("doc_id", "source", "lang", "topic", "n_tokens", (p / budget).alias("weight"), p.alias("probability"), (chance(F.col("doc_id")) < p).alias("sampled"))


def sample(docs: DataFrame, targets: dict[str, float | dict[str, float]] = TARGETS, budget: float = BUDGET, sweeps: int = SWEEPS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic_col: str | None = None) -> DataFrame:
    """The sampled rows of ``docs`` with all columns. Cells are looked up by the rows' own
    features, so texts are only shuffled where there are too many cells to broadcast. Null texts,
    null and repeated ids, ties and empty tables are as in ``mix``."""
    rows = features(docs, id_col, text_col, source_col, lang_col, topic_col)
    cells = rake(cells_of(rows, list(targets)), targets, sweeps, budget).drop("n")
    names = {m: fresh(docs, f"wl_{m}") for m in (*targets, "factor")}
    by = {"source": _category(source_col), "lang": _category(lang_col), "topic": _category(topic_col) if topic_col else topic_of(F.coalesce(F.col(text_col), F.lit("")))}
    wide = docs.withColumns({names[m]: by[m] for m in targets})
    cells = bounded_broadcast(cells.select(*[F.col(m).alias(names[m]) for m in (*targets, "factor")]))
    kept = wide.join(cells, [names[m] for m in targets]).where(chance(F.col(id_col)) < probability(F.col(names["factor"]), budget))
    return kept.select(*docs.columns)
