import math
import random

import pytest
from llm_helpers import rows_of
from pyspark.sql import functions as F

from waveline.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<float>, score string, a string, block string, q string"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def make(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA)


def brute(rows, every):
    """Each anchor against all rows, by sorting them."""
    known = {(i, k, tuple(math.floor(256 * x) for x in v)) for i, k, v in rows if i is not None and k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for i, label, v in known:
        if i % every:
            continue
        scored = sorted((-dot(v, w), j, k) for j, k, w in known if j != i)
        for minus, j, _ in [x for x in scored if x[2] == label][:5]:
            near = [x for x in scored if x[2] != label and 30 * -minus <= 100 * -x[0] <= 90 * -minus]
            out |= {(i, j, rank, n, -minus, -s) for rank, (s, n, _) in enumerate(near[:10], 1)}
    return sorted(out)


def vectors(seed, n, dims=40, labels=4):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.2) for _ in range(dims)] for _ in range(labels)]
    exact = lambda x: round(x * 1024) / 1024  # noqa: E731  the same as a float
    rows = []
    for i in range(n):
        k = 0 if rng.random() < 0.4 else rng.randrange(labels)
        rows.append((i, k, [exact(c + rng.gauss(0, 0.2)) for c in centres[k]]))
    return rows


@pytest.mark.parametrize("size,anchors,chunk,seed", [(2048, 512, 32, 1), (17, 5, 7, 2), (64, 3, 64, 3)])
def test_against_brute_force(spark, size, anchors, chunk, seed):
    rows = vectors(seed, 300)
    got = negatives.mine(make(spark, rows), F.col("vec_id") % 10 == 0, size=size, anchors_size=anchors, chunk=chunk)
    assert rows_of(got, *COLUMNS) == brute(rows, 10)


def test_ties_repeats_and_rows_without_part(spark):
    same = [0.5, 0.25, -0.125]
    rows = [(i, i % 3, same) for i in range(40)]  # all scores tie
    rows += [(i, 1, [0.25, 0.125, 0.0]) for i in range(40, 70)] + [(60, 1, [0.25, 0.125, 0.0])] * 7
    rows += [(100, None, same), (None, 1, same), (110, 1, None), (120, 1, [0.5, None, 0.5]), (130, 2, [0.5, float("nan"), 0.5]), (140, 2, [float("inf"), 0.0, 0.0])]
    rows += [(20, 2, [0.25, 0.25, 0.25]), (150, 0, []), (160, 0, [0.5]), (170, 5, same)]
    got = negatives.mine(make(spark, rows), F.col("vec_id") % 10 == 0, size=16, anchors_size=4, chunk=2)
    assert rows_of(got, *COLUMNS) == brute(rows, 10)


def test_large_components_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, i % 2, [float(2**21 + rng.randrange(64) * 4), float(2**20 * rng.randrange(1, 3))]) for i in range(60)]
    got = negatives.mine(make(spark, rows), F.col("vec_id") % 10 == 0)
    assert rows_of(got, *COLUMNS) == brute(rows, 10)


def test_negative_scores_have_no_window(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [-1.0, 0.0]), (2, 2, [-0.5, 0.0]), (3, 2, [0.0, 1.0])]
    assert negatives.mine(make(spark, rows), F.col("vec_id") == 0).collect() == []


def test_empty_tables(spark):
    assert negatives.mine(make(spark, []), F.col("vec_id") % 10 == 0).collect() == []
    assert negatives.mine(make(spark, vectors(1, 20)), F.col("vec_id") < 0).collect() == []
    assert negatives.mine(make(spark, [(10, 1, [0.5])]), F.col("vec_id") % 10 == 0).collect() == []


def test_chunks_add_up_to_whole_products(spark):
    """More partial tiles than blocks meet: sums over chunks, as brute force has them."""
    rows = vectors(9, 60, dims=130)
    got = negatives.mine(make(spark, rows), F.col("vec_id") % 10 == 0, size=10, anchors_size=2, chunk=16)
    assert rows_of(got, *COLUMNS) == brute(rows, 10)
