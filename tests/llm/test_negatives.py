"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gazetta.llm import hard_negatives as H

RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, scale=256, positives=5, negatives=10, low=30, high=90):
    fit = [(i, [math.floor(scale * x) for x in v], y) for i, v, y in rows
           if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, q, y in fit:
        if a % 10:
            continue
        score = sorted((-sum(s * t for s, t in zip(q, p)), i, z) for i, p, z in fit if i != a and len(p) == len(q))
        for s, i, _ in [x for x in score if x[2] == y][:positives]:
            hit = [(-t, j) for t, j, z in score if z != y and low * -s <= 100 * -t <= high * -s][:negatives]
            out += [(a, i, k + 1, j, -s, t) for k, (t, j) in enumerate(hit)]
    return sorted(out)


def table(seed, n=300, size=6, labels=3):
    rng = random.Random(seed)
    f32 = lambda x: float(np.float32(x))
    centre = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(labels)]
    rows = []
    for i in range(n):
        y = rng.randrange(labels)
        rows.append((i, [f32(c + rng.gauss(0, 0.7)) for c in centre[y]], y))
    rows += [(n, None, 1), (n + 1, [f32(1)] * size, None), (n + 2, [None] + [1.0] * (size - 1), 0), (n + 3, [float("nan")] + [1.0] * (size - 1), 0),
             (n + 4, [float("inf")] + [1.0] * (size - 1), 0), (None, [1.0] * size, 0), (1000, [0.0] * size, 1), (1010, [1.0, 2.0], 2), (1011, [2.0, 2.0], 2),
             (1012, [1.0, 1.0], 0), (1020, [], 0), (-10, [1.0] * size, 2)]
    rows += [(2000 + k, rows[5][1], rows[5][2]) for k in range(40)]  # copies: equal scores
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "x", 1) for i, v, y in rows], "vec_id long, embedding array<float>, label int, q string, rank int").repartition(4)


@pytest.mark.parametrize("seed,portion", [(1, 1000), (2, 7)])
def test_brute_force(spark, monkeypatch, seed, portion):
    monkeypatch.setattr(H, "BLOCK", 64)
    rows = table(seed)
    got = H.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, portion=portion)
    assert got.columns == RESULT
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_empty_and_no_anchors(spark):
    df = frame(spark, table(3, n=20))
    assert H.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []
    assert H.hard_negatives(df, F.lit(False)).collect() == []


def test_norms_that_would_round_are_refused(spark):
    df = spark.createDataFrame([(0, [1e9, 1.0], 1), (1, [1.0, 1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="norm"):
        H.hard_negatives(df, F.col("vec_id") == 0).collect()


def test_bounds_hold_for_rows_and_groups():
    rng = np.random.default_rng(4)
    q = np.floor(rng.normal(size=(400, 8)) * rng.choice([1, 30, 2000], size=(400, 1)))
    q[:5] = 0
    norm = np.sqrt((q * q).sum(1))
    ref = H.fit_references(q[:100], 5)
    angle = H.angles_to(q, norm, ref)
    score = q[:50] @ q.T
    low, high = H.row_bounds(angle[:50], norm[:50], angle, norm)
    assert ((low <= score) & (score <= high)).all()
    assert (high < score.max()).mean() > 0.1  # and they tell rows apart
    first = np.arange(0, 400, 16)
    g = [f.reduceat(x, first) for x in (angle, norm) for f in (np.minimum, np.maximum)]
    low, high = H.group_bounds(angle[:50], norm[:50], *g)
    assert (np.repeat(low, 16, axis=1) <= score).all() and (score <= np.repeat(high, 16, axis=1)).all()
