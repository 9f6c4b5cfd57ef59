"""Hard negatives against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortwatch.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, k=5):
    """Rows (anchor, positive, rank, negative, positive score, negative score) by comparing all with all."""
    clean = {(i, lab, tuple(math.floor(256 * float(x)) for x in v)) for i, v, lab in rows if None not in (i, v, lab) and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in clean:
        if a[0] % every:
            continue
        dot = lambda b: sum(x * y for x, y in zip(a[2], b[2]))  # noqa: B023, E731
        others = sorted(((-dot(b), b[0], b[1]) for b in clean if b != a))
        for s, p, _ in [o for o in others if o[2] == a[1]][:k]:
            near = [o for o in others if o[2] != a[1] and 80 * -s <= 100 * -o[0] <= 100 * -s][:k]
            out += [(a[0], p, r, n, -s, -m) for r, (m, n, _) in enumerate(near, 1)]
    return sorted(out)


def mined(df, **more):
    found = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, **more)
    return sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def vectors(n, d, seed, spread=1.0):
    make = random.Random(seed)
    centre = [make.gauss(0, 1) for _ in range(d)]
    return [(i, [float(np.float32(c + make.gauss(0, spread))) for c in centre], make.randrange(3)) for i in range(n)]


def test_scores_are_inner_products():
    make = np.random.default_rng(3)
    for d, top in ((1, 3), (8, 300), (13, 5000), (64, 256)):
        a, v = make.integers(-top, top + 1, (5, d)), make.integers(-top, top + 1, (40, d))
        assert (hard_negatives.scores(hard_negatives.subset_sums(a), hard_negatives.bit_planes(v)) == v @ a.T).all()
    for v in (np.zeros((3, 8), np.int64), np.full((2, 8), -1), np.full((2, 8), -256), np.full((1, 3), 255)):
        a = np.arange(v.shape[1])[None] - 3
        assert (hard_negatives.scores(hard_negatives.subset_sums(a), hard_negatives.bit_planes(v)) == v @ a.T).all()


@pytest.mark.parametrize("anchor_rows", [16_384, 2])
def test_all_rows_are_searched(spark, monkeypatch, anchor_rows):
    monkeypatch.setattr(hard_negatives, "TILE", 3)
    monkeypatch.setattr(hard_negatives, "BLOCK", 50)
    rows = vectors(700, 12, 5)
    got = mined(spark.createDataFrame(rows, SCHEMA), anchor_rows=anchor_rows)
    assert got == brute(rows) and len(got) > 100


def test_ties_copies_and_odd_rows(spark):
    rows = vectors(120, 6, 7)
    rows += [(200 + i, rows[0][1], i % 2) for i in range(40)]  # one vector many times
    rows += [rows[0], rows[0], (0, rows[0][1], 2), (0, rows[5][1], rows[0][2])]  # repeated rows, and an id with other contents
    rows += [(None, rows[1][1], 1), (300, None, 1), (301, rows[1][1], None), (302, [None, 1.0], 1), (303, [float("nan")] * 6, 1), (304, [float("inf")] * 6, 1), (400, [0.0] * 6, 1), (500, [-1.0, 2.0], 1), (600, [], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "anchor", "vector", "rank", "score", "pair", "label_"):
        df = df.withColumn(name, F.lit("x"))
    assert mined(df) == brute(rows)
    assert mined(df.limit(0)) == [] and mined(df.where("vec_id % 100 <> 0")) == []


def test_scores_beyond_64_bits_are_an_error(spark):
    df = spark.createDataFrame([(0, [1e18], 1), (1, [1e18], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="64 bits"):
        mined(df)
