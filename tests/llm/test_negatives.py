import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm.negatives import inner_products, mine_negatives, scaled_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=10, positives=5, negatives=3):
    """All pairs of the rows, in the order of the definition."""
    sound = [
        (i, v, label) for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept = sorted({(i, tuple(math.floor(256 * x) for x in v), label) for i, v, label in sound}, key=str)
    best = lambda r: (-r[1], r[0] is None, r[0] or 0)
    out = []
    for a in kept:
        if a[0] is None or a[0] % every:
            continue
        scored = [(b[0], sum(x * y for x, y in zip(a[1], b[1], strict=False)), b[2]) for b in kept if b is not a]
        alike = sorted((r for r in scored if r[2] == a[2]), key=best)[:positives]
        other = sorted((r for r in scored if r[2] != a[2]), key=best)
        for p in alike:
            window = [r for r in other if 50 * p[1] <= 100 * r[1] <= 95 * p[1]][:negatives]
            out += [(a[0], p[0], n, r[0], p[1], r[1]) for n, r in enumerate(window, 1)]
    return sorted(out, key=str)


def mined(spark, rows, **blocks):
    vectors = scaled_vectors(spark.createDataFrame(rows, SCHEMA))
    return sorted((tuple(r) for r in mine_negatives(vectors, F.col("id") % 10 == 0, **blocks).collect()), key=str)


def vectors(n, seed, dims=6, labels=3):
    rng = random.Random(seed)
    return [(i, [rng.choice([-1.0, 0.0, 0.25, 0.5, 1.0]) for _ in range(dims)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("blocks", [{}, {"block_anchors": 3, "block_rows": 17}])
def test_equals_brute_force_with_many_ties(spark, blocks):
    rows = vectors(230, 1)
    got = mined(spark, rows, **blocks)
    assert got == brute(rows) and len(got) > 100


def test_one_vector_in_a_third_of_the_rows(spark):
    rows = vectors(200, 2) + [(1000 + i, [0.5, 0.5, 0.0, 0.25, 1.0, 0.0], i % 2) for i in range(100)]
    assert mined(spark, rows, block_rows=40) == brute(rows)


def test_odd_rows(spark):
    rows = vectors(80, 3)
    rows += rows[:20]  # repeated rows are one
    rows += [(10, [1.0] * 6, 2), (20, None, 1), (30, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (40, [float("nan")] * 6, 1)]
    rows += [(50, [float("inf")] * 6, 1), (60, [1.0] * 6, None), (None, [1.0] * 6, 0), (70, [], 1), (90, [1.0, 1.0], 1)]
    got = mined(spark, rows)
    assert got == brute(rows) and any(r[3] is None or r[1] is None for r in got)


def test_large_components_are_exact_or_held(spark):
    rows = [(0, [2.0**20, 3.0], 1), (1, [2.0**20, 5.0], 1), (2, [2.0**19, 1.0], 2), (3, [1e30, 0.0], 1), (4, [2.0**19, 4.0], 2)]
    got = mined(spark, rows, block_rows=2)
    exact = 256**2 * (2**39 + 3 * 4)
    assert (0, 1, 1, 4, 256**2 * (2**40 + 15), exact) in got
    assert (inner_products(*[scaled([r[1] for r in rows[:3]])] * 2)[0, 1]) == 256**2 * (2**40 + 15)


def scaled(rows):
    import numpy as np

    return np.floor(256 * np.array(rows)).astype(np.int64)


def test_empty_and_without_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(i, [1.0], 1) for i in range(1, 9)]) == []
    assert mined(spark, [(10, [1.0], 1)]) == []


def test_clashing_columns(spark):
    rows = vectors(60, 4)
    wide = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("id", "vector", "key", "part", "block", "anchor", "score")])
    got = mine_negatives(scaled_vectors(wide), F.col("id") % 10 == 0).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
