"""Nearest neighbours against a brute-force version."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import neighbours
from tidegate.llm.store import storage

NAN, INF = float("nan"), float("inf")


def usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def brute_force(vectors, k):
    """Sorted (query_id, rank, vec_id, score) of rows whose id is divisible by 20."""
    rows = [(i, v) for i, v in vectors if usable(v)]
    out = []
    for place, (query, a) in enumerate(rows):
        if query is None or query % 20:
            continue
        scored = []
        for other, (i, b) in enumerate(rows):
            if other != place and len(a) == len(b):
                score = 0.0
                for x, y in zip(a, b, strict=True):
                    score += x * y
                scored.append((-score, i is None, i or 0))
        for rank, (score, unknown, i) in enumerate(sorted(scored)[:k], 1):
            out.append((query, rank, None if unknown else i, -score))
    return sorted(out, key=str)


def found(spark, vectors, k, kind="float", **sizes):
    df = spark.createDataFrame(vectors, f"vec_id long, embedding array<{kind}>").repartition(3)
    df = df.select("*", *[F.lit("clash").alias(c) for c in ("dim", "part", "seq", "q", "c", "n", "place", "score", "rank")])
    got = neighbours.find_nearest(df, F.col("vec_id") % 20 == 0, storage(df, "near"), k, **sizes)
    return sorted((tuple(r) for r in got.collect()), key=str)


def single(vectors):
    """Components as a float column holds them."""
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in vectors]


def drawn(seed, n, dim):
    draw = np.random.default_rng(seed)
    return [(i, draw.normal(size=dim).tolist()) for i in range(n)]


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("sizes", [{}, {"query_rows": 4, "span_rows": 50}])
def test_random_vectors(spark, kind, sizes):
    vectors = drawn(1, 400, 16) + [(i + 400, v) for i, v in drawn(2, 100, 3)]
    want = single(vectors) if kind == "float" else vectors
    assert found(spark, vectors, 7, kind, **sizes) == brute_force(want, 7)


def test_edge_cases(spark):
    base = [0.5, -0.25, 1.0]
    vectors = [
        (0, base), (0, base), (20, [-x for x in base]), (None, base), (None, [2.0, 2.0, 2.0]), (3, base), (4, base), (5, None), (6, []),
        (40, [0.0, 0.0, 0.0]), (60, [0.0, None, 1.0]), (80, [NAN, 0.0, 1.0]), (100, [1.0, INF, 0.0]), (120, [1.0, 2.0]), (140, [3.0]),
        (7, [1e30, -1e30, 1e30]), (8, [1e-40, 0.0, 0.0]), (160, [1e-44, 1e-44, 0.0]), (-20, base), (9, [-0.0, 0.0, 1e-3]),
    ]
    for k in (1, 3, 50):
        assert found(spark, vectors, k) == brute_force(single(vectors), k)


def test_a_vector_that_a_third_of_all_rows_hold(spark):
    vectors = drawn(3, 600, 8)
    vectors = [(i, vectors[0][1] if i % 3 == 0 else v) for i, v in vectors]
    assert found(spark, vectors, 20, query_rows=10, span_rows=100) == brute_force(single(vectors), 20)


def test_no_rows_and_no_queries(spark):
    assert found(spark, [], 5) == []
    assert found(spark, [(1, [1.0]), (2, [2.0])], 5) == []
    assert found(spark, [(20, [1.0])], 5) == []


def test_products_that_overflow_rank_by_what_doubles_give(spark):
    vectors = [(0, [1e200, 1e200]), (1, [1e200, 1e200]), (2, [1e200, -1e200]), (3, [1.0, 1.0])]
    assert [(r[1], r[2], r[3]) for r in found(spark, vectors, 3, "double")] == [(1, 1, INF), (2, 3, 2e200), (3, 2, -INF)]


def test_bounds_hold_for_every_pair():
    draw = np.random.default_rng(5)
    x = draw.normal(size=(200, 1500)) * np.exp(draw.normal(size=(200, 1)) * 5)
    codes, (scale, near, rest, length) = (lambda c, b: (c, b.T))(*neighbours.quantise(x))
    product = neighbours.tile(codes, codes)
    assert (product == codes.astype(np.int64) @ codes.astype(np.int64).T).all()
    error = near[:, None] * rest + rest[:, None] * length + neighbours.SLACK * 1516 * length[:, None] * length
    assert (np.abs(product * scale[:, None] * scale - x @ x.T) <= error).all()
