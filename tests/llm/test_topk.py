"""Exact top-k against sorting all scores."""

import math
import random

import pytest
from pyspark.sql import functions as F

from prosemill.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score long, row string, terms string"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 1, "clash", "clash") for i, e in rows], SCHEMA).repartition(4)


def direct(rows, k, divisor):
    kept = []
    for i, e in rows:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            kept.append((i, [math.floor(256.0 * x) for x in e]))
    out = []
    for a, (i, e) in enumerate(kept):
        if i % divisor == 0:
            scored = sorted((-sum(x * y for x, y in zip(e, f)), j) for c, (j, f) in enumerate(kept) if c != a)
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return out


def rows_for(seed, n, wide=8):
    rng = random.Random(seed)
    value = lambda: rng.choice([0.0, 0.25, -0.5, 1.0, rng.uniform(-1, 1)])  # noqa: E731 - many ties
    return [(rng.randint(0, 3 * n) if i % 3 else i, [struct_float(value()) for _ in range(wide)]) for i in range(n)]


def struct_float(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


@pytest.mark.parametrize("block", [3, 4096])
def test_against_all_scores(shared, block):
    rows = rows_for(1, 150) + [(None, [1.0]), (4, None), (6, [float("nan")] * 8), (8, [float("inf")] * 8), (10, [None] * 8)]
    rows += [(900 + i, [0.5] * 8) for i in range(40)] + [(12, []), (18, [1.0, 1.0])] + rows_for(1, 5)
    vectors = topk.integer_vectors(frame(shared, rows), "vec_id", "embedding", 256)
    got = topk.top_k(vectors, F.pmod("vec_id", F.lit(30)) == 0, 5, block)
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect())
    assert found == sorted(direct(rows, 5, 30))


def test_few_rows(shared):
    vectors = topk.integer_vectors(frame(shared, [(0, [1.0]), (50, [2.0]), (-50, [0.5])]), "vec_id", "embedding", 256)
    got = topk.top_k(vectors, F.lit(True), 5)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got.collect()) == [
        (-50, 1, 50), (-50, 2, 0), (0, 1, 50), (0, 2, -50), (50, 1, 0), (50, 2, -50)
    ]
    assert topk.top_k(vectors, F.lit(False), 5).count() == 0
    assert topk.top_k(vectors.limit(0), F.lit(True), 5).count() == 0


def test_one_common_vector(shared):
    rows = [(i, [1.0, 0.0]) for i in range(6000)]
    vectors = topk.integer_vectors(frame(shared, rows), "vec_id", "embedding", 256)
    got = topk.top_k(vectors, F.col("vec_id").isin(0, 3), 3).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (3, 1, 0), (3, 2, 1), (3, 3, 2)]


def test_repeated_rows_are_rows(shared):
    rows = [(0, [1.0]), (0, [1.0]), (7, [0.5])]
    vectors = topk.integer_vectors(frame(shared, rows), "vec_id", "embedding", 256)
    got = topk.top_k(vectors, F.col("vec_id") == 0, 5).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(0, 1, 0, 65536)] * 2 + [(0, 2, 7, 32768)] * 2
