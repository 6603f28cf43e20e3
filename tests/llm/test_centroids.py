"""Centroid clustering against plain rounds over all distances."""

import hashlib
import math
import random

import numpy as np
import pytest

from prosemill.llm import centroids as ce

SCHEMA = "vec_id long, embedding array<float>, cluster string, distance string, v string, d string"


def clustered(spark, rows, size=4, k=3, rounds=10, **kind):
    df = spark.createDataFrame([(*r, "c", "c", "c", "c") for r in rows], SCHEMA).repartition(3)
    vectors = ce.integer_vectors(df, "vec_id", "embedding", scale=1024, size=size)
    got = ce.cluster(vectors, k=k, rounds=rounds, **kind).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted((tuple(r) for r in got), key=key)


def direct(rows, size=4, k=3, rounds=10):
    kept = []
    for i, e in rows:
        if e is None or len(e) != size or any(x is None or not math.isfinite(x) for x in e):
            continue
        v = [math.floor(1024.0 * x) for x in e]
        if all(abs(x) < 1 << 27 for x in v):
            kept.append((i, v))
    start = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    points = [v for _, v in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(points))

    if not points:
        return []
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        new = []
        for j, c in enumerate(points):
            mine = [v for (_, v), o in zip(kept, own) if o == j]
            new.append([sum(x) // len(mine) for x in zip(*mine)] if mine else c)
        points = new
    out = [(i, *reversed(nearest(v))) for i, v in kept]
    per = {}
    for _, j, d in out:
        per[j] = per.get(j, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in points]
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted(((i, j, d, per[j], sum(per.values()), digest[j]) for i, j, d in out), key=key)


def rows_for(seed, n, size=4):
    rng = random.Random(seed)
    centres = [[rng.uniform(-2, 2) for _ in range(size)] for _ in range(4)]
    return [(i, [float(np.float32(x + rng.choice([0, 0.5, rng.gauss(0, 0.4)]))) for x in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("pivots", [1, 5])
def test_against_plain_rounds(shared, pivots, monkeypatch):
    monkeypatch.setattr(ce, "CHUNK", 64)
    rows = rows_for(1, 400)
    rows += [(None, [1.0] * 4), (5, None), (6, [1.0] * 3), (7, [None] * 4), (8, [float("nan")] * 4), (9, [float("-inf")] * 4),
             (10, []), (11, [1e9] * 4), (12, [-0.0] * 4)]
    rows += rows[:30] + [(900 + i, [0.25] * 4) for i in range(50)]
    for rounds in (0, 2, 10):
        assert clustered(shared, rows, rounds=rounds, pivots=pivots) == direct(rows, rounds=rounds)


def test_few_rows_and_ties(shared):
    assert clustered(shared, []) == []
    assert clustered(shared, [(1, None)]) == []
    assert clustered(shared, [(None, [1.0] * 4)]) == []  # nothing to start from
    one = [(3, [0.5] * 4)]
    assert clustered(shared, one) == direct(one)
    equal = [(i, [0.5] * 4) for i in range(6)]  # equal centroids: the smaller number wins, the others stay empty
    got = clustered(shared, equal)
    assert got == direct(equal) and {r[1] for r in got} == {0}
    split = [(1, [0.0] * 4), (2, [2.0] * 4), (4, [1.0] * 4)]
    assert clustered(shared, split, k=2) == direct(split, k=2)


def test_pivots_spare_distances(shared):
    """Fewer exact distances than vectors times centroids, with the same result."""
    rng = random.Random(4)
    spots = [[rng.uniform(-8, 8) for _ in range(4)] for _ in range(12)]
    rows = [(i, [float(np.float32(x + rng.gauss(0, 0.1))) for x in spots[i % 12]]) for i in range(600)]
    trace = []
    assert clustered(shared, rows, k=8, trace=trace) == direct(rows, k=8)
    n, exact = (sum(x) for x in zip(*trace))
    assert exact < 0.5 * n * 8
