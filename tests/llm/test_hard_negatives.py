"""Hard negatives against scoring every pair."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from prosemill.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score long, row string, length string"


def single(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash", "clash") for r in rows], SCHEMA).repartition(4)


def mined(spark, rows, divisor, block=4096, **kind):
    vectors = hn.labelled_vectors(frame(spark, rows), "vec_id", "embedding", F.col("label"), 256)
    got = hn.mine(vectors, F.pmod("vec_id", F.lit(divisor)) == 0, block=block, **kind)
    return sorted(
        (r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got.collect()
    )


def direct(rows, divisor, positives=5, negatives=3):
    kept = [
        (i, [math.floor(256.0 * x) for x in e], c) for i, e, c in rows
        if i is not None and e is not None and c is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    out = []
    for a, (i, e, label) in enumerate(kept):
        if i % divisor:
            continue
        scored = [
            (-sum(x * y for x, y in zip(e, f)), j, at, c) for at, (j, f, c) in enumerate(kept) if at != a
        ]
        scored.sort(key=lambda s: s[:3])
        for p, pid, _, _ in [s for s in scored if s[3] == label][:positives]:
            fits = [(n, j) for n, j, _, c in scored if c != label and 50 * -p <= 100 * -n <= 95 * -p]
            out += [(i, pid, rank, j, -p, -n) for rank, (n, j) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def groups(seed, n, wide=6, labels=3):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(wide)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = rng.randrange(labels)
        size = rng.choice([0.2, 1.0, 3.0])
        near = [size * (0.7 * x + rng.choice([0.0, 0.25, rng.uniform(-0.5, 0.5)])) for x in centres[label]]
        rows.append((i, [single(x) for x in near], rng.randrange(labels) if rng.random() < 0.3 else label))
    return rows


@pytest.mark.parametrize("block", [7, 4096])
def test_against_all_pairs(shared, block, monkeypatch):
    monkeypatch.setattr(hn, "BUCKET", 32)
    monkeypatch.setattr(hn, "SAMPLE", 16)
    rows = groups(3, 300)
    rows += [(None, [1.0] * 6, 1), (6, None, 1), (12, [0.5] * 6, None), (18, [float("nan")] * 6, 2),
             (24, [float("inf")] * 6, 0), (30, [None] * 6, 0), (36, [], 0), (42, [1.0, -1.0], 1), (48, [0.0] * 6, 2)]
    rows += rows[:20] + [(600 + i, [0.5] * 6, i % 2) for i in range(30)]
    got = mined(shared, rows, 6, block)
    assert got and got == direct(rows, 6)


def test_one_vector_many_times(shared):
    rows = [(i, [1.0, 0.5], i % 2) for i in range(400)] + [(1000 + i, [0.75, 0.25], 1) for i in range(400)]
    got = mined(shared, rows, 100)
    assert got == direct(rows, 100)


def test_few_rows(shared):
    assert mined(shared, [], 5) == []
    assert mined(shared, [(1, [1.0], 0), (2, [1.0], 1)], 5) == []
    assert mined(shared, [(5, [1.0], 0)], 5) == []
    assert mined(shared, [(5, [1.0], 0), (6, [1.0], 0), (7, [0.75], 1), (8, [0.25], 1)], 5) == [(5, 6, 1, 7, 65536, 49152)]


def test_ranges_keep_what_could_reach(rng=np.random.default_rng(5)):
    """Every pair at or above its threshold is among the scored ones, and ranges leave some out."""
    rows = rng.normal(size=(500, 8))
    rows = np.floor(256 * rows / np.linalg.norm(rows, axis=1)[:, None]).astype(np.int64)
    lengths = np.sqrt((rows**2).sum(axis=1).astype(float))
    order = np.argsort(-lengths)
    bucket = hn.Bucket(rows[order], lengths[order])
    anchors = hn.Anchors(rows[:50])
    full = rows[:50] @ rows[order].T
    need = np.sort(full, axis=1)[:, -4].astype(float)
    seen = set()
    computed = []
    dots = hn.dots
    hn.dots = lambda a, b: computed.append(len(a) * len(b)) or dots(a, b)
    try:
        for a, c, s in anchors.scored(bucket, need):
            assert (full[a, c] == s).all()
            seen |= set(zip(a.tolist(), c.tolist()))
    finally:
        hn.dots = dots
    assert seen >= set(zip(*(x.tolist() for x in np.nonzero(full >= need[:, None]))))
    assert sum(computed) < 0.7 * full.size
