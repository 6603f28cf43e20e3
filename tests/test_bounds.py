"""What a task holds or stores stays bounded, with the same results."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from prosemill.operators import features, neighbours, vectors


def test_projection_holds_a_slice_of_rows_at_once():
    rng = np.random.default_rng(5)
    basis = rng.normal(size=(400, 60))
    at = [rng.choice(400, n, replace=False) for n in rng.integers(0, 90, 2000)] + [np.arange(400), np.array([], int)]
    values = [rng.normal(size=len(a)) for a in at]
    dense = np.zeros((len(at), 400))
    for row, a, v in zip(dense, at, values):
        row[a] = v
    for cells in (1, 60 * 100, 1 << 30):  # a row at a time, slices, all at once
        np.testing.assert_allclose(features.projected(at, values, basis, cells), dense @ basis, atol=1e-9)
    assert features.projected([], [], basis).shape == (0, 60)
    tracemalloc.start()
    features.projected(at, values, basis, 60_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8e6  # all weights at once take 43 MB twice over


@pytest.mark.parametrize("max_bytes,part_hits", [(1 << 30, 10), (0, 1 << 20), (0, 20)])
def test_mean_vectors_do_not_sort_the_joined_rows(spark, max_bytes, part_hits):
    rng = np.random.default_rng(3)
    table = {f"w{i}": rng.normal(size=4).tolist() for i in range(30)}
    texts = {f"d{i}": [f"w{j}" for j in rng.integers(0, 40, 25)] for i in range(40)}  # w30 .. w39 are unknown
    texts |= {"none": ["w35"], "empty": []}
    df = spark.createDataFrame([(k, v) for k, v in texts.items()] + [(None, ["w1"])], "id string, t array<string>")
    words = spark.createDataFrame([*table.items(), ("w0", [1.0, 2.0, 3.0, 4.0])], "word string, vector array<double>")
    means = vectors.avg_vector(df, "id", F.col("t"), words, 4, max_bytes, part_hits)
    got = {r.id: r.vector for r in means.collect()}
    for k, v in texts.items():
        rows = [table[w] for w in v if w in table] + [[1.0, 2.0, 3.0, 4.0] for w in v if w == "w0"]
        assert got[k] == pytest.approx(np.mean(rows, axis=0) if rows else [0.0] * 4)
    assert got[None] == [0.0] * 4 and len(got) == len(texts) + 1
    plan = means._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_silhouette_blocks_follow_the_rows(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x, cluster = rng.normal(size=(90, 3)), rng.integers(0, 3, 90)
    x[60:70] = x[50:60]  # equal rows, some in other clusters
    df = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, cluster)], "v array<double>, c int")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    scores = []
    for i in range(len(x)):
        mean = {c: d[i, cluster == c].sum() / ((cluster == c).sum() - (c == cluster[i])) for c in range(3)}
        a, b = mean.pop(cluster[i]), min(mean.values())
        scores.append((b - a) / max(a, b))
    for rows in (None, 7, 1000):
        got = neighbours.silhouette(df, "v", "c", rows).first().silhouette
        assert got == pytest.approx(np.mean(scores), abs=1e-7)
    asked = []
    monkeypatch.setattr(neighbours.math, "ceil", lambda v: asked.append(v) or int(-(-v // 1)))
    wide = spark.range(40_000).select(F.array(F.col("id").cast("double")).alias("v"), F.lit(0).alias("c"))
    monkeypatch.setattr(neighbours, "BLOCKS", 4)
    neighbours.silhouette(wide, "v", "c")
    assert asked == [10_000, 4]  # four blocks of ten thousand rows, not ten of 4096


def test_silhouettes_of_several_clusterings(spark):
    """Each as if alone; a row without a cluster scores 0 and is no neighbour."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(80, 3))
    x[40:50] = x[30:40]
    a, b = [int(v) if v < 4 else None for v in rng.integers(0, 5, 80)], [int(v) * 7 - 3 for v in rng.integers(0, 3, 80)]
    df = spark.createDataFrame(
        [(v.tolist(), p, q, 1) for v, p, q in zip(x, a, b)], "v array<double>, a int, b int, c int"
    )
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))

    def mean(own):
        scores = []
        for i, c in enumerate(own):
            of = {k: [d[i, j] for j in range(80) if own[j] == k and j != i] for k in set(own) - {None}}
            within, rest = of.pop(c, []), [np.mean(v) for v in of.values()]
            if c is None or not within or not rest:
                scores.append(0.0)
            else:
                scores.append((min(rest) - np.mean(within)) / max(min(rest), np.mean(within)))
        return np.mean(scores)

    for block_rows in (None, 9):
        got = neighbours.silhouettes(df, "v", ["a", "b", "c"], block_rows).orderBy("place").collect()
        assert [r.place for r in got] == [0, 1, 2]
        assert [r.silhouette for r in got] == pytest.approx([mean(a), mean(b), 0.0], abs=1e-6)
    none = neighbours.silhouettes(df.limit(0), "v", ["a", "b"]).collect()
    assert [r.silhouette for r in none] == [None, None]
