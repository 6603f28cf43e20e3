import numpy as np
import pytest
from pyspark.sql import functions as F

from prosemill.operators import forests
from prosemill.operators.forests import Setting

SETTINGS = [
    Setting(), Setting("entropy"), Setting(featureSubsetStrategy="log2"), Setting(featureSubsetStrategy="all"),
    Setting(minInfoGain=0.05), Setting(bootstrap=False),
]


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, features array<double>, label int")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    label = rng.integers(0, 3, 300)
    x = np.round(rng.normal(size=(300, 5)) + 3 * np.eye(5)[label], 2)
    return x, label, table(spark, [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, label))])


def flat(forest):
    return [[a.tolist() for a in (t.node, t.feature, t.bin, t.left, t.counts)] for t in forest.trees]


def test_trees_do_not_depend_on_how_they_are_grown(data):
    _, _, df = data
    options = {"key": "id", "trees": 2, "depth": 4}
    want = [flat(f) for f in forests.fit(df, SETTINGS, **options)]
    for other in (
        {"node_rows": 0, "cells": 20_000}, {"node_rows": 60}, {"node_rows": 120, "copies": 500},
    ):
        got = forests.fit(df.repartition(7), SETTINGS, **options, **other)
        assert [flat(f) for f in got] == want, other


def brute_tree(x, y, w, thresholds, number, setting, shape):
    """node -> (feature, bin, counts), one node and one cut at a time."""
    bins = np.stack([np.searchsorted(t, x[:, i]) for i, t in enumerate(thresholds)], axis=1)
    out = {}

    def impurity(rows):
        p = np.bincount(y[rows], w[rows], shape.classes) / w[rows].sum()
        return 1 - (p**2).sum() if setting.impurity == "gini" else -sum(q * np.log2(q) for q in p if q > 0)

    def grow(node, rows, level):
        best = None
        if level < shape.depth:
            for f in forests._subsets(number, np.array([node]), setting, shape)[0]:
                for b in range(shape.bins):
                    right = bins[rows, f] > b
                    l, r = rows[~right], rows[right]
                    if len(l) and len(r):
                        share = w[l].sum() / w[rows].sum()
                        gain = impurity(rows) - share * impurity(l) - (1 - share) * impurity(r)
                        if best is None or gain > best[0] + 1e-10:
                            best = (gain, f, b, l, r)
        cut = best is not None and best[0] > 1e-12 and best[0] >= setting.minInfoGain
        out[node] = (best[1] if cut else -1, np.bincount(y[rows], w[rows], shape.classes).tolist())
        if cut:
            grow(2 * node + 1, best[3], level + 1)
            grow(2 * node + 2, best[4], level + 1)

    grow(0, np.flatnonzero(w > 0), 0)
    return out


def test_trees_equal_brute_force(data, spark):
    x, y, df = data
    ids = np.array([r.h for r in df.orderBy("id").select(F.xxhash64("id").alias("h")).collect()], np.int64)
    for forest in forests.fit(df, SETTINGS, key="id", trees=2, depth=3, bins=8):
        for number, tree in enumerate(forest.trees):
            w = forests._draws(ids, number, forest.setting, forest.shape.seed)
            want = brute_tree(x, y, w, forest.thresholds, number, forest.setting, forest.shape)
            assert sorted(want) == tree.node.tolist()
            for i, node in enumerate(tree.node.tolist()):
                assert want[node][1] == tree.counts[i].tolist()


def test_draws_and_subsets():
    w = forests._draws(np.arange(100_000), 5, Setting(), 1)
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03
    assert (forests._draws(np.arange(9), 5, Setting(bootstrap=False), 1) == 1).all()
    shape = forests.Shape(2, 10, 16, 8, 1)
    got = forests._subsets(0, np.arange(4000), Setting(), shape)
    assert got.shape == (4000, 4) and (np.diff(got, axis=1) > 0).all()
    assert np.allclose(np.bincount(got.ravel()) / 4000, 0.25, atol=0.03)
    assert [Setting(featureSubsetStrategy=s).subset(64) for s in ("auto", "sqrt", "log2", "all")] == [8, 8, 6, 64]


def test_scores(data, spark):
    x, y, df = data
    got = forests.fit(df.where("id % 4 > 0"), [*SETTINGS, Setting()], key="id", trees=20, depth=6)
    test = df.where("id % 4 = 0")
    share = forests.accuracies(got, test)
    assert min(share) > 0.85 and share[0] == share[-1]
    scored = got[0].transform(test)
    assert scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0] == pytest.approx(share[0])
    total = F.aggregate("probability", F.lit(0.0), lambda a, v: a + v)
    assert scored.where(F.abs(total - 1) > 1e-9).count() == 0
    assert forests.accuracies(got, test.where("false")) == [None] * 7


def test_odd_rows(spark):
    odd = table(spark, [
        (1, [1.0, float("nan")], 0), (2, [2.0, 1.0], 1), (3, None, 1), (4, [3.0, 0.0], None), (4, [3.0, 0.0], 1),
        (None, [1.0, 2.0], 0),
    ]).withColumn("bins", F.lit("clash")).withColumn("y", F.lit(7))
    for options in ({"key": "id"}, {}):
        forest, = forests.fit(odd, [Setting(bootstrap=False, featureSubsetStrategy="all")], trees=2, **options)
        got = forest.transform(odd).select("features", "label", "prediction").collect()
        assert all((r.prediction is None) == (r.features is None) for r in got)
        assert all(r.prediction == r.label for r in got if r.features is not None and r.label is not None)
    one, = forests.fit(odd.where("label = 1"), [Setting()], trees=2)
    assert all(len(t.node) == 1 for t in one.trees)
    with pytest.raises(ValueError):
        forests.fit(odd.where("false"), [Setting()])
    for bad in ({"impurity": "x"}, {"featureSubsetStrategy": "most"}):
        with pytest.raises(ValueError):
            Setting(**bad)
