import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from prosemill import dims
from prosemill.operators import sampling
from prosemill.operators import tables as O


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(2000).withColumn("rating", (F.col("id") % 3 == 0).cast("int"))


def test_labels(spark):
    df = spark.createDataFrame([(float(x),) for x in range(1, 6)], "overall double")
    kept = O.drop_neutral(df).withColumn("rating", O.binary_label(F.col("overall"))).collect()
    assert [(r.overall, r.rating) for r in kept] == [(1, 0), (2, 0), (4, 1), (5, 1)]


def test_category_groups(spark):
    cats = [(c,) for c in ["WELLNESS", "STYLE", "TECH", "POLITICS", "PARENTS", None]]
    df = spark.createDataFrame(cats, "category string")
    want = ["LIFESTYLE", "LIFESTYLE", "TECHNOLOGY", "POLITICS", "PARENTING", None]
    assert [r.category for r in O.group_categories(df, "category", dims.category_map()).collect()] == want
    table = spark.createDataFrame(list(dims.category_map().items()), "a string, b string")
    assert sorted(map(str, O.group_categories(df, "category", table).collect())) == sorted(
        map(str, O.group_categories(df, "category", dims.category_map()).collect())
    )


def test_exact_samples(rows):
    for n in (0, 1, 777, 2000, 5000):
        assert sampling.sample_n(rows, "id", n).count() == min(n, 2000)
    assert sampling.sample_fraction(rows, "id", 0.5).count() == 1000
    assert sampling.sample_fraction(rows, "id", 1.0).count() == 2000
    again = sampling.sample_n(rows.repartition(5), "id", 100)
    assert again.exceptAll(sampling.sample_n(rows, "id", 100)).count() == 0
    other = sampling.sample_n(rows, "id", 100, seed=7)
    assert other.exceptAll(sampling.sample_n(rows, "id", 100)).count() > 50


def test_split_and_folds(rows):
    split = sampling.train_test_split(rows, "id", 0.25)
    assert {r.split: r["count"] for r in split.groupBy("split").count().collect()} == {"test": 500, "train": 1500}
    folds = rows.withColumn("f", sampling.fold_of("id", 5)).groupBy("f").count().collect()
    assert sorted(r.f for r in folds) == list(range(5))
    held = sampling.holdout_tail(rows, "id").where("holdout").count()
    assert 330 < held < 470


def test_balance(rows):
    got = sampling.balance_classes(rows, "id", "rating", 300, 0.1).groupBy("rating").count().collect()
    assert {r.rating: r["count"] for r in got} == {0: 300, 1: 67}


def test_describe_matches_numpy(spark):
    rng = random.Random(5)
    data = [(rng.choice("abbbbbbb"), rng.gauss(0, 3)) for _ in range(900)]
    df = spark.createDataFrame(data, "k string, v double")
    for r in O.describe_by(df, "k", ["v"]).collect():
        v = np.array([x for k, x in data if k == r.k])
        assert r["count"] == len(v)
        got = [r["mean"], r["std"], r["min"], r["q25"], r["q50"], r["q75"], r["max"]]
        want = [v.mean(), statistics.stdev(v), v.min(), *np.percentile(v, [25, 50, 75]), v.max()]
        assert np.allclose(got, want)


def test_histogram(spark):
    df = spark.createDataFrame([(x,) for x in [0, 1, 1, 5, 10]], "n int")
    bins = O.length_histogram(df, "n", 5).collect()
    assert [r.n for r in bins] == [3, 0, 1, 0, 1]
    assert bins[0].lo == 0 and bins[-1].hi == 10
    assert sum(r.n for r in O.length_histogram(df.where("n = 1"), "n", 50).collect()) == 2


def test_unions_and_profile(spark):
    a = spark.createDataFrame([("x", 1)], "w string, n int")
    b = spark.createDataFrame([("x", 1), (None, 2)], "w string, n int")
    assert O.union_rows(a, b).count() == 3
    assert O.union_distinct(a, b).count() == 2
    p = {r.column: r for r in O.profile(b).collect()}
    assert (p["w"].rows, p["w"].non_null, p["w"]["distinct"]) == (2, 1, 1)
    assert O.avg_length(spark.createDataFrame([(2,), (3,)], "n int"), "n").first()[0] == 2
