import random

import pytest
from pyspark.sql import functions as F

from prosemill.operators.scaling import hot_keys, lookup_join, nth_smallest, with_position


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(1)
    rows = [(i, "hot" if rng.random() < 0.4 else f"k{rng.randrange(300)}") for i in range(4000)]
    rows += [(9000, None), (9001, "absent")]
    return spark.createDataFrame(rows, "id int, word string")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [("hot", 1)] + [(f"k{i}", i) for i in range(0, 300, 2)] + [("never", -1)], "word string, v int"
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(skewed, dim, how):
    plain = skewed.join(dim, "word", how).select("id", "word", *(["v"] if how in ("inner", "left") else []))
    for max_bytes in (0, 1 << 20):
        got = lookup_join(skewed, dim, "word", how, max_bytes=max_bytes, task_rows=200)
        assert sorted(map(str, got.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_hot_rows_are_spread(skewed, dim):
    hot = hot_keys(skewed, "word", 200).collect()
    n = skewed.where("word = 'hot'").count()
    assert [(r.word, r._salts) for r in hot] == [("hot", -(-n // 200))]
    joined = lookup_join(skewed, dim, "word", "inner", max_bytes=0, task_rows=200)
    assert "_salt" not in joined.columns


def test_no_rows_meet_in_one_task_to_check_a_size(skewed, dim, monkeypatch):
    plans = []
    agg = type(dim).agg
    monkeypatch.setattr(type(dim), "agg", lambda self, *a: plans.append(agg(self, *a)) or plans[-1])
    lookup_join(skewed, dim, "word", "inner")
    assert plans
    for p in plans:  # what reaches a single task is one partial sum of each task
        text = p._jdf.queryExecution().executedPlan().toString()
        assert "GlobalLimit" not in text and text.index("partial_sum") > text.index("SinglePartition")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_key_with_half_of_the_rows(spark, how):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("word"))
    dim = spark.createDataFrame([("hot", 1), ("3", 3)], "word string, v int")
    got = lookup_join(rows, dim, "word", how, max_bytes=0, task_rows=500)
    assert got.where("v = 1").count() == 10_000 and got.count() == (10_001 if how == "inner" else 20_000)


def test_small_side_is_broadcast_only_when_checked(spark, skewed, dim):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = lookup_join(skewed, dim, "word", "inner", max_bytes=1 << 20)
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        large = lookup_join(skewed, dim, "word", "inner", max_bytes=5)
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_positions(spark):
    rng = random.Random(2)
    values = [rng.randrange(50) for _ in range(3000)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, id int").repartition(7)
    got = with_position(df, [F.desc("v"), F.col("id")]).orderBy("position").collect()
    want = sorted(((v, i) for i, v in enumerate(values)), key=lambda t: (-t[0], t[1]))
    assert [(r.v, r.id) for r in got] == want
    assert [r.position for r in got] == list(range(3000))


@pytest.mark.parametrize("bins,few", [(4, 1), (16, 5), (4096, 10_000)])
def test_nth_smallest(spark, bins, few):
    rng = random.Random(3)
    whole = [rng.randrange(-500, 500) for _ in range(2000)] + [7] * 900
    real = [rng.gauss(0, 1) for _ in range(1500)] + [0.25] * 700
    for values, kind in ((whole, "v long"), (real, "v double")):
        df = spark.createDataFrame([(v,) for v in values], kind)
        ordered = sorted(values)
        for n in (1, 2, 700, len(values) // 2, len(values)):
            v, below, equal = nth_smallest(df, F.col("v"), n, bins=bins, few=few)
            assert v == ordered[n - 1]
            assert below == sum(x < v for x in values) and equal == values.count(v)
    assert nth_smallest(df, F.col("v"), len(real) + 1, bins=bins)[0] is None
