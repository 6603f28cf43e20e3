import numpy as np
import pytest
from pyspark.sql import functions as F

from prosemill.functions import vectors as V
from prosemill.functions.text import tokenize_ws
from prosemill.operators import neighbours, terms
from prosemill.operators import vectors as O


def test_vector_columns(one):
    a, b = F.expr("array(3f, 4f)"), F.expr("array(4d, 3d)")
    assert one(V.cosine_distance(a, b)) == pytest.approx(0.04)
    assert one(V.cosine_distance(a, F.expr("array(0d, 0d)"))) == 1
    assert one(V.l2_normalize(a)) == pytest.approx([0.6, 0.8])
    assert one(V.l2_normalize(F.expr("array(0d, 0d)"))) == [0, 0]
    assert one(V.argmax_class(F.expr("array(.1, .7, .7)"))) == 1
    assert one(V.threshold_label(F.lit(0.5))) == 0
    assert one(V.pad_sequence(F.expr("array(1,2,3,4,5)"), 3)) == [3, 4, 5]
    assert one(V.pad_sequence(F.expr("array(1,2)"), 3)) == [1, 2, 0]
    assert one(V.pad_sequence(F.expr("cast(array() as array<int>)"), 2)) == [0, 0]


@pytest.fixture(scope="module")
def two_words(spark):
    return spark.createDataFrame([("a", [2.0, 0.0]), ("b", [0.0, 2.0])], "word string, vector array<double>")


def test_average_vector(spark, two_words):
    df = spark.createDataFrame([(1, "a b zzz"), (2, "zzz"), (3, ""), (4, "a a b b b b")], "id int, t string")
    got = O.avg_vector(df, "id", tokenize_ws(F.col("t")), two_words, 2).collect()
    assert {r.id: r.vector for r in got} == {
        1: [1, 1], 2: [0, 0], 3: [0, 0], 4: pytest.approx([4 / 6, 8 / 6])
    }


def test_matrix_and_missing(spark, two_words):
    docs = spark.createDataFrame([("b b a c",)], "t string")
    index = terms.token_index(docs, tokenize_ws(F.col("t")))
    assert [(r.word, r.token_id) for r in index.orderBy("token_id").collect()] == [("b", 1), ("a", 2), ("c", 3)]
    m = {r.token_id: r.vector for r in O.embedding_matrix(index, two_words, 2).collect()}
    assert m == {0: [0, 0], 1: [0, 2], 2: [2, 0], 3: [0, 0]}
    assert O.missing_vectors(index, two_words).first().missing == 1


def test_neighbour_lists(spark):
    v = spark.createDataFrame(
        [("q", [1.0, 0.0]), ("x", [2.0, 0.1]), ("y", [0.0, 1.0]), ("z", [0.0, 0.0])],
        "word string, vector array<double>",
    )
    assert [r.word for r in O.most_similar(v, "q", 2).collect()] == ["x", "y"]
    with pytest.raises(KeyError):
        O.most_similar(v, "none")
    swapped = v.withColumn("vector", F.reverse("vector"))
    report = O.similar_words_report({"one": v, "two": swapped}, "q", 1).collect()
    assert [r.word for r in report] == ["x"]
    d = O.model_pair_distance({"one": v, "two": swapped}, "q").first()
    assert (d.model_a, d.model_b, d.distance) == ("one", "two", 1.0)


def brute_knn(x, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    d = np.round(1 - u @ u.T, 9) + 0.0
    np.fill_diagonal(d, np.inf)
    return {i: [int(j) for j in np.lexsort((np.arange(len(x)), d[i]))[:k]] for i in range(len(x))}


@pytest.mark.parametrize("block_rows", [30, 4096])
def test_knn_is_exact_with_a_third_of_copies(spark, block_rows):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8)) * 3
    x = centres[rng.integers(0, 6, 300)] + rng.normal(size=(300, 8)) * 0.3
    x[:100] = x[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = neighbours.knn_graph(df, "id", "v", 7, block_rows=block_rows).orderBy("id", "rank").collect()
    lists = {}
    for r in got:
        lists.setdefault(r.id, []).append(r.nbr)
    assert lists == brute_knn(x, 7)


@pytest.mark.parametrize("block_rows", [25, 4096])
def test_silhouette_is_exact(spark, block_rows):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 3))
    c = rng.integers(0, 3, 120)
    c[0] = 9  # a cluster of one row scores 0
    x[40:90], c[40:90] = x[40], c[40]  # copies
    df = spark.createDataFrame(
        [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, c))], "id long, v array<double>, c int"
    )
    d = np.linalg.norm(x[:, None] - x[None], axis=2)
    want = []
    for i in range(len(x)):
        own = (c == c[i]) & (np.arange(len(x)) != i)
        if not own.any():
            want.append(0.0)
            continue
        a = d[i, own].mean()
        b = min(d[i, c == k].mean() for k in set(c) - {c[i]})
        want.append((b - a) / max(a, b))
    got = neighbours.silhouette(df, "v", "c", block_rows).first().silhouette
    assert got == pytest.approx(np.mean(want), abs=1e-9)


def test_a_neighbour_search_stores_a_vector_once(spark, monkeypatch):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(120)], "id long, v array<double>")
    stored, kept = [], neighbours.cut_lineage

    def keep(table):
        stored.append(kept(table))
        return stored[-1]

    monkeypatch.setattr(neighbours, "cut_lineage", keep)
    monkeypatch.setattr(neighbours, "KNN_BLOCKS", 6)
    monkeypatch.setattr(neighbours, "LEAST_BLOCK_ROWS", 1)
    in_blocks = neighbours.knn_graph(df, "id", "v", 5)
    assert sum(t.select("cell", "block").distinct().count() > 1 for t in stored if "block" in t.columns)
    assert all(t.count() <= 120 for t in stored if "vec" in t.columns)
    key = ["id", "rank", "nbr"]
    whole = neighbours.knn_graph(df, "id", "v", 5, block_rows=1000)
    assert in_blocks.select(key).orderBy(key).collect() == whole.select(key).orderBy(key).collect()
