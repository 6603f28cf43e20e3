import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from prosemill.functions.text import tokenize_ws
from prosemill.operators import embed, features, mixtures, models, terms
from prosemill.operators.sampling import train_test_split
from prosemill.session import cut_lineage


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    label = rng.integers(0, 3, 240)
    x = rng.normal(size=(240, 4)) + 6 * np.eye(4)[label]
    df = spark.createDataFrame(
        [(i, float(c), v.tolist()) for i, (c, v) in enumerate(zip(label, x))],
        "id long, label double, vec array<double>",
    )
    return features.as_vector(df, "vec").persist(), x


def test_tfidf_features_equal_relational(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice("ab cd ef gh ij kl mn the".split()) for _ in range(rng.randrange(9))))
            for i in range(60)]
    df = spark.createDataFrame(docs, "id int, t string")
    for low, high in ((0.1, 0.7), (2, 1.0)):
        weighted, model = features.tfidf_features(df, F.col("t"), min_df=low, max_df=high)
        vocabulary = model.stages[0].vocabulary
        got = {
            (r.id, vocabulary[int(j)]): v
            for r in weighted.select("id", "features").collect()
            for j, v in zip(r.features.indices, r.features.values)
        }
        want = {(r.id, r.term): r.tfidf
                for r in terms.tfidf(df, "id", F.col("t"), min_df=low, max_df=high).collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_svd_matches_numpy(blobs):
    df, x = blobs
    s, basis = features.svd_basis(df, "features", 3)
    u, want, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(s, want[:3])
    assert np.allclose(np.abs(basis.T @ vt[:3].T), np.eye(3), atol=1e-5)
    reduced, share = features.truncated_svd(df, "features", 2)
    got = np.array([r.svd for r in reduced.orderBy("id").collect()])
    assert np.allclose(np.abs(got), np.abs(x @ vt[:2].T), atol=1e-6)
    assert np.allclose(share, (x @ vt[:2].T).var(axis=0, ddof=1) / x.var(axis=0, ddof=1).sum())
    curve = [r.share for r in features.cumulative_variance(df, "features", 4).collect()]
    assert curve == sorted(curve) and curve[-1] == pytest.approx(1)


def test_pca_is_centred(blobs):
    df, x = blobs
    reduced, _ = features.pca(df, "features", 4)
    p = np.array([r.pca.toArray() for r in reduced.orderBy("id").collect()])
    assert np.allclose(p.mean(axis=0), 0, atol=1e-9)
    assert np.allclose((p**2).sum(axis=1), ((x - x.mean(axis=0)) ** 2).sum(axis=1))


def test_label_codes(spark):
    df = spark.createDataFrame([("pear",), ("apple",), ("fig",)], "c string")
    coded, indexer = features.label_encode(df, "c", "code")
    assert {r.c: r.code for r in coded.collect()} == {"apple": 0, "fig": 1, "pear": 2}
    back = features.label_decode(coded, "code", "back", indexer)
    assert back.where("c <> back").count() == 0
    assert {r.label: r.code for r in features.label_table(df, "c").collect()} == {"apple": 0, "fig": 1, "pear": 2}


@pytest.mark.parametrize("fit", [
    lambda d: models.logistic_regression(d),
    lambda d: models.random_forest(d, trees=10, max_depth=4),
    lambda d: models.boosted_trees_multiclass(d, rounds=2, depth=2),
    lambda d: models.mlp_classifier(d, hidden=(8,), max_iter=60),
])
def test_classifiers_beat_majority(blobs, fit):
    df, _ = blobs
    rows = train_test_split(df, "id", 0.25)
    model = fit(rows.where("split = 'train'"))
    got = models.predict(model, rows.where("split = 'test'"))
    assert got.count() == 60 and "split" in got.columns
    assert got.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] > 0.8


def test_binary_and_variants(blobs):
    df, _ = blobs
    two = df.withColumn("label", (F.col("label") > 0).cast("double"))
    got = models.predict(models.boosted_trees_binary(two, rounds=3, depth=2), two)
    assert got.where("label = prediction").count() > 220
    sweep = models.regularisation_sweep(df, df, cs=(0.01, 1.0), l1_ratios=(0.0,), max_iter=10)
    assert sweep.count() == 2
    assert models.forest_variants(df, df, trees=3, max_depth=3, variants=({"impurity": "entropy"}, {"bootstrap": False})).count() == 2
    history = models.training_history(models.logistic_regression(df)).orderBy("epoch").collect()
    assert history[-1].loss <= history[0].loss


def test_clusterings(blobs, spark):
    df, x = blobs
    labelled = models.assign_clusters(models.kmeans(df, 3), df)
    assert {r.cluster for r in labelled.select("cluster").distinct().collect()} == {0, 1, 2}
    assert models.silhouette_squared(labelled) > 0.7
    gmm = models.gaussian_mixture(df, 3)
    probability = models.assign_clusters(gmm, df).select(
        F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, v: a + v).alias("s"))
    assert probability.where("abs(s - 1) > 1e-6").count() == 0
    assert models.cluster_centres(gmm, spark).count() == 3
    ll = models.mean_log_likelihood(gmm, df)
    assert ll == pytest.approx(gmm.summary.logLikelihood / 240, rel=1e-3)
    assert models.gmm_bic(gmm, df) == pytest.approx(
        -2 * gmm.summary.logLikelihood + (2 + 3 * 4 + 3 * 10) * np.log(240))
    sweep = models.sweep_k_kmeans(df, "id", (2, 3, 4)).collect()
    assert max(sweep, key=lambda r: r.silhouette).k == 3
    both = models.sweep_k_gmm(df, "id", (2, 3), folds=2, metric="euclidean", max_iter=20).collect()
    assert [r.k for r in both] == [2, 3] and both[1].cv_likelihood > both[0].cv_likelihood


def test_mixtures_fitted_together(blobs, spark):
    """As Spark's own on clear groups, and the likelihood of the last scan is that of the rows."""
    df, x = blobs
    data = mixtures.prepared(df, "id", "features", 3)
    fits = mixtures.fit(data, [(k, f) for k in (1, 3) for f in (mixtures.WHOLE, 0, 1, 2)])
    one = fits[1, mixtures.WHOLE]
    assert one.settled and np.allclose(one.means[0], x.mean(axis=0)) and np.allclose(one.covs[0], np.cov(x.T, bias=True), atol=1e-4)
    three, spark_three = fits[3, mixtures.WHOLE], models.gaussian_mixture(df, 3)
    assert three.log_likelihood > spark_three.summary.logLikelihood - 1  # theirs may end in a lesser optimum
    label = np.array([r.label for r in df.orderBy("id").collect()]).astype(int)
    for c in range(3):  # the groups lie far apart: a component has the moments of one
        j = int(np.argmin(((three.means - x[label == c].mean(axis=0)) ** 2).sum(axis=1)))
        assert np.allclose(three.means[j], x[label == c].mean(axis=0), atol=0.1)
        assert np.allclose(three.covs[j], np.cov(x[label == c].T, bias=True), atol=0.2)
    assert three.bic() == pytest.approx(-2 * three.log_likelihood + (2 + 3 * 4 + 3 * 10) * np.log(240))
    fold = {r.id: r.fold for r in data.collect()}
    held = mixtures.held_out(data, fits)
    assert set(held) == {(k, f) for k in (1, 3) for f in range(3)}
    for (k, f), mean in held.items():
        rows = x[[fold[i] == f for i in range(len(x))]]
        assert mean == pytest.approx(mixtures._top_sum(fits[k, f].logs(rows)).mean())
    labels = mixtures.clusters(data, "id", fits).collect()
    assert len({(r.k3, int(np.argmax(x[r.id] // 3 * 3))) for r in labels}) >= 3 and {r.k1 for r in labels} == {0}


def test_a_fold_is_not_seen_by_its_fit(blobs, spark):
    df, x = blobs
    data = mixtures.prepared(df, "id", "features", 3)
    moved = cut_lineage(data.withColumn("x", F.when(F.col("fold") == 1, F.transform("x", lambda v: v * 100)).otherwise(F.col("x"))))
    a, b = (mixtures.fit(d, [(2, 1)], max_iter=5)[2, 1] for d in (data, moved))
    assert np.allclose(a.means, b.means) and np.allclose(a.covs, b.covs) and a.rows == b.rows
    assert mixtures.fit(data.limit(0), [(2, 1)]) == {}
    flat = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], "id long, vec array<double>")
    got = models.sweep_k_gmm(features.as_vector(flat, "vec"), "id", (2,), folds=2, metric="squaredEuclidean")
    assert got.first().cv_likelihood > 0  # equal rows: one narrow group


def test_scans_of_mixtures_in_slices(monkeypatch):
    """Densities and sums of a task's rows, by their definition, however many rows are held at once."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    x, fold = rng.normal(size=(60, 3)) + 50, rng.integers(0, 3, 60).astype(np.int32)
    fits = {(k, f): mixtures._start(x, k, np.random.default_rng(k)) for k in (1, 3) for f in (mixtures.WHOLE, 1)}
    batch = pa.RecordBatch.from_arrays([pa.array(fold), pa.array(x.tolist(), pa.list_(pa.float64()))], ["fold", "x"])
    for held in (1 << 19, 100):
        monkeypatch.setattr(mixtures, "HELD", held)
        got = {(r["k"], r["fold"], r["component"]): r["sums"] for r in next(mixtures._scan(fits)([batch])).to_pylist()}
        for (k, f), m in fits.items():
            own = x[fold != f]
            p = np.stack([
                w * np.exp(-0.5 * np.einsum("ni,ij,nj->n", own - mu, np.linalg.inv(c), own - mu))
                / np.sqrt(np.linalg.det(2 * np.pi * c)) for w, mu, c in zip(m.weights, m.means, m.covs)
            ], axis=1)
            assert np.allclose(m.logs(own), np.log(p))
            assert got[k, f, -1] == pytest.approx([len(own), np.log(p.sum(axis=1)).sum()])
            r = p / p.sum(axis=1, keepdims=True)
            for j in range(k):
                want = [r[:, j].sum(), *(r[:, j] @ own), *np.einsum("n,ni,nj->ij", r[:, j], own, own).ravel()]
                assert got[k, f, j] == pytest.approx(want)


def test_a_sweep_takes_the_distances_once(blobs, monkeypatch):
    df, _ = blobs
    asked, exact = [], models.exact_silhouettes
    monkeypatch.setattr(models, "exact_silhouettes", lambda *a: asked.append(a[2]) or exact(*a))
    alone = [models.sweep_k_kmeans(df, "id", (k,)).first().silhouette for k in (2, 3)]
    assert asked == [["k2"], ["k3"]]
    asked.clear()
    both = [r.silhouette for r in models.sweep_k_kmeans(df, "id", (2, 3)).collect()]
    assert asked == [["k2", "k3"]] and both == pytest.approx(alone)
    whole = df.withColumn("one", F.lit(0)).withColumn("two", (F.col("label") > 0).cast("int"))
    for metric in ("euclidean", "squaredEuclidean"):
        got = models._silhouettes(whole, "features", ["one", "two"], metric)
        assert np.isnan(got["one"]) and 0 < got["two"] < 1
    asked.clear()
    models.sweep_k_gmm(df, "id", (2, 3), folds=2, max_iter=2)
    assert len(asked) == 1


def test_isolation_forest_finds_planted_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    x[:10] += 12
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = models.isolation_forest(df, "id", "v", 0.025, trees=40)
    assert got.where("outlier").count() == 10
    assert {r.id for r in models.outlier_list(got, "id").collect()} == set(range(10))
    assert got.where("score <= 0 or score >= 1").count() == 0


@pytest.fixture(scope="module")
def sentences(spark):
    rng = random.Random(8)
    topics = [["red", "green", "blue", "pink"], ["cat", "dog", "cow", "pig"]]
    rows = [(i, [rng.choice(topics[i % 2]) for _ in range(12)]) for i in range(600)] + [(601, ["once"]), (602, [])]
    return spark.createDataFrame(rows, "id int, tokens array<string>")


def cosine(v, a, b):
    return float(v[a] @ v[b] / np.linalg.norm(v[a]) / np.linalg.norm(v[b]))


TRAINERS = {"cbow": embed.word2vec_cbow, "skipgram": embed.word2vec_skipgram, "fasttext": embed.fasttext_skipgram}


@pytest.mark.parametrize("kind", TRAINERS)
def test_trained_words_group_by_topic(spark, sentences, kind):
    """The nearest words of each word are those of its topic, after the default five epochs."""
    model, table = TRAINERS[kind](sentences, F.col("tokens"), dim=16, steps=2)
    v = {r.word: np.array(r.vector) for r in table.collect()}
    topics = [{"red", "green", "blue", "pink"}, {"cat", "dog", "cow", "pig"}]
    assert set(v) == topics[0] | topics[1]
    for topic in topics:
        for word in topic:
            nearest = sorted(v, key=lambda w: -cosine(v, word, w))[1:4]
            assert set(nearest) == topic - {word}
    unseen = {r.word: np.array(r.vector) for r in model.vectors(
        spark.createDataFrame([("greens",), (None,), ("xyz",), ("red",)], "word string")).collect()}
    assert set(unseen) == ({"greens", "red"} if kind == "fasttext" else {"red"})
    assert np.allclose(unseen["red"], v["red"], atol=1e-6)
    if kind == "fasttext":
        v["greens"] = unseen["greens"]
        assert cosine(v, "greens", "green") > cosine(v, "greens", "dog")


@pytest.mark.parametrize("kind", TRAINERS)
def test_parts_do_not_change_the_vectors(spark, sentences, kind, monkeypatch):
    def trained():
        _, table = TRAINERS[kind](sentences.repartition(3), F.col("tokens"), dim=4, epochs=2, steps=2)
        return {r.word: np.array(r.vector) for r in table.collect()}

    one = trained()
    monkeypatch.setattr(embed, "PART_TOKENS", 300)
    several = trained()
    assert all(np.allclose(one[w], several[w], atol=1e-3) for w in one)


@pytest.mark.parametrize("kind", TRAINERS)
def test_waves_do_not_change_the_vectors(spark, sentences, kind, monkeypatch):
    """Parts and blocks in waves give the vectors of one wave, and leave no table of a wave."""
    from pathlib import Path

    from prosemill.session import shared_dir

    monkeypatch.setattr(embed, "PART_TOKENS", 300)
    monkeypatch.setattr(embed, "BLOCK_LINKS", 30)
    monkeypatch.setattr(embed, "CORE_BYTES", 1)

    def trained(wave):
        monkeypatch.setattr(embed, "WAVE_BYTES", wave)
        before = set(Path(shared_dir(spark)).glob("stored-*"))
        _, table = TRAINERS[kind](sentences.repartition(3), F.col("tokens"), dim=4, epochs=2, steps=2)
        left = set(Path(shared_dir(spark)).glob("stored-*")) - before
        return {r.word: np.array(r.vector) for r in table.collect()}, len(left)

    asked, spans = [], embed._spans
    monkeypatch.setattr(embed, "_spans", lambda *a: asked.append(spans(*a)) or asked[-1])
    one, left = trained(1 << 20)
    assert all(len(s) == 1 for s in asked)
    asked.clear()
    several, left_of_several = trained(1000)
    assert all(1 < len(s) and [lo for lo, _ in s[1:]] == [hi for _, hi in s[:-1]] for s in asked)
    assert all(np.allclose(one[w], several[w], atol=1e-3) for w in one) and one.keys() == several.keys()
    # of the last means of units, a table for each wave is there to be read
    assert left_of_several == left + (len(asked[-1]) if kind == "fasttext" else 0)


@pytest.mark.parametrize("cbow", [True, False])
def test_piece_gradient(cbow):
    """The gradient of the piece's objective, by small differences."""
    rng = np.random.default_rng(1)
    e, c, noise = (rng.normal(size=(n, 3)) for n in (9, 9, 4))
    first, end, window, negatives = 2, 7, 3, 5

    def objective(e, c, noise):
        total = 0.0
        log = lambda x: -np.log1p(np.exp(-x))
        for i in range(first, end):
            shares = {j: (window + 1 - abs(i - j)) / window for j in range(9) if 0 < abs(i - j) <= window}
            if cbow:
                hidden = sum(w * e[j] for j, w in shares.items()) / sum(shares.values())
                total += log(hidden @ c[i]) + negatives * np.mean(log(-(noise @ hidden)))
            else:
                total += sum(w * log(e[i] @ c[j]) for j, w in shares.items())
                total += negatives * sum(shares.values()) * np.mean(log(-(noise @ e[i])))
        return total

    got = embed.piece_gradient(e, c, first, end, noise, window, cbow, negatives)
    for which, g in enumerate(got):
        for at in np.ndindex(g.shape):
            moved = []
            for eps in (1e-5, -1e-5):
                args = [e.copy(), c.copy(), noise.copy()]
                args[which][at] += eps
                moved.append(objective(*args))
            assert g[at] == pytest.approx((moved[0] - moved[1]) / 2e-5, abs=1e-5)


def test_ngrams_have_rows_of_their_own(spark, sentences, tmp_path):
    model, table = embed.fasttext_skipgram(sentences, F.col("tokens"), dim=4, epochs=1, steps=1)
    assert model.units.count() == model.units.select("id").distinct().count() == model.units.select("unit").distinct().count()
    grams = spark.createDataFrame([("abab",), ("a",), ("",)], "w string").select(embed.ngrams(F.col("w"), 3, 4).alias("g"))
    assert [r.g for r in grams.collect()] == [["<ab", "aba", "bab", "ab>", "<aba", "abab", "bab>"], ["<a>"], []]
    model.save(str(tmp_path / "m"))
    again = embed.VectorModel.load(spark, str(tmp_path / "m"))
    a = {r.word: r.vector for r in table.collect()}
    b = {r.word: r.vector for r in again.vectors(table).collect()}
    assert a.keys() == b.keys() and all(np.allclose(a[w], b[w]) for w in a)


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    """Pieces hold every token once, and its window; nothing to learn from is no error."""
    rng = random.Random(3)
    rows = [([rng.choice("abcdefg") for _ in range(n)],) for n in (100, 7, 1, 0)] + [(None,)]
    df = spark.createDataFrame(rows, "tokens array<string>")
    monkeypatch.setattr(embed, "PIECE", 16)
    words = embed.vocabulary(df, F.col("tokens"), 2)
    pieces, _ = embed.pieces_of(df, F.col("tokens"), words, 3, 2, 4)
    assert sum(r.n for r in pieces.collect()) == 107
    assert all(r.n <= 16 and len(r.ids) <= 16 + 6 and r.first <= 3 for r in pieces.collect())
    _, none = embed.word2vec_cbow(df.limit(0), F.col("tokens"), dim=4)
    assert none.count() == 0


@pytest.mark.parametrize("kind", TRAINERS)
def test_steps_give_up_the_tables_of_the_steps_before(spark, sentences, kind):
    from pathlib import Path

    from prosemill.session import shared_dir

    def left(epochs):
        before = set(Path(shared_dir(spark)).glob("stored-*"))
        TRAINERS[kind](sentences, F.col("tokens"), dim=4, epochs=epochs, steps=1)
        return len(set(Path(shared_dir(spark)).glob("stored-*")) - before)

    assert left(3) == left(1)


def test_the_trainer_of_spark_has_a_part_for_every_so_many_tokens(spark, monkeypatch):
    sentences = spark.createDataFrame([(f"a b c d{i % 5}",) for i in range(50)], "t string").select(F.split("t", " ").alias("tokens"))
    assert embed.spark_skipgram(sentences, F.col("tokens"), dim=4).getNumPartitions() == 1
    monkeypatch.setattr(embed, "TASK_TOKENS", 60)
    model = embed.spark_skipgram(sentences, F.col("tokens"), dim=4)
    assert model.getNumPartitions() == 4
    assert embed.skipgram_vectors(model).count() == 8


def test_the_trainer_of_spark_makes_the_tokens_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def tokens(text):
        made.add(1)
        return text.split()

    texts = spark.createDataFrame([(f"a b c d{i % 5}",) for i in range(50)], "t string")
    assert embed.skipgram_vectors(embed.spark_skipgram(texts, tokens("t"), dim=4)).count() == 8
    assert made.value == 50


def test_units_travel_once_to_a_block_of_words(spark, monkeypatch):
    """A unit has one row for a block that has it, however many of its words; sums are right both ways."""
    rng = random.Random(5)
    of = {w: {u: rng.randint(1, 3) for u in rng.sample(range(100, 130), 6)} for w in range(40)}
    parts = spark.createDataFrame([(w, u, n) for w in of for u, n in of[w].items()], "id long, unit_id long, times long")
    monkeypatch.setattr(embed, "BLOCK_LINKS", 60)
    links = embed._links(parts, 1)
    assert links.blocks == 4
    block = {r.id: r.block for r in links.words.collect()}
    needs = [(r.block, r.id) for r in links.needs.collect()]
    assert sorted(needs) == sorted({(block[w], u) for w in of for u in of[w]}) and len(needs) < 240
    h = {u: np.array([u, 1.0], np.float32) for u in range(100, 130)}
    ins = spark.createDataFrame([(u, h[u].tobytes()) for u in h], "id long, h binary")
    whole = {w: sum(of[w].values()) for w in of}
    for schema in ("id long, h binary", "id long, h array<double>"):
        got = embed._composed(links, ins, 2, schema).collect()
        assert len(got) == len(of)
        for r in got:
            row = np.frombuffer(r.h, np.float32) if "binary" in schema else np.array(r.h)
            assert np.allclose(row, sum(n * h[u] for u, n in of[r.id].items()) / whole[r.id], rtol=1e-5)
    moved = {w: np.array([1.0, w], np.float32) for w in of if w % 3}  # some words have no gradient, others two
    grads = spark.createDataFrame(
        [(embed.INPUT, w, salt, moved[w].tobytes(), 1.0) for w in moved for salt in range(1 + w % 2)], embed.ADDENDS
    )
    got = embed._unit_gradients(links, grads, 2).collect()
    assert len(got) == len({(r.salt, r.id) for r in got})
    for u in h:
        want = sum((moved[w] * (1 + w % 2) * of[w][u] / whole[w] for w in moved if u in of[w]), np.zeros(2))
        assert np.allclose(sum((np.frombuffer(r.row, np.float32) for r in got if r.id == u), np.zeros(2)), want, rtol=1e-4)
