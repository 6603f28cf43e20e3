"""Features, classifiers, clusterings and word-vector training.

Iterative fits have no SQL for their numbers.  Their queries return what SQL can
say about them: which rows are in the test part, which words have vectors, and
whether a property of the result holds on every row.  Values are tested in tests/.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import Word2VecModel
from pyspark.sql import functions as F

from catalog.base import SQL_DOC_TERMS, doc_tokens, documents, query, r6, sql_hash, table
from catalog.corpus import SQL_COUNTS, SQL_CUT_TERMS
from prosemill.operators import embed, evaluate, features, models
from prosemill.operators.sampling import holdout_tail, train_test_split
from prosemill.operators.vectors import avg_vector as mean_vector
from prosemill.session import cut_lineage, scratch_path
from prosemill.sources import files


def items(spark, sf):
    """`embeddings` with an ML vector and the label as a number."""
    rows = features.as_vector(table(spark, sf, "embeddings", True), "embedding").drop("embedding")
    return rows.withColumn("label", F.col("label").cast("double"))


def item_split(spark, sf, test=0.25):
    rows = cut_lineage(train_test_split(items(spark, sf), "vec_id", test))
    return rows.where("split = 'train'").drop("split"), rows.where("split = 'test'").drop("split")


def rated_documents(spark, sf):
    """Documents with a quality label and sparse TF-IDF features, split 75/25."""
    rated = documents(spark, sf).join(
        table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label")),
        "doc_id",
    )
    weighted, _ = features.tfidf_features(rated, F.col("text"), min_df=0.01, max_df=0.85)
    rows = cut_lineage(train_test_split(weighted.select("doc_id", "label", "features"), "doc_id", 0.25))
    return rows.where("split = 'train'").drop("split"), rows.where("split = 'test'").drop("split")


def learned(model, train) -> bool:
    """Whether the model is right on more of its training rows than naming the commonest class would be."""
    counts = models.predict(model, train).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("label") == F.col("prediction")).cast("long")).alias("hits")
    )
    hits, most = counts.agg(F.sum("hits"), F.max("n")).first()
    return hits > most


def scored(model, train, test, key, classes):
    """Test rows, their label, whether the prediction is one of the classes, and whether the model learned."""
    return models.predict(model, test).select(
        key, F.col("label").cast("int").alias("label"),
        F.col("prediction").between(0, classes - 1).alias("known"), F.lit(learned(model, train)).alias("learned"),
    )


def sql_test_part(rows: str, key: str, share: float) -> str:
    """(key, label, known, learned) of the test part of `rows` (key, label)."""
    return f"""SELECT {key}, label, true AS known, true AS learned FROM (
      SELECT *, row_number() OVER (ORDER BY {sql_hash(key)}, {key}) AS place, count(*) OVER () AS n
      FROM ({rows})) WHERE place <= ceil({share} * n)"""


SQL_ITEM_TEST = sql_test_part("SELECT vec_id, label FROM embeddings", "vec_id", 0.25)
SQL_RATED = "SELECT doc_id, l.quality AS label FROM documents JOIN labels l USING (doc_id)"
SQL_WORDS = f"SELECT word, 100 AS places, true AS finite FROM ({SQL_COUNTS}) WHERE n >= 2"
SQL_EACH_ITEM = "SELECT vec_id, true AS {flag} FROM embeddings"


def sized(vectors):
    """(word, places, finite) of word vectors."""
    finite = F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < 1e6))
    return vectors.select("word", F.size("vector").alias("places"), finite.alias("finite"))


def shares(curve):
    """Whether each variance share is at least the one before it, and at most 1."""
    from pyspark.sql.window import Window

    last = F.lag("share").over(Window.orderBy("n"))  # one row per component
    return curve.select(
        "n", (F.col("share") >= F.coalesce(last, F.lit(0.0)) - 1e-9).alias("rising"),
        (F.col("share") <= 1 + 1e-6).alias("at_most_one"),
    )


# --- features ----------------------------------------------------------------------


@query(
    "tfidf_features",
    f"""WITH raw AS (
      SELECT doc_id, term, count(*) AS tf FROM ({SQL_DOC_TERMS}) GROUP BY ALL),
    v AS (SELECT doc_id, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w
          FROM raw JOIN ({SQL_CUT_TERMS}) USING (term)),
    per AS (SELECT doc_id, count(*) AS n, max(w) / sqrt(sum(w * w)) AS largest FROM v GROUP BY doc_id)
    SELECT doc_id, CAST(coalesce(n, 0) AS INTEGER) AS n_terms,
    CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS length,
    round(coalesce(largest, 0.0::DOUBLE), 6) AS largest
    FROM documents LEFT JOIN per USING (doc_id)""",
)
def tfidf_features(spark, sf):
    weighted, model = features.tfidf_features(documents(spark, sf), F.col("text"), min_df=0.01, max_df=0.85)
    # the stored form of a sparse vector: no place without a weight is made
    raw = F.unwrap_udt("features")
    length = F.aggregate(raw["values"], F.lit(0.0), lambda a, x: a + x * x)
    biggest = F.array_max(F.transform(raw["values"], lambda x: r6(x)))
    return weighted.select(
        "doc_id", F.size(raw["values"]).alias("n_terms"), r6(F.sqrt(length)).alias("length"),
        F.coalesce(biggest, F.lit(0.0)).alias("largest"),
    )


@query("label_encode", "SELECT p_partkey, p_type, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS code FROM part")
def label_encode(spark, sf):
    coded, _ = features.label_encode(table(spark, sf, "part").select("p_partkey", "p_type"), "p_type", "code")
    return coded


@query("label_decode", "SELECT p_partkey, p_type AS decoded FROM part")
def label_decode(spark, sf):
    coded, codes = features.label_encode(table(spark, sf, "part").select("p_partkey", "p_type"), "p_type", "code")
    return features.label_decode(coded.select("p_partkey", "code"), "code", "decoded", codes).select("p_partkey", "decoded")


@query(
    "label_onehot_variant",
    """SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS hot,
    (SELECT CAST(count(DISTINCT p_type) AS INTEGER) FROM part) AS places FROM part""",
)
def label_onehot_variant(spark, sf):
    from pyspark.ml.functions import vector_to_array

    coded, _ = features.label_encode(table(spark, sf, "part").select("p_partkey", "p_type"), "p_type", "code")
    hot = vector_to_array("hot")
    return models.one_hot(coded, "code", "hot").select(
        "p_partkey", (F.array_position(hot, 1.0) - 1).cast("int").alias("hot"), F.size(hot).alias("places")
    )


@query(
    "pca",
    """SELECT CAST(range AS INTEGER) AS component, true AS centred, true AS falling FROM range(0, 55)""",
)
def pca(spark, sf):
    from pyspark.ml.functions import vector_to_array

    reduced, _ = features.pca(items(spark, sf), "features", 55)
    p = vector_to_array("pca")
    stats = reduced.select(*[F.get(p, F.lit(i)).alias(f"p{i}") for i in range(55)]).agg(
        F.array(*[F.avg(f"p{i}") for i in range(55)]).alias("mean"),
        F.array(*[F.var_samp(f"p{i}") for i in range(55)]).alias("variance"),
    )
    return stats.select(F.posexplode("mean").alias("component", "mean"), "variance").select(
        "component", (F.abs("mean") < 1e-6).alias("centred"),
        (
            F.get("variance", F.col("component"))
            <= F.coalesce(F.get("variance", F.nullif(F.col("component"), F.lit(0)) - 1), F.lit(1e300)) + 1e-9
        ).alias("falling"),
    )


@query(
    "truncated_svd",
    "SELECT doc_id, 12 AS places, true AS at_most_one FROM documents",
)
def truncated_svd(spark, sf):
    weighted, _ = features.tfidf_features(documents(spark, sf), F.col("text"), min_df=0.01, max_df=0.85)
    reduced, _ = features.truncated_svd(weighted.select("doc_id", "features"), "features", 12)
    # a unit row keeps at most its length in fewer dimensions
    length = F.aggregate("svd", F.lit(0.0), lambda a, x: a + x * x)
    return reduced.select("doc_id", F.size("svd").alias("places"), (length <= 1 + 1e-6).alias("at_most_one"))


_CURVE = "SELECT CAST(range AS INTEGER) AS n, true AS rising, true AS at_most_one FROM range({lo}, {hi})"


@query("cumulative_variance", _CURVE.format(lo=1, hi=61))
def cumulative_variance(spark, sf):
    return shares(features.cumulative_variance(items(spark, sf).select("features"), "features", 60))


@query("sweep_components", "SELECT 2 AS first, true AS rising, true AS at_most_one")
def sweep_components(spark, sf):
    weighted, _ = features.tfidf_features(documents(spark, sf), F.col("text"), min_df=0.01, max_df=0.85)
    # up to 233 components; as many as the rank of the matrix are found
    curve = shares(features.cumulative_variance(weighted.select("features"), "features", 233)).where("n >= 2")
    return curve.agg(
        F.min("n").alias("first"), F.every("rising").alias("rising"), F.every("at_most_one").alias("at_most_one")
    )


def isolated(spark, sf):
    return models.isolation_forest(table(spark, sf, "embeddings", True), "vec_id", "embedding", 0.025)


@query("isolation_forest", SQL_EACH_ITEM.format(flag="scored"))
def isolation_forest(spark, sf):
    return isolated(spark, sf).select("vec_id", F.col("score").between(0, 1).alias("scored"))


@query(
    "outlier_list",
    "SELECT count(*) AS rows, CAST(round_even(0.025 * count(*), 0) AS BIGINT) AS outliers, 0::BIGINT AS unknown FROM embeddings",
)
def outlier_list(spark, sf):
    listed = models.outlier_list(isolated(spark, sf), "vec_id")
    items_ = table(spark, sf, "embeddings").select("vec_id")
    return items_.join(listed.withColumn("outlier", F.lit(True)), "vec_id", "full").agg(
        F.count(F.lit(1)).alias("rows"), F.count("outlier").alias("outliers"),
        F.count_if(F.col("vec_id").isNull()).alias("unknown"),
    )


# --- word vectors ---------------------------------------------------------------------


@query("word2vec_skipgram", SQL_WORDS)
def word2vec_skipgram(spark, sf):
    _, vectors = embed.word2vec_skipgram(documents(spark, sf), doc_tokens())
    return sized(vectors)


@query("word2vec_cbow", SQL_WORDS)
def word2vec_cbow(spark, sf):
    _, vectors = embed.word2vec_cbow(documents(spark, sf), doc_tokens())
    return sized(vectors)


@query("fasttext_skipgram", SQL_WORDS)
def fasttext_skipgram(spark, sf):
    _, vectors = embed.fasttext_skipgram(documents(spark, sf), doc_tokens())
    return sized(vectors)


@query("save_model", SQL_WORDS)
def save_model(spark, sf):
    model = embed.spark_skipgram(documents(spark, sf), doc_tokens())
    path = scratch_path(spark, "word2vec")
    files.save_model(model, path)
    table_path = scratch_path(spark, "word-vectors")
    files.save_vectors(embed.skipgram_vectors(files.load_model(Word2VecModel, path)), table_path)
    return sized(files.load_vectors(spark, table_path))


@query("load_model", SQL_EACH_ITEM.format(flag="as_before"))
def load_model(spark, sf):
    path = scratch_path(spark, "kmeans")
    model = models.kmeans(items(spark, sf), 9)
    files.save_model(model, path)
    both = model.transform(items(spark, sf)).withColumnRenamed("cluster", "before")
    loaded = files.load_model(KMeansModel, path)
    return models.assign_clusters(loaded, both).select("vec_id", (F.col("cluster") == F.col("before")).alias("as_before"))


# --- classifiers ------------------------------------------------------------------------


@query("logistic_regression", sql_test_part(SQL_RATED, "doc_id", 0.25))
def logistic_regression(spark, sf):
    train, test = rated_documents(spark, sf)
    return scored(models.logistic_regression(train), train, test, "doc_id", 2)


@query(
    "logreg_regularisation",
    """SELECT c::DOUBLE AS c, r::DOUBLE AS l1_ratio, true AS is_share
    FROM (VALUES (0.01), (0.5), (1.0)) AS c(c), (VALUES (0.0), (1.0)) AS r(r)""",
)
def logreg_regularisation(spark, sf):
    train, test = item_split(spark, sf)
    return models.regularisation_sweep(train, test).select(
        "c", "l1_ratio", F.col("accuracy").between(0, 1).alias("is_share")
    )


@query("random_forest", SQL_ITEM_TEST)
def random_forest(spark, sf):
    train, test = item_split(spark, sf)
    return scored(models.random_forest(train, trees=200, max_depth=10), train, test, "vec_id", 10)


@query(
    "random_forest_variants",
    """SELECT variant, true AS is_share, CASE WHEN variant = 'minInfoGain=0.01' THEN 'not asked' ELSE 'true' END AS learned FROM (VALUES ('impurity=gini'), ('impurity=entropy'),
    ('featureSubsetStrategy=log2'), ('featureSubsetStrategy=all'), ('featureSubsetStrategy=sqrt'),
    ('minInfoGain=0.01'), ('bootstrap=False')) AS v(variant)""",
)
def random_forest_variants(spark, sf):
    train, test = item_split(spark, sf)
    n, most = train.groupBy("label").count().agg(F.sum("count"), F.max("count")).first()
    return models.forest_variants(train, test, key="vec_id").select(
        "variant", F.col("accuracy").between(0, 1).alias("is_share"),
        # labels that do not depend on the vectors leave cuts of little gain only
        F.when(F.col("variant") == "minInfoGain=0.01", F.lit("not asked"))
        .otherwise((F.col("train_accuracy") > most / n).cast("string")).alias("learned"),
    )


@query("boosted_trees_multiclass", SQL_ITEM_TEST)
def boosted_trees_multiclass(spark, sf):
    train, test = item_split(spark, sf)
    return scored(models.boosted_trees_multiclass(train), train, test, "vec_id", 10)


@query("boosted_trees_binary", sql_test_part(SQL_RATED, "doc_id", 0.2))
def boosted_trees_binary(spark, sf):
    # average word vectors, centred PCA, boosted trees: the review classifier
    rated = documents(spark, sf).join(
        table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id"
    )
    _, vectors = embed.word2vec_skipgram(documents(spark, sf), doc_tokens())
    means = mean_vector(rated, "doc_id", doc_tokens(), vectors, 100)
    rows = cut_lineage(features.as_vector(means.join(rated.select("doc_id", "label"), "doc_id"), "vector"))
    reduced, _ = features.pca(rows.select("doc_id", "label", "features"), "features", 55)
    split = cut_lineage(train_test_split(
        reduced.select("doc_id", "label", F.col("pca").alias("features")), "doc_id", 0.2
    ))
    train = split.where("split = 'train'")
    return scored(models.boosted_trees_binary(train), train, split.where("split = 'test'"), "doc_id", 2)


@query("mlp_classifier", SQL_ITEM_TEST)
def mlp_classifier(spark, sf):
    train, test = item_split(spark, sf)
    return scored(models.mlp_classifier(train, max_iter=20), train, test, "vec_id", 10)


@query(
    "training_history",
    f"""SELECT model, CAST(e AS INTEGER) AS epoch, part, CAST(rows AS BIGINT) AS rows, true AS finite, true AS improves
    FROM (VALUES ('boosted trees', 10), ('net', 5)) AS m(model, epochs), range(0, 10) AS r(e),
      (SELECT CASE WHEN bucket >= 8000 THEN 'validation' ELSE 'train' END AS part, count(*) AS rows
       FROM (SELECT {sql_hash('vec_id', 43)} % 10000 AS bucket FROM embeddings) GROUP BY part)
    WHERE e < epochs""",
)
def training_history(spark, sf):
    """Loss and accuracy of training and held-out rows per epoch; `improves`: training loss fell in each epoch
    of the boosted trees, and from the first to the last epoch of the net."""
    from pyspark.sql.window import Window

    rows = cut_lineage(holdout_tail(items(spark, sf), "vec_id", 0.2))
    train, held = rows.where("NOT holdout"), rows.where("holdout")
    trees = models.boosted_trees_multiclass(train, rounds=10).history({"train": train, "validation": held})
    _, net = models.mlp_history(train, held)
    both = trees.withColumn("model", F.lit("boosted trees")).unionByName(net.withColumn("model", F.lit("net")))
    by_epoch = Window.partitionBy("model", "part").orderBy("epoch")  # a row per epoch
    whole = Window.partitionBy("model")
    step = F.col("loss") - F.lag("loss").over(by_epoch)
    total = F.col("loss") - F.first("loss").over(by_epoch)
    of_trees = F.max(F.when(F.col("part") == "train", F.col("step"))).over(whole) < 0
    of_net = F.min(F.when(F.col("part") == "train", F.col("total"))).over(whole) < 0
    return both.withColumn("step", step).withColumn("total", total).select(
        "model", "epoch", "part", "rows",
        (F.col("loss").between(0, 1e12) & F.col("accuracy").between(0, 1)).alias("finite"),
        F.when(F.col("model") == "net", of_net).otherwise(of_trees).alias("improves"),
    )


# --- clusterings --------------------------------------------------------------------------


@query("kmeans", SQL_EACH_ITEM.format(flag="nearest"))
def kmeans(spark, sf):
    from pyspark.ml.functions import vector_to_array

    model = models.kmeans(items(spark, sf), 9)
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    away = F.transform(
        centres,
        lambda c: F.aggregate(F.zip_with("v", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x),
    )
    rows = models.assign_clusters(model, items(spark, sf)).withColumn("v", vector_to_array("features"))
    return rows.withColumn("away", away).select(
        "vec_id", (F.get("away", F.col("cluster")) <= F.array_min("away") + 1e-9).alias("nearest")
    )


def reduced_items(spark, sf):
    """Five principal components of `embeddings`."""
    rows, _ = features.pca(items(spark, sf).select("vec_id", "features"), "features", 5)
    return rows.select("vec_id", F.col("pca").alias("features"))


@query("gaussian_mixture", SQL_EACH_ITEM.format(flag="likeliest"))
def gaussian_mixture(spark, sf):
    from pyspark.ml.functions import vector_to_array

    rows = reduced_items(spark, sf)
    labelled = models.assign_clusters(models.gaussian_mixture(rows, 9), rows)
    p = vector_to_array("probability")
    whole = F.abs(F.aggregate(p, F.lit(0.0), lambda a, x: a + x) - 1) < 1e-6
    return labelled.select("vec_id", ((F.get(p, F.col("cluster")) == F.array_max(p)) & whole).alias("likeliest"))


@query("cluster_centres", "SELECT CAST(range AS INTEGER) AS cluster, 5 AS places FROM range(0, 8)")
def cluster_centres(spark, sf):
    rows = reduced_items(spark, sf)
    centres = models.cluster_centres(models.gaussian_mixture(rows, 8), spark)
    return centres.select("cluster", F.size("centre").alias("places"))


def _finite(c):
    return (~F.isnan(c) & (F.abs(c) < 1e12)).alias("finite")


@query("gmm_bic", "SELECT 9 AS k, true AS finite")
def gmm_bic(spark, sf):
    rows = reduced_items(spark, sf)
    value = models.gmm_bic(models.gaussian_mixture(rows, 9), rows)
    return spark.createDataFrame([(9, float(value))], "k int, bic double").select("k", _finite(F.col("bic")))


@query("log_score", "SELECT o_orderkey, round(ln(o_totalprice), 6) AS log_price FROM orders")
def log_score(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", r6(models.log_score(F.col("o_totalprice"))).alias("log_price"))


@query("gmm_cv_likelihood", "SELECT 4 AS k, CAST(range AS INTEGER) AS fold, true AS finite FROM range(0, 5)")
def gmm_cv_likelihood(spark, sf):
    scores = models.gmm_cv_likelihood(reduced_items(spark, sf), "vec_id", 4)
    return scores.select("k", "fold", _finite(F.col("log_likelihood")))


@query("cv_median", "SELECT 4 AS k, true AS finite")
def cv_median(spark, sf):
    scores = models.gmm_cv_likelihood(reduced_items(spark, sf), "vec_id", 4)
    return models.cv_median(scores).select("k", _finite(F.col("cv_median")))


@query("sweep_k_gmm", "SELECT CAST(range AS INTEGER) AS k, true AS is_silhouette, true AS finite FROM range(2, 11)")
def sweep_k_gmm(spark, sf):
    sweep = models.sweep_k_gmm(reduced_items(spark, sf), "vec_id")
    return sweep.select(
        "k", F.col("silhouette").between(-1, 1).alias("is_silhouette"),
        _finite(F.col("cv_likelihood") + F.col("bic")),
    )


def swept(spark, sf):
    return models.sweep_k_kmeans(reduced_items(spark, sf), "vec_id", tuple(range(4, 13)))


@query("sweep_k_kmeans", "SELECT CAST(range AS INTEGER) AS k, true AS is_silhouette FROM range(4, 13)")
def sweep_k_kmeans(spark, sf):
    return swept(spark, sf).select("k", F.col("silhouette").between(-1, 1).alias("is_silhouette"))


@query(
    "pick_elbow",
    "SELECT CAST(range + 3 AS INTEGER) AS k, range > 1 AS has_gain, CAST(range AS INTEGER) AS place FROM range(1, 10)",
)
def pick_elbow(spark, sf):
    from pyspark.sql.window import Window

    ranked = evaluate.pick_elbow(swept(spark, sf))
    # the ranks in their own order are 1 to 9: no rank is missing or double
    ranks = Window.partitionBy(F.lit(1)).orderBy("k").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    listed = F.sort_array(F.collect_list("rank").over(ranks))
    return ranked.select(
        "k", F.col("gain").isNotNull().alias("has_gain"), F.get(listed, (F.col("k") - 4).cast("int")).alias("place")
    )
