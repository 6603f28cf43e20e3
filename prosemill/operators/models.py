"""Classifiers, clusterings and their scores, on Spark ML."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import (
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prosemill.operators import boosting, forests, mixtures
from prosemill.operators.neighbours import silhouettes as exact_silhouettes
from prosemill.operators.scaling import nth_smallest
from prosemill.session import cut_lineage

# --- classifiers: (train, label, features) -> fitted model -------------------


def logistic_regression(
    train: DataFrame, label: str = "label", features: str = "features",
    max_iter: int = 50, c: float | None = 1.0, l1_ratio: float = 0.0,
):
    """Multinomial logistic regression; `c` is the inverse penalty strength."""
    reg = 0.0 if c is None else 1.0 / (c * max(train.count(), 1))
    return LogisticRegression(
        family="multinomial", maxIter=max_iter, regParam=reg, elasticNetParam=l1_ratio,
        standardization=False,
        labelCol=label, featuresCol=features,
    ).fit(train)


def random_forest(
    train: DataFrame, label: str = "label", features: str = "features", trees: int = 200,
    max_depth: int = 10, seed: int = 42, **variant,
):
    """Random forest; `variant` takes impurity, featureSubsetStrategy, minInfoGain, bootstrap."""
    return RandomForestClassifier(
        numTrees=trees, maxDepth=max_depth, seed=seed, labelCol=label, featuresCol=features,
        cacheNodeIds=False, **variant,
    ).fit(train)


def boosted_trees_binary(
    train: DataFrame, label: str = "label", features: str = "features",
    rounds: int = 100, depth: int = 6, step: float = 0.3, **options,
):
    """Boosted trees of a 0/1 label."""
    return boosting.fit(train, label, features, 2, rounds, depth, step, **options)


def boosted_trees_multiclass(
    train: DataFrame, label: str = "label", features: str = "features",
    rounds: int = 100, depth: int = 6, step: float = 0.3, **options,
):
    """Softmax boosting: a tree per class and round, all classes grown in the same scans."""
    return boosting.fit(train, label, features, None, rounds, depth, step, **options)


def mlp_classifier(
    train: DataFrame, label: str = "label", features: str = "features",
    hidden: Sequence[int] = (64, 32), max_iter: int = 20, block: int = 128, seed: int = 42, start=None,
):
    """Feed-forward net: inputs, hidden layers, one output per class; `start` are weights to go on from."""
    inputs = train.select(features).first()[0].size
    classes = int(train.agg(F.max(label)).first()[0]) + 1
    return MultilayerPerceptronClassifier(
        layers=[inputs, *hidden, classes], maxIter=max_iter, blockSize=block, seed=seed,
        labelCol=label, featuresCol=features, initialWeights=start,
    ).fit(train)


def _log_loss_and_accuracy(model, df: DataFrame, label: str) -> tuple[int, float, float]:
    """Rows, mean log loss and accuracy, in one pass."""
    truth = F.col(label).cast("int")
    p = F.coalesce(F.get(vector_to_array("probability"), truth), F.lit(0.0))
    return tuple(model.transform(df).agg(
        F.count(F.lit(1)), F.avg(-F.log(F.greatest(p, F.lit(1e-300)))),
        F.avg((F.col("prediction") == truth).cast("double")),
    ).first())


def mlp_history(
    train: DataFrame, validation: DataFrame, label: str = "label", features: str = "features", epochs: int = 5,
    steps: int = 10, **options,
):
    """(model, history): a net fitted epoch by epoch, each of `steps` steps from the weights of the last one.

    The history has (epoch, part, rows, loss, accuracy) of the training and the validation rows.
    """
    model, rows = None, []
    for epoch in range(epochs):
        start = None if model is None else model.weights
        model = mlp_classifier(train, label, features, max_iter=steps, start=start, **options)
        for part, df in (("train", train), ("validation", validation)):
            rows.append((epoch, part, *_log_loss_and_accuracy(model, df, label)))
    schema = "epoch int, part string, rows long, loss double, accuracy double"
    return model, train.sparkSession.createDataFrame(rows, schema)


def one_hot(df: DataFrame, code: str, out: str) -> DataFrame:
    """The label number as a 0/1 vector with one place per class."""
    return OneHotEncoder(inputCol=code, outputCol=out, dropLast=False).fit(df).transform(df)


def predict(model, test: DataFrame, out: str = "prediction") -> DataFrame:
    """Test rows with an integer prediction; all other columns travel along."""
    rows = model.transform(test)
    extra = [c for c in rows.columns if c not in test.columns and c != "prediction"]
    return rows.drop(*extra).withColumn(out, F.col("prediction").cast("int"))


def training_history(model) -> DataFrame:
    """(epoch, loss) of a fitted model that records its objective."""
    from pyspark.sql import SparkSession

    history = model.summary.objectiveHistory
    rows = [(i, float(x)) for i, x in enumerate(history)]
    return SparkSession.active().createDataFrame(rows, "epoch int, loss double")


def regularisation_sweep(
    train: DataFrame, test: DataFrame, label: str = "label", features: str = "features",
    cs: Sequence[float] = (0.01, 0.5, 1.0), l1_ratios: Sequence[float] = (0.0, 1.0),
    max_iter: int = 50,
) -> DataFrame:
    """(c, l1_ratio, accuracy) of logistic regression over a grid."""
    rows = []
    for c in cs:
        for r in l1_ratios:
            model = logistic_regression(train, label, features, max_iter, c, r)
            got = predict(model, test).agg(
                F.avg((F.col(label) == F.col("prediction")).cast("double"))
            ).first()[0]
            rows.append((float(c), float(r), got))
    return train.sparkSession.createDataFrame(rows, "c double, l1_ratio double, accuracy double")


def forest_variants(
    train: DataFrame, test: DataFrame, label: str = "label", features: str = "features",
    trees: int = 200, max_depth: int = 10, variants: Sequence[dict] = (
        {"impurity": "gini"}, {"impurity": "entropy"},
        {"featureSubsetStrategy": "log2"}, {"featureSubsetStrategy": "all"},
        {"featureSubsetStrategy": "sqrt"}, {"minInfoGain": 0.01}, {"bootstrap": False},
    ), **options,
) -> DataFrame:
    """(variant, accuracy, train_accuracy) of random forests with other settings, all grown together."""
    grown = forests.fit(
        train, [forests.Setting(**v) for v in variants], label, features, trees=trees, depth=max_depth, **options
    )
    names = [", ".join(f"{k}={x}" for k, x in v.items()) for v in variants]
    rows = list(zip(names, forests.accuracies(grown, test), forests.accuracies(grown, train)))
    return train.sparkSession.createDataFrame(rows, "variant string, accuracy double, train_accuracy double")


# --- clusterings -------------------------------------------------------------


def kmeans(df: DataFrame, k: int, features: str = "features", seed: int = 42, max_iter: int = 50):
    return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=features, predictionCol="cluster").fit(df)


def gaussian_mixture(
    df: DataFrame, k: int, features: str = "features", seed: int = 42, max_iter: int = 100,
    tol: float = 1e-3,
):
    return GaussianMixture(
        k=k, seed=seed, maxIter=max_iter, tol=tol, featuresCol=features, predictionCol="cluster",
        probabilityCol="probability",
    ).fit(df)


def assign_clusters(model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def cluster_centres(model, spark) -> DataFrame:
    """(cluster, centre array<double>) of a K-means or mixture model."""
    if hasattr(model, "clusterCenters"):
        centres = [c.tolist() for c in model.clusterCenters()]
    else:
        centres = [g.mean.toArray().tolist() for g in model.gaussians]
    return spark.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(centres)],
        "cluster int, centre array<double>",
    )


def silhouette_squared(df: DataFrame, features: str = "features", cluster: str = "cluster") -> float:
    """Mean squared-Euclidean silhouette: one pass over cluster sums, any size."""
    return ClusteringEvaluator(
        featuresCol=features, predictionCol=cluster, metricName="silhouette"
    ).evaluate(df)


def gmm_bic(model, df: DataFrame) -> float:
    """-2 ln L + p ln n with p = (k-1) + k d + k d (d+1)/2."""
    k = len(model.weights)
    d = model.gaussians[0].mean.size
    p = (k - 1) + k * d + k * d * (d + 1) / 2
    n = df.count()
    return -2 * model.summary.logLikelihood + p * float(np.log(n))


def log_score(c):
    """Natural logarithm of a score column."""
    return F.log(c)


def mean_log_likelihood(model, df: DataFrame, features: str = "features") -> float:
    """Mean over rows of ln sum_j w_j N(x; mean_j, cov_j)."""
    weights = np.array(model.weights)
    parts = []
    for g in model.gaussians:
        cov = g.cov.toArray()
        values, vectors = np.linalg.eigh((cov + cov.T) / 2)
        values = np.maximum(values, 1e-9)
        parts.append(
            (g.mean.toArray(), vectors / np.sqrt(values),
             -0.5 * (len(values) * np.log(2 * np.pi) + np.log(values).sum()))
        )

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="float64")
        m = np.stack(x.to_numpy())
        logs = np.stack(
            [np.log(w + 1e-300) + c - 0.5 * (((m - mu) @ root) ** 2).sum(axis=1)
             for w, (mu, root, c) in zip(weights, parts)], axis=1)
        top = logs.max(axis=1)
        return pd.Series(top + np.log(np.exp(logs - top[:, None]).sum(axis=1)))

    return df.select(score(vector_to_array(features)).alias("s")).agg(F.avg("s")).first()[0]


def gmm_cv_likelihood(
    df: DataFrame, id_col: str, k: int, features: str = "features", folds: int = 5, **options
) -> DataFrame:
    """(k, fold, log_likelihood): held-out mean log-likelihood of each fold; the folds are fitted together."""
    data = mixtures.prepared(df, id_col, features, folds)
    scores = mixtures.held_out(data, mixtures.fit(data, [(k, f) for f in range(folds)], **options))
    rows = [(k, f, float(x)) for (_, f), x in sorted(scores.items())]
    return df.sparkSession.createDataFrame(rows, "k int, fold int, log_likelihood double")


def cv_median(scores: DataFrame) -> DataFrame:
    """(k, cv_median): the median fold score of each k (five rows per k)."""
    return scores.groupBy("k").agg(F.percentile("log_likelihood", 0.5).alias("cv_median"))


def _silhouettes(df: DataFrame, features: str, clusters: Sequence[str], metric: str) -> dict[str, float]:
    """The silhouette of each clustering, NaN where all rows are in one cluster; exact ones share the distances."""
    if not clusters:
        return {}
    ends = df.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in clusters for f in (F.min, F.max)]).first()
    open_ = [c for c in clusters if ends[f"min_{c}"] != ends[f"max_{c}"]]
    out = dict.fromkeys(clusters, float("nan"))
    if metric == "squaredEuclidean":
        return out | {c: silhouette_squared(df, features, c) for c in open_}
    if open_:
        rows = df.select(vector_to_array(features).alias("vec"), *open_)
        out |= {open_[r.place]: r.silhouette for r in exact_silhouettes(rows, "vec", open_).collect()}
    return out


def sweep_k_gmm(
    df: DataFrame, id_col: str, ks: Sequence[int] = tuple(range(2, 11)), features: str = "features",
    folds: int = 5, metric: str = "euclidean", **options,
) -> DataFrame:
    """(k, cv_likelihood, silhouette, bic, log_bic); all sizes and folds are fitted in the same scans."""
    data = mixtures.prepared(df, id_col, features, folds)
    fits = mixtures.fit(data, [(k, f) for k in ks for f in (mixtures.WHOLE, *range(folds))], **options)
    held = mixtures.held_out(data, fits)
    labelled = cut_lineage(mixtures.clusters(data, id_col, fits)).withColumn("features", array_to_vector("x"))
    found = [k for k in ks if (k, mixtures.WHOLE) in fits]
    scores = _silhouettes(labelled, "features", [f"k{k}" for k in dict.fromkeys(found)], metric)
    rows = []
    for k in found:
        median = float(np.median([held[k, f] for f in range(folds) if (k, f) in held] or [np.nan]))
        rows.append((k, median, float(scores[f"k{k}"]), fits[k, mixtures.WHOLE].bic()))
    table = df.sparkSession.createDataFrame(
        rows, "k int, cv_likelihood double, silhouette double, bic double"
    )
    return table.withColumn("log_bic", F.when(F.col("bic") > 0, log_score(F.col("bic"))))


def sweep_k_kmeans(
    df: DataFrame, id_col: str, ks: Sequence[int] = tuple(range(4, 13)), features: str = "features",
    metric: str = "euclidean", **options,
) -> DataFrame:
    """(k, silhouette): Euclidean, which compares every two distinct rows once for all k, or squaredEuclidean in one
    pass each."""
    data = df.select(id_col, features).persist()
    try:
        labelled = data
        for k in dict.fromkeys(ks):
            labelled = kmeans(data, k, features, **options).transform(labelled).withColumnRenamed("cluster", f"k{k}")
        labelled = cut_lineage(labelled)
    finally:
        data.unpersist()
    scores = _silhouettes(labelled, features, [f"k{k}" for k in dict.fromkeys(ks)], metric)
    rows = [(k, float(scores[f"k{k}"])) for k in ks]
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double")


# --- isolation forest ---------------------------------------------------------


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int):
    """One isolation tree as arrays: feature (-1 = leaf), cut, left, right, size."""
    feature, cut, left, right, size = [], [], [], [], []

    def node(rows: np.ndarray, depth: int) -> int:
        at = len(feature)
        for a, v in zip((feature, cut, left, right, size), (-1, 0.0, -1, -1, len(rows))):
            a.append(v)
        if depth >= limit or len(rows) <= 1:
            return at
        lo, hi = x[rows].min(axis=0), x[rows].max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if not len(usable):
            return at
        f = int(rng.choice(usable))
        c = float(rng.uniform(lo[f], hi[f]))
        below = x[rows, f] < c
        feature[at], cut[at] = f, c
        left[at] = node(rows[below], depth + 1)
        right[at] = node(rows[~below], depth + 1)
        return at

    node(np.arange(len(x)), 0)
    return tuple(np.array(a) for a in (feature, cut, left, right, size))


def _average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows (Liu, Ting and Zhou 2008)."""
    n = np.asarray(n, dtype=float)
    big = 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def isolation_forest(
    df: DataFrame, id_col: str, vec_col: str, contamination: float = 0.025, trees: int = 100,
    sample: int = 256, seed: int = 42,
) -> DataFrame:
    """(id, score, outlier): isolation scores; the `contamination` share of highest scores is flagged.

    Every tree draws its own `sample` rows of the whole table, the smallest by a
    hash of (id, tree): one scan finds a few more than that for all trees, and
    each tree is grown in a task of its own.  The forest (at most trees x 2 sample
    nodes) goes to the tasks that score; the cut is an exact order statistic.
    """
    data = df.select(F.col(id_col), F.col(vec_col).cast("array<double>").alias("vec"))
    n = data.count()
    take = min(sample, n)
    limit = int(np.ceil(np.log2(max(take, 2))))
    # twice the rows wanted by a hash of 40 bits; all rows of a small table
    draw = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.struct(t.alias("tree"), F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), t), F.lit(1 << 40)).alias("draw")),
    )
    few = (1 << 40) if n <= 4 * sample else int((1 << 40) * min(1.0, (2 * sample + 64) / n))
    drawn = data.withColumn("_draws", F.filter(draw, lambda d: d["draw"] < few)).select(
        F.col(id_col).alias("row_id"), "vec", F.inline("_draws")
    )
    first = F.row_number().over(Window.partitionBy("tree").orderBy("draw", "row_id"))
    chosen = drawn.withColumn("place", first).where(F.col("place") <= take).drop("draw")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = np.stack(pdf.sort_values("place")["vec"].to_numpy())
        grown = _grow(x, np.random.default_rng([seed, tree]), limit)
        return pd.DataFrame([(tree, *grown)], columns=["tree", "feature", "cut", "left", "right", "size"])

    schema = ("tree int, feature array<int>, cut array<double>, left array<int>, "
              "right array<int>, size array<int>")
    forest = [
        tuple(np.array(a) for a in r[1:])
        for r in chosen.groupBy("tree").applyInPandas(build, schema).orderBy("tree").collect()
    ]
    usual = float(_average_path(np.array([take]))[0]) or 1.0

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype="float64")
        m = np.stack(x.to_numpy())
        rows = np.arange(len(m))
        total = np.zeros(len(m))
        for feature, cut, left, right, size in forest:
            at = np.zeros(len(m), dtype=int)
            depth = np.zeros(len(m))
            for _ in range(limit):
                inner = feature[at] >= 0
                go_left = m[rows, np.maximum(feature[at], 0)] < cut[at]
                at = np.where(inner, np.where(go_left, left[at], right[at]), at)
                depth += inner
            total += depth + _average_path(size[at])
        return pd.Series(2.0 ** (-total / max(len(forest), 1) / usual))

    scored = cut_lineage(data.select(id_col, F.round(score("vec"), 12).alias("score")))
    flagged = int(round(contamination * n))
    if flagged == 0:
        return scored.withColumn("outlier", F.lit(False))
    cut, _, _ = nth_smallest(scored, -F.col("score"), flagged)
    return scored.withColumn("outlier", F.col("score") >= F.lit(-cut))


def outlier_list(scored: DataFrame, id_col: str) -> DataFrame:
    """Ids of the flagged rows."""
    return scored.where("outlier").select(id_col)
