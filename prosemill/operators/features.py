"""Feature matrices: sparse TF-IDF vectors, PCA, truncated SVD, label codes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    PCA,
    CountVectorizerModel,
    ElementwiseProduct,
    Normalizer,
    StandardScaler,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill import dims
from prosemill.functions.text import drop_stopwords, tokenize_terms
from prosemill.operators.scaling import lookup_join, with_position
from prosemill.operators.terms import document_frequency
from prosemill.session import cut_lineage

PROJECT_CELLS = 1 << 21  # numbers that a task multiplies at once (16 MB)


def tfidf_features(
    df: DataFrame,
    text: Column,
    stop: Sequence[str] = dims.STOP_WORDS,
    min_df: float | int = 0.01,
    max_df: float | int = 0.85,
    out: str = "features",
) -> tuple[DataFrame, PipelineModel]:
    """`df` with a sparse unit-length TF-IDF vector, and the fitted stages.

    The vocabulary and its document frequencies come from one aggregation.  The
    model holds it, as Spark's own does; with a fractional `min_df` it is at most
    (distinct terms per document) / min_df terms, whatever the corpus.
    Transforming is one pass without a shuffle.
    """
    tokens = drop_stopwords(tokenize_terms(F.lower(text)), stop)
    docs = df.count()
    kept = (
        document_frequency(df, tokens, min_df, max_df)
        .orderBy(F.desc("df"), "term")
        .collect()
    )
    if not kept:
        raise ValueError("no term passes the document-frequency cuts")
    idf = np.log((1.0 + docs) / (1.0 + np.array([r.df for r in kept]))) + 1.0
    counter = CountVectorizerModel.from_vocabulary(
        [r.term for r in kept], inputCol="_tokens", outputCol="_tf"
    )
    scale = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_raw")
    unit = Normalizer(p=2.0, inputCol="_raw", outputCol=out)
    model = PipelineModel([counter, scale, unit])
    weighted = model.transform(df.withColumn("_tokens", tokens))
    return weighted.drop("_tokens", "_tf", "_raw"), model


def as_vector(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    """An array column as an ML vector column."""
    return df.withColumn(out, array_to_vector(F.col(col).cast("array<double>")))


def pca(df: DataFrame, col: str = "features", k: int = 55, out: str = "pca") -> tuple[DataFrame, PipelineModel]:
    """`df` with k centred principal components, and the fitted stages."""
    centre = StandardScaler(withMean=True, withStd=False, inputCol=col, outputCol="_centred")
    model = Pipeline(stages=[centre, PCA(k=k, inputCol="_centred", outputCol=out)]).fit(df)
    return model.transform(df).drop("_centred"), model


def svd_basis(df: DataFrame, col: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, right singular vectors d x k) by Spark's distributed Lanczos iteration.

    Products with the sparse rows run in the JVM; the driver holds vectors of
    one number per feature.
    """
    rows = MLUtils.convertVectorColumnsFromML(df.select(col), col).persist()
    try:
        svd = RowMatrix(rows).computeSVD(k, computeU=False)
        return svd.s.toArray(), svd.V.toArray()
    finally:
        rows.unpersist()


def projected(at: list, values: list, basis: np.ndarray, cells: int = PROJECT_CELLS) -> np.ndarray:
    """The sparse rows (at, values) times the basis, a slice of rows at a time.

    A weight takes a row of the basis while it is added, so a slice holds weights for at most
    `cells` numbers, or one row.
    """
    counts = np.array([len(x) for x in at], dtype=np.int64)
    out = np.zeros((len(at), basis.shape[1]))
    full = np.flatnonzero(counts)
    upto = np.cumsum(counts[full])
    most = max(1, cells // max(1, basis.shape[1]))
    lo = 0
    while lo < len(full):
        before = upto[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, before + most, side="right")))
        own = full[lo:hi]
        places = np.concatenate([at[r] for r in own]).astype(np.int64)
        parts = np.concatenate([values[r] for r in own])[:, None] * basis[places]
        out[own] = np.add.reduceat(parts, upto[lo:hi] - counts[own] - before, axis=0)
        lo = hi
    return out


def truncated_svd(
    df: DataFrame, col: str = "features", k: int = 12, out: str = "svd"
) -> tuple[DataFrame, np.ndarray]:
    """`df` with k uncentred components (array<double>), and the variance share of each.

    The share is the variance of a component over the total variance of the
    features, both centred, as usual for this method.
    """
    _, basis = svd_basis(df, col, k)
    found = basis.shape[1]

    @F.pandas_udf("array<double>")
    def project(i: pd.Series, v: pd.Series) -> pd.Series:
        return pd.Series(list(projected(i.to_list(), v.to_list(), basis)))

    # the stored form of a vector: a dense one has no indices
    raw = F.unwrap_udt(col)
    values = raw["values"]
    at = F.coalesce(raw["indices"], F.sequence(F.lit(0), F.size(values) - 1))
    some = F.size(values) > 0
    reduced = df.withColumn(
        out,
        project(
            F.when(some, at).otherwise(F.array().cast("array<int>")),
            F.when(some, values).otherwise(F.array().cast("array<double>")),
        ),
    )
    total = df.agg(Summarizer.variance(F.col(col)).alias("v")).first()[0].toArray().sum()
    parts = reduced.agg(*[F.var_samp(F.get(out, F.lit(j))) for j in range(found)]).first()
    return reduced, np.array([x or 0.0 for x in parts]) / (total or 1.0)


def cumulative_variance(df: DataFrame, col: str = "features", max_k: int = 233) -> DataFrame:
    """(n, share): variance share of the first n components, from one fit.

    `max_k` is at most the number of features; fewer are found in data of lower rank.
    """
    wide = df.select(col).first()[0].size
    _, shares = truncated_svd(df, col, min(max_k, wide))
    rows = [(n + 1, float(s)) for n, s in enumerate(np.cumsum(shares))]
    return df.sparkSession.createDataFrame(rows, "n int, share double")


def label_encode(df: DataFrame, col: str, out: str) -> tuple[DataFrame, DataFrame]:
    """`df` with the alphabetical number of each label, and the (label, code) table.

    Distinct labels are numbered by a distributed sort and looked up by a join
    that broadcasts them if they are few.  Rows without a label are an error.
    """
    codes = cut_lineage(label_table(df, col).withColumn("code", F.col("code").cast("int")))
    named = codes.select(F.col("label").alias(col), F.col("code").alias("_code"))
    coded = lookup_join(df, named, col, "left")
    known = F.coalesce("_code", F.raise_error(F.lit(f"{col}: a row without a label")).cast("int"))
    return coded.withColumn(out, known).drop("_code").select(*df.columns, out), codes


def label_decode(df: DataFrame, col: str, out: str, codes: DataFrame) -> DataFrame:
    """`df` with the label of each number."""
    named = codes.select(F.col("code").alias("_code"), F.col("label").alias("_label"))
    rows = df.withColumn("_code", F.col(col).cast("int"))
    return lookup_join(rows, named, "_code", "left").withColumn(out, F.col("_label")).drop("_code", "_label")


def label_table(df: DataFrame, col: str) -> DataFrame:
    """(label, code): distinct labels numbered alphabetically."""
    labels = df.select(F.col(col).alias("label")).where(F.col(col).isNotNull()).distinct()
    return with_position(labels, [F.col("label")], "code")
