"""Clustering of physician notes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill import dims
from prosemill.functions.text import clean_note, finish_note, tokenize_ws
from prosemill.operators import features, models
from prosemill.operators.spelling import correct_spelling


def preprocess_note(
    df: DataFrame, id_col: str, text: str, stop: Sequence[str] = dims.STOP_WORDS,
    min_count: int = 5, dictionary: DataFrame | None = None,
) -> DataFrame:
    """(id, note): cleaned, spelling corrected, numbers standardised, stop words removed."""
    cleaned = df.select(id_col, clean_note(F.col(text)).alias("_note"))
    spelled = correct_spelling(
        cleaned, id_col, tokenize_ws(F.col("_note")), min_count, dictionary
    )
    return spelled.select(id_col, finish_note(F.array_join("tokens", " "), stop).alias("note"))


def cluster_notes(
    df: DataFrame, id_col: str, text: str, components: int = 12, k: int = 9,
    min_df: float | int = 0.01, max_df: float | int = 0.85,
) -> DataFrame:
    """(id, note, svd, outlier, cluster): TF-IDF, outlier flags, truncated SVD, K-means.

    Outliers are flagged on the TF-IDF rows and stay in the data.
    """
    notes = preprocess_note(df, id_col, text)
    weighted, _ = features.tfidf_features(notes, F.col("note"), min_df=min_df, max_df=max_df)
    weighted = weighted.persist()
    flags = models.isolation_forest(
        weighted.select(id_col, vector_to_array("features").alias("vec")), id_col, "vec"
    ).select(id_col, "outlier")
    reduced, _ = features.truncated_svd(weighted, "features", components)
    reduced = features.as_vector(reduced.drop("features"), "svd").persist()
    labelled = models.assign_clusters(models.kmeans(reduced, k), reduced)
    weighted.unpersist()
    return labelled.drop("features").join(flags, id_col)
