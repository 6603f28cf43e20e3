"""Sentiment of product reviews."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.functions.text import lower_text, preprocess_text, tokenize_ws, word_count
from prosemill.operators import embed, features, models
from prosemill.operators.sampling import balance_classes, train_test_split
from prosemill.operators.sentiment import lexicon_polarity, lexicon_valence
from prosemill.operators.tables import binary_label, drop_neutral
from prosemill.operators.vectors import avg_vector
from prosemill.session import cut_lineage


def label_reviews(df: DataFrame) -> DataFrame:
    """Word counts of the raw texts, lower-case texts, no neutral scores, a 0/1 rating.

    Stateless, so it works on a stream as well.
    """
    counted = df.withColumns(
        {
            "length_review": word_count(F.col("reviewText")),
            "length_summary": word_count(F.col("summary")),
            "reviewText": lower_text(F.col("reviewText")),
            "summary": lower_text(F.col("summary")),
        }
    )
    rated = drop_neutral(counted).withColumn("rating", binary_label(F.col("overall")))
    return rated.withColumn("reviewText2", preprocess_text(F.col("reviewText")))


def prepare_reviews(
    df: DataFrame, id_col: str, n_negative: int = 100_183, positive_share: float = 0.1, seed: int = 42
) -> DataFrame:
    """Labelled reviews with an exact number of negative and share of positive ones."""
    return balance_classes(label_reviews(df), id_col, "rating", n_negative, positive_share, seed)


def train_vectors(reviews: DataFrame, dim: int = 100, **options) -> dict[str, DataFrame]:
    """(word, vector) tables by embedding: cbow, skipgram, fasttext."""
    tokens = tokenize_ws(F.col("reviewText2"))
    return {
        "cbow": embed.word2vec_cbow(reviews, tokens, dim=dim, **options)[1],
        "skipgram": embed.word2vec_skipgram(reviews, tokens, dim=dim, **options)[1],
        "fasttext": embed.fasttext_skipgram(reviews, tokens, dim=dim, **options)[1],
    }


def classify_reviews(
    reviews: DataFrame, id_col: str, vectors: Mapping[str, DataFrame], dim: int = 100,
    components: int = 55, test: float = 0.2, seed: int = 42, **boosting,
) -> DataFrame:
    """Test reviews with `prediction`, `model` and `embedding`, once per embedding.

    Average vectors, centred PCA, boosted trees; every embedding is scored by
    its own model.
    """
    tokens = tokenize_ws(F.col("reviewText2"))
    out = None
    for name, table in vectors.items():
        means = avg_vector(reviews, id_col, tokens, table, dim)
        rows = cut_lineage(
            means.join(reviews.select(id_col, "reviewText2", "rating"), id_col)
        )
        reduced, _ = features.pca(features.as_vector(rows, "vector"), "features", components)
        split = cut_lineage(train_test_split(
            reduced.select(id_col, "reviewText2", "rating",
                           F.col("rating").cast("double").alias("label"), F.col("pca").alias("features")),
            id_col, test, seed,
        ))
        model = models.boosted_trees_binary(split.where("split = 'train'"), **boosting)
        scored = models.predict(model, split.where("split = 'test'")).select(
            id_col, "reviewText2", "rating", "prediction",
            F.lit("boosted_trees").alias("model"), F.lit(name).alias("embedding"),
        )
        out = scored if out is None else out.unionByName(scored)
    return out


def score_sentiment(reviews: DataFrame, id_col: str, lexicon: DataFrame) -> DataFrame:
    """(id, overall, six lexicon scores)."""
    tokens = tokenize_ws(F.col("reviewText2"))
    valence = lexicon_valence(reviews, id_col, tokens, lexicon).select(
        id_col,
        F.col("pos").alias("vader_positive"),
        F.col("neu").alias("vader_neutral"),
        F.col("neg").alias("vader_negative"),
        F.col("compound").alias("vader_polarity"),
    )
    polarity = lexicon_polarity(reviews, id_col, tokens, lexicon).select(
        id_col,
        F.col("polarity").alias("textblob_polarity"),
        F.col("subjectivity").alias("textblob_subjectivity"),
    )
    return reviews.select(id_col, "overall").join(valence, id_col).join(polarity, id_col)
