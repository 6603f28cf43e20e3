"""Classification of news items by category."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill import dims
from prosemill.functions.text import concat_text, lower_text, preprocess_text, text_or_empty
from prosemill.operators import evaluate, features, models
from prosemill.operators.sampling import sample_fraction, train_test_split
from prosemill.operators.tables import group_categories
from prosemill.session import cut_lineage


def prepare_news(
    df: DataFrame, id_col: str, groups: Mapping[str, str] | DataFrame | None = None,
    fraction: float = 0.5, seed: int = 42,
) -> DataFrame:
    """(id, category, text): an exact sample, grouped categories, cleaned headline and description."""
    kept = sample_fraction(df, id_col, fraction, seed)
    kept = group_categories(kept, "category", dims.category_map() if groups is None else groups)

    def clean(c: str):
        return preprocess_text(lower_text(text_or_empty(F.col(c))))

    return kept.select(id_col, "category", concat_text(clean("headline"), clean("short_description")).alias("text"))


def news_split(
    news: DataFrame, id_col: str, min_df: float | int = 0.005, max_df: float | int = 0.85,
    test: float = 0.25, seed: int = 42,
):
    """(train, test, label indexer): TF-IDF features and numbered categories."""
    weighted, _ = features.tfidf_features(news, F.col("text"), min_df=min_df, max_df=max_df)
    coded, indexer = features.label_encode(weighted, "category", "label")
    rows = cut_lineage(train_test_split(
        coded.select(id_col, "category", F.col("label").cast("double").alias("label"), "features"),
        id_col, test, seed,
    ))
    return (
        rows.where("split = 'train'").drop("split"),
        rows.where("split = 'test'").drop("split"),
        indexer,
    )


DEFAULT_MODELS = ("logistic_regression", "random_forest", "boosted_trees", "mlp")


def classify_news(
    train: DataFrame, test: DataFrame, id_col: str, indexer,
    which: Sequence[str] = DEFAULT_MODELS, options: Mapping[str, dict] | None = None,
) -> DataFrame:
    """(id, category, predicted, model): the test rows once per model."""
    fits = {
        "logistic_regression": models.logistic_regression,
        "random_forest": models.random_forest,
        "boosted_trees": models.boosted_trees_multiclass,
        "mlp": models.mlp_classifier,
    }
    out = None
    for name in which:
        model = fits[name](train, **(options or {}).get(name, {}))
        coded = models.predict(model, test)
        named = features.label_decode(coded, "prediction", "predicted", indexer).select(
            id_col, "category", "predicted", F.lit(name).alias("model")
        )
        out = named if out is None else out.unionByName(named)
    return out


def news_reports(predictions: DataFrame, which: Sequence[str] = DEFAULT_MODELS) -> DataFrame:
    """(model, class, precision, recall, f1, support)."""
    out = None
    for name in which:
        one = predictions.where(F.col("model") == name)
        report = evaluate.classification_report(one, "category", "predicted").select(
            F.lit(name).alias("model"), "*"
        )
        out = report if out is None else out.unionByName(report)
    return out
