"""Confusion matrices, reports and comparisons of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def class_list(df: DataFrame, *cols: str) -> list:
    """The distinct values of the label columns, sorted."""
    both = df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias("c"))
    found = [
        r.c
        for r in both.where(F.col("c").isNotNull()).distinct().collect()
    ]
    return sorted(found)


def confusion_matrix(
    df: DataFrame, label: str, pred: str, classes: Sequence | None = None
) -> DataFrame:
    """(label, pred, n) for every pair of classes, zero where none.

    The matrix has classes x classes rows; the classes are labels of a model and few.
    """
    classes = list(classes) if classes is not None else class_list(df, label, pred)
    kind = df.schema[label].dataType.simpleString()
    every = F.array(*[F.lit(c).cast(kind) for c in classes])
    listed = df.where(F.col(label).isin(classes) & F.col(pred).isin(classes))
    counts = listed.groupBy(F.col(label).alias("label"), F.col(pred).cast(kind).alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )
    grid = (
        df.sparkSession.range(1)
        .select(F.explode(every).alias("label"))
        .select("label", F.explode(every).alias("pred"))
    )
    return grid.join(counts, ["label", "pred"], "left").select(
        "label", "pred", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(class, precision, recall, f1, support): one row per class, then accuracy,
    macro avg and weighted avg (accuracy in every score column)."""
    pairs = df.groupBy(F.col(label).alias("l"), F.col(pred).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    hit = F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0)
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("l").cast("string").alias("class"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("predicted"),
                    hit.cast("long").alias("tp"),
                ),
                F.struct(
                    F.col("p").cast("string").alias("class"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("long").alias("tp"),
                ),
            )
        )
    )
    per = (
        sides.groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
        .withColumn("precision", _ratio("tp", "predicted"))
        .withColumn("recall", _ratio("tp", "support"))
        .withColumn(
            "f1",
            F.when(F.col("precision") + F.col("recall") > 0,
                   2 * F.col("precision") * F.col("recall")
                   / F.nullif(F.col("precision") + F.col("recall"), F.lit(0.0))).otherwise(0.0),
        )
    )
    scores = ("precision", "recall", "f1")
    n = F.sum("support")
    averages = per.agg(
        n.alias("n"),
        (F.sum("tp") / n).alias("accuracy"),
        *[F.avg(s).alias(f"m_{s}") for s in scores],
        *[(F.sum(F.col(s) * F.col("support")) / n).alias(f"w_{s}") for s in scores],
    )

    def row(name: str, cols: Sequence[str]):
        return F.struct(
            F.lit(name).alias("class"),
            *[F.col(c).alias(s) for c, s in zip(cols, scores)],
            F.col("n").alias("support"),
        )

    summary = averages.select(
        F.inline(
            F.array(
                row("accuracy", ["accuracy"] * 3),
                row("macro avg", [f"m_{s}" for s in scores]),
                row("weighted avg", [f"w_{s}" for s in scores]),
            )
        )
    )
    return per.select("class", *scores, "support").unionByName(summary)


def _ratio(a: str, b: str):
    return F.when(F.col(b) > 0, F.col(a) / F.nullif(F.col(b), F.lit(0))).otherwise(0.0)


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def error_counts(
    df: DataFrame, label: str = "rating", pred: str = "prediction",
    by: Sequence[str] = ("model", "embedding"),
) -> DataFrame:
    """False positives and negatives per model and embedding."""
    return df.groupBy(*by).agg(
        F.count_if((F.col(pred) == 1) & (F.col(label) == 0)).alias("false_positives"),
        F.count_if((F.col(pred) == 0) & (F.col(label) == 1)).alias("false_negatives"),
    )


def compare_models(
    df: DataFrame, label: str = "rating", pred: str = "prediction",
    by: Sequence[str] = ("model", "embedding"),
) -> DataFrame:
    """(model, embedding, accuracy, best): accuracy of each, the best one marked."""
    acc = df.groupBy(*by).agg(
        F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy")
    )
    w = Window.orderBy(F.desc("accuracy"), *by)
    return acc.withColumn("best", F.row_number().over(w) == 1)


def pick_elbow(scores: DataFrame, k: str = "k", score: str = "silhouette", largest: bool = True) -> DataFrame:
    """`scores` with the gain over the previous k and the rank of each k.

    The table has one row per tried k, so its windows are tiny.
    """
    order = F.desc(score) if largest else F.asc(score)
    return scores.withColumn(
        "gain", F.col(score) - F.lag(score).over(Window.orderBy(k))
    ).withColumn("rank", F.row_number().over(Window.orderBy(order, k)))
