"""Sentiment scores from word lexica."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill import dims
from prosemill.operators.scaling import lookup_join


def lexicon_table(spark: SparkSession) -> DataFrame:
    """The built-in starter lexicon as a table."""
    return spark.createDataFrame(
        dims.LEXICON, "word string, valence double, polarity double, subjectivity double"
    )


def _scored(df: DataFrame, id_col: str, tokens: Column, lexicon: DataFrame) -> DataFrame:
    words = df.select(id_col, F.explode_outer(tokens).alias("word"))
    return lookup_join(words, lexicon, "word", "left")


def lexicon_valence(
    df: DataFrame, id_col: str, tokens: Column, lexicon: DataFrame
) -> DataFrame:
    """(id, neg, neu, pos, compound) from word valences.

    compound = s / sqrt(s^2 + 15) for the sum s of valences; neg, neu and pos
    are the shares of the three kinds of words, each scored word weighing its
    valence plus one.  Tasks send one partial row per document.
    """
    v = F.coalesce("valence", F.lit(0.0))
    is_word = F.col("word").isNotNull()
    sums = (
        _scored(df, id_col, tokens, lexicon.select("word", "valence"))
        .groupBy(id_col)
        .agg(
            F.sum(v).alias("s"),
            F.sum(F.when(v > 0, v + 1).otherwise(0.0)).alias("up"),
            F.sum(F.when(v < 0, 1 - v).otherwise(0.0)).alias("down"),
            F.sum(F.when(is_word & (v == 0), 1.0).otherwise(0.0)).alias("flat"),
        )
    )
    total = F.col("up") + F.col("down") + F.col("flat")

    def share(part: str) -> Column:
        return F.when(total > 0, F.col(part) / F.nullif(total, F.lit(0.0))).otherwise(0.0)

    s = F.col("s")
    return sums.select(
        id_col,
        share("down").alias("neg"),
        share("flat").alias("neu"),
        share("up").alias("pos"),
        (s / F.sqrt(s * s + F.lit(dims.COMPOUND_ALPHA))).alias("compound"),
    )


def valence_class(compound: Column, cut: float = dims.COMPOUND_CUT) -> Column:
    return F.when(compound >= cut, "Positive").when(compound <= -cut, "Negative").otherwise("Neutral")


def valence_report(scores: DataFrame, id_col: str) -> DataFrame:
    """Percentages of negative, neutral and positive words and the overall class."""
    return scores.select(
        id_col,
        (F.col("neg") * 100).alias("negative_pct"),
        (F.col("neu") * 100).alias("neutral_pct"),
        (F.col("pos") * 100).alias("positive_pct"),
        valence_class(F.col("compound")).alias("overall"),
    )


def lexicon_polarity(
    df: DataFrame, id_col: str, tokens: Column, lexicon: DataFrame
) -> DataFrame:
    """(id, polarity, subjectivity): means over the known words, 0 without any."""
    dim = lexicon.select("word", "polarity", "subjectivity")
    return (
        _scored(df, id_col, tokens, dim)
        .groupBy(id_col)
        .agg(
            F.coalesce(F.avg("polarity"), F.lit(0.0)).alias("polarity"),
            F.coalesce(F.avg("subjectivity"), F.lit(0.0)).alias("subjectivity"),
        )
    )
