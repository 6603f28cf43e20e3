"""Confusion tables, reports, comparisons and lexicon sentiment."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SQL_DOC_WORDS, doc_tokens, documents, query, r6, table
from catalog.corpus import SQL_COUNTS
from catalog.tables import SQL_PREDICTIONS, predictions
from prosemill.operators import evaluate as E
from prosemill.operators import sentiment as S
from prosemill.operators.terms import word_counts
from prosemill.session import cut_lineage

_ONE = f"SELECT * FROM ({SQL_PREDICTIONS}) WHERE model = 'short' AND embedding = 'high'"


def one_model(spark, sf):
    return predictions(spark, sf).where("model = 'short' AND embedding = 'high'")


# priority against status: five classes on one side, all of both zero-filled
@query(
    "confusion_matrix",
    """WITH p AS (SELECT substr(o_orderpriority, 1, 1) AS label, CAST(o_orderkey % 5 + 1 AS VARCHAR) AS pred FROM orders),
    c AS (SELECT DISTINCT label AS x FROM p UNION SELECT DISTINCT pred FROM p)
    SELECT a.x AS label, b.x AS pred, count(p.label) AS n
    FROM c a CROSS JOIN c b LEFT JOIN p ON p.label = a.x AND p.pred = b.x GROUP BY ALL""",
)
def confusion_matrix(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.substring("o_orderpriority", 1, 1).alias("label"),
        (F.col("o_orderkey") % 5 + 1).cast("string").alias("pred"),
    )
    return E.confusion_matrix(rows, "label", "pred")


_PER = f"""
  WITH p AS ({_ONE}),
  c AS (SELECT DISTINCT rating AS k FROM p UNION SELECT DISTINCT prediction FROM p),
  per AS (
    SELECT k, count(*) FILTER (rating = k AND prediction = k) AS tp,
           count(*) FILTER (prediction = k) AS predicted, count(*) FILTER (rating = k) AS support
    FROM c, p GROUP BY k),
  s AS (
    SELECT CAST(k AS VARCHAR) AS class, tp, support,
           coalesce(tp / nullif(predicted, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall
    FROM per),
  f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM s)
"""


@query(
    "classification_report",
    _PER + """
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
           CAST(support AS BIGINT) AS support FROM f
    UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
           round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
    UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
           CAST(sum(support) AS BIGINT) FROM f
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
           round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
           CAST(sum(support) AS BIGINT) FROM f""",
)
def classification_report(spark, sf):
    report = E.classification_report(one_model(spark, sf), "rating", "prediction")
    return report.select(
        "class", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


@query("accuracy", f"SELECT round(avg(CAST(rating = prediction AS INTEGER)), 6) AS accuracy FROM ({_ONE})")
def accuracy(spark, sf):
    return E.accuracy(one_model(spark, sf), "rating", "prediction").select(r6("accuracy").alias("accuracy"))


@query(
    "error_counts",
    f"""SELECT model, embedding, count(*) FILTER (prediction = 1 AND rating = 0) AS false_positives,
    count(*) FILTER (prediction = 0 AND rating = 1) AS false_negatives
    FROM ({SQL_PREDICTIONS}) GROUP BY model, embedding""",
)
def error_counts(spark, sf):
    return E.error_counts(predictions(spark, sf))


@query(
    "compare_models",
    f"""SELECT model, embedding, round(accuracy, 6) AS accuracy,
      row_number() OVER (ORDER BY accuracy DESC, model, embedding) = 1 AS best
    FROM (SELECT model, embedding, avg(CAST(rating = prediction AS INTEGER)) AS accuracy
          FROM ({SQL_PREDICTIONS}) GROUP BY model, embedding)""",
)
def compare_models(spark, sf):
    c = E.compare_models(predictions(spark, sf))
    return c.select("model", "embedding", r6("accuracy").alias("accuracy"), "best")


# A lexicon from the corpus: every word used at least ten times, scored by its length.
SQL_LEXICON = f"""
  SELECT word, CAST(length(word) % 9 - 4 AS DOUBLE) AS valence,
         (length(word) % 5 - 2) / 2.0 AS polarity, (length(word) % 4) / 4.0 AS subjectivity
  FROM ({SQL_COUNTS}) WHERE n >= 10
"""


def lexicon(spark, sf):
    size = F.length("word")
    return cut_lineage(
        word_counts(documents(spark, sf), doc_tokens()).where("n >= 10").select(
            "word",
            (size % 9 - 4).cast("double").alias("valence"),
            ((size % 5 - 2) / 2).alias("polarity"),
            ((size % 4) / 4).alias("subjectivity"),
        )
    )


SQL_VALENCE = f"""
  SELECT doc_id, coalesce(down / nullif(up + down + flat, 0), 0) AS neg,
         coalesce(flat / nullif(up + down + flat, 0), 0) AS neu,
         coalesce(up / nullif(up + down + flat, 0), 0) AS pos,
         coalesce(s / sqrt(s * s + 15), 0) AS compound
  FROM documents LEFT JOIN (
    SELECT doc_id, sum(v) AS s, sum(CASE WHEN v > 0 THEN v + 1 ELSE 0 END) AS up,
           sum(CASE WHEN v < 0 THEN 1 - v ELSE 0 END) AS down,
           CAST(count(*) FILTER (v = 0) AS DOUBLE) AS flat
    FROM (SELECT doc_id, coalesce(valence, 0) AS v
          FROM ({SQL_DOC_WORDS}) LEFT JOIN ({SQL_LEXICON}) USING (word))
    GROUP BY doc_id) USING (doc_id)
"""


@query(
    "lexicon_valence",
    f"""SELECT doc_id, round(neg, 6) AS neg, round(neu, 6) AS neu, round(pos, 6) AS pos,
    round(compound, 6) + 0.0 AS compound FROM ({SQL_VALENCE})""",
)
def lexicon_valence(spark, sf):
    scores = S.lexicon_valence(documents(spark, sf), "doc_id", doc_tokens(), lexicon(spark, sf))
    return scores.select("doc_id", *[r6(c).alias(c) for c in ("neg", "neu", "pos", "compound")])


_CLASS = "CASE WHEN compound >= 0.05 THEN 'Positive' WHEN compound <= -0.05 THEN 'Negative' ELSE 'Neutral' END"


@query("valence_class", f"SELECT {_CLASS} AS class, count(*) AS n FROM ({SQL_VALENCE}) GROUP BY 1")
def valence_class(spark, sf):
    scores = S.lexicon_valence(documents(spark, sf), "doc_id", doc_tokens(), lexicon(spark, sf))
    return scores.groupBy(S.valence_class(F.col("compound")).alias("class")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "valence_report",
    f"""SELECT doc_id, round(neg * 100, 4) AS negative_pct, round(neu * 100, 4) AS neutral_pct,
    round(pos * 100, 4) AS positive_pct, {_CLASS} AS overall FROM ({SQL_VALENCE})""",
)
def valence_report(spark, sf):
    scores = S.lexicon_valence(documents(spark, sf), "doc_id", doc_tokens(), lexicon(spark, sf))
    report = S.valence_report(scores, "doc_id")
    return report.select(
        "doc_id", *[F.round(f"{c}_pct", 4).alias(f"{c}_pct") for c in ("negative", "neutral", "positive")],
        "overall",
    )


@query(
    "lexicon_polarity",
    f"""SELECT doc_id, round(coalesce(p, 0), 6) + 0.0 AS polarity, round(coalesce(s, 0), 6) AS subjectivity
    FROM documents LEFT JOIN (
      SELECT doc_id, avg(polarity) AS p, avg(subjectivity) AS s
      FROM ({SQL_DOC_WORDS}) JOIN ({SQL_LEXICON}) USING (word) GROUP BY doc_id) USING (doc_id)""",
)
def lexicon_polarity(spark, sf):
    scores = S.lexicon_polarity(documents(spark, sf), "doc_id", doc_tokens(), lexicon(spark, sf))
    return scores.select("doc_id", r6("polarity").alias("polarity"), r6("subjectivity").alias("subjectivity"))
