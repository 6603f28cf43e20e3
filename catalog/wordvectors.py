"""Vector arithmetic, averages, neighbours and alignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SQL_DOC_WORDS, doc_tokens, documents, joined, query, r6, table
from catalog.corpus import SQL_COUNTS, SQL_INDEX, training_index
from prosemill.functions import vectors as V
from prosemill.operators import neighbours
from prosemill.operators import vectors as O
from prosemill.operators.scaling import lookup_join, with_position
from prosemill.operators.terms import word_counts
from prosemill.session import cut_lineage

D = 64
_DOUBLES = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"

# The words of the corpus in order of frequency get the vectors of `embeddings`
# in order of vec_id: word vectors for as many words as there are vectors.
SQL_VECTORS = f"""
  SELECT word, {_DOUBLES} AS vector FROM (
    SELECT word, row_number() OVER (ORDER BY n DESC, word) - 1 AS place FROM ({SQL_COUNTS}))
  JOIN (SELECT embedding, row_number() OVER (ORDER BY vec_id) - 1 AS place FROM embeddings) USING (place)
"""


def word_vectors(spark, sf):
    words = with_position(
        word_counts(documents(spark, sf), doc_tokens()), [F.desc("n"), F.col("word")], "place"
    )
    rows = with_position(table(spark, sf, "embeddings").select("vec_id", "embedding"), [F.col("vec_id")], "place")
    return cut_lineage(
        words.join(rows, "place").select(
            "word", F.col("embedding").cast("array<double>").alias("vector")
        )
    )


def item_vectors(spark, sf, name: str = "vector"):
    """`embeddings` as a (word, vector) table."""
    return table(spark, sf, "embeddings", True).select(
        F.col("vec_id").alias("word"), F.col("embedding").cast("array<double>").alias(name)
    )


def _round_list(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda v: CAST(CAST(round(v * 1000000) AS BIGINT) AS VARCHAR)), ' ')"


def rounded(c):
    """A vector as millionths, for results that compare as plain values."""
    return F.array_join(F.transform(c, lambda v: F.round(v * 1000000).cast("long").cast("string")), " ")


@query(
    "l2_normalize",
    f"""SELECT vec_id, {_round_list('list_transform(v, lambda x: x / n)')} AS unit
    FROM (SELECT vec_id, {_DOUBLES} AS v, sqrt(list_dot_product({_DOUBLES}, {_DOUBLES})) AS n FROM embeddings)""",
)
def l2_normalize(spark, sf):
    return table(spark, sf, "embeddings", True).select(
        "vec_id", rounded(V.l2_normalize(F.col("embedding"))).alias("unit")
    )


@query(
    "cosine_distance",
    f"""SELECT a.vec_id, round(list_cosine_distance(a.v, b.v), 6) AS distance
    FROM (SELECT vec_id, {_DOUBLES} AS v, label FROM embeddings) a
    JOIN (SELECT label, {_DOUBLES} AS v FROM embeddings
          QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) = 1) b USING (label)""",
)
def cosine_distance(spark, sf):
    e = table(spark, sf, "embeddings", True)
    first = cut_lineage(e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("first")))
    both = lookup_join(e, first, "label")  # broadcast only if its bytes allow
    return both.select("vec_id", r6(V.cosine_distance(F.col("embedding"), F.col("first"))).alias("distance"))


@query(
    "argmax_class",
    f"SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS class FROM embeddings",
)
def argmax_class(spark, sf):
    return table(spark, sf, "embeddings", True).select("vec_id", V.argmax_class(F.col("embedding")).alias("class"))


@query(
    "token_vectors",
    f"""SELECT doc_id, word, tf, round(vector[1], 6) AS first, round(vector[{D}], 6) AS last FROM (
      SELECT doc_id, word, count(*) AS tf FROM ({SQL_DOC_WORDS}) GROUP BY doc_id, word)
    JOIN ({SQL_VECTORS}) USING (word)""",
)
def token_vectors(spark, sf):
    hits = O.token_vectors(documents(spark, sf), "doc_id", doc_tokens(), word_vectors(spark, sf))
    return hits.select(
        "doc_id", "word", "tf", r6(F.get("vector", F.lit(0))).alias("first"),
        r6(F.get("vector", F.lit(D - 1))).alias("last"),
    )


@query(
    "avg_vector",
    "WITH v AS (" + SQL_VECTORS + f"), w AS ({SQL_DOC_WORDS}), a AS (SELECT doc_id, "
    + ", ".join(f"avg(vector[{i + 1}]) AS a{i}" for i in range(D))
    + " FROM w JOIN v USING (word) GROUP BY doc_id) SELECT doc_id, "
    + ", ".join(f"round(coalesce(a{i}, 0), 6) + 0.0 AS a{i}" for i in range(D))
    + " FROM documents LEFT JOIN a USING (doc_id)",
)
def avg_vector(spark, sf):
    means = O.avg_vector(documents(spark, sf), "doc_id", doc_tokens(), word_vectors(spark, sf), D)
    return means.select(
        "doc_id", *[F.round(F.get("vector", F.lit(i)), 6).alias(f"a{i}") for i in range(D)]
    )


@query(
    "embedding_matrix",
    f"""SELECT token_id, {_round_list(f'coalesce(vector, list_transform(range({D}), lambda i: 0.0::DOUBLE))')} AS vector
    FROM ({SQL_INDEX}) LEFT JOIN ({SQL_VECTORS}) USING (word)
    UNION ALL SELECT 0, {_round_list(f'list_transform(range({D}), lambda i: 0.0::DOUBLE)')}""",
)
def embedding_matrix(spark, sf):
    m = O.embedding_matrix(training_index(spark, sf), word_vectors(spark, sf), D)
    return m.select("token_id", rounded(F.col("vector")).alias("vector"))


@query(
    "missing_vectors",
    f"SELECT count(*) AS missing FROM ({SQL_INDEX}) ANTI JOIN ({SQL_VECTORS}) USING (word)",
)
def missing_vectors(spark, sf):
    return O.missing_vectors(training_index(spark, sf), word_vectors(spark, sf))


def _sql_similar(vectors: str, word: int, k: int = 10) -> str:
    return f"""(SELECT b.word, list_cosine_similarity(a.vector, b.vector) AS score
      FROM ({vectors}) a, ({vectors}) b WHERE a.word = {word} AND b.word <> {word}
      ORDER BY score DESC, b.word LIMIT {k})"""


SQL_ITEMS = f"SELECT vec_id AS word, {_DOUBLES} AS vector FROM embeddings"
# Three models of the same words: the vectors, their first half, and their squares.
SQL_MODELS = {
    "full": SQL_ITEMS,
    "half": f"SELECT vec_id AS word, list_transform({_DOUBLES}, lambda x, i: CASE WHEN i <= {D // 2} THEN x ELSE 0.0 END) AS vector FROM embeddings",
    "square": f"SELECT vec_id AS word, list_transform({_DOUBLES}, lambda x: x * x) AS vector FROM embeddings",
}


def models(spark, sf):
    full = item_vectors(spark, sf)
    v = F.col("vector")
    return {
        "full": full,
        "half": full.withColumn("vector", F.transform(v, lambda x, i: F.when(i < D // 2, x).otherwise(0.0))),
        "square": full.withColumn("vector", F.transform(v, lambda x: x * x)),
    }


@query("most_similar", f"SELECT word, round(score, 6) AS score FROM {_sql_similar(SQL_ITEMS, 7)}")
def most_similar(spark, sf):
    return O.most_similar(item_vectors(spark, sf), 7, 10).select("word", r6("score").alias("score"))


_ALIGNED = f"""
  SELECT coalesce(f.word, h.word, s.word) AS word, round(coalesce(f.score, 0), 6) AS "full",
         round(coalesce(h.score, 0), 6) AS half, round(coalesce(s.score, 0), 6) AS square
  FROM {_sql_similar(SQL_MODELS['full'], 7)} f
  FULL JOIN {_sql_similar(SQL_MODELS['half'], 7)} h ON f.word = h.word
  FULL JOIN {_sql_similar(SQL_MODELS['square'], 7)} s ON s.word = coalesce(f.word, h.word)
"""


@query("align_neighbours", _ALIGNED)
def align_neighbours(spark, sf):
    lists = {name: O.most_similar(v, 7, 10) for name, v in models(spark, sf).items()}
    return O.align_neighbours(lists).select("word", *[r6(n).alias(n) for n in lists])


@query("similar_words_report", _ALIGNED)
def similar_words_report(spark, sf):
    report = O.similar_words_report(models(spark, sf), 7, 10)
    return report.select("word", *[r6(n).alias(n) for n in ("full", "half", "square")])


@query(
    "model_pair_distance",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS model_a, '{b}' AS model_b,
        round(list_cosine_distance(x.vector, y.vector), 6) AS distance
        FROM ({SQL_MODELS[a]}) x JOIN ({SQL_MODELS[b]}) y USING (word) WHERE word = 7"""
        for a, b in (("full", "half"), ("full", "square"), ("half", "square"))
    ),
)
def model_pair_distance(spark, sf):
    d = O.model_pair_distance(models(spark, sf), 7)
    return d.select("model_a", "model_b", r6("distance").alias("distance"))


@query(
    "knn_graph",
    f"""WITH v AS (SELECT vec_id, {_DOUBLES} AS v FROM embeddings),
    p AS (SELECT a.vec_id, b.vec_id AS nbr, round(list_cosine_distance(a.v, b.v), 9) + 0.0 AS dist
          FROM v a JOIN v b ON a.vec_id <> b.vec_id)
    SELECT vec_id, nbr, round(dist, 6) AS dist,
           CAST(row_number() OVER (PARTITION BY vec_id ORDER BY dist, nbr) AS INTEGER) AS rank
    FROM p QUALIFY rank <= 40""",
)
def knn_graph(spark, sf):
    g = neighbours.knn_graph(table(spark, sf, "embeddings", True), "vec_id", "embedding", 40)
    return g.select("vec_id", "nbr", r6("dist").alias("dist"), "rank")


@query(
    "silhouette",
    f"""WITH v AS (SELECT vec_id, label, {_DOUBLES} AS v FROM embeddings),
    d AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.v, b.v)) AS total, count(*) AS n
          FROM v a JOIN v b ON a.vec_id <> b.vec_id GROUP BY ALL),
    s AS (SELECT vec_id, max(CASE WHEN label = other THEN total / n END) AS a,
                 min(CASE WHEN label <> other THEN total / n END) AS b FROM d GROUP BY vec_id)
    SELECT round(avg(coalesce((b - a) / greatest(a, b), 0)), 6) AS silhouette FROM s""",
)
def silhouette(spark, sf):
    s = neighbours.silhouette(table(spark, sf, "embeddings", True), "embedding", "label")
    return s.select(r6("silhouette").alias("silhouette"))
