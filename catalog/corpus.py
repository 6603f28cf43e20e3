"""Term statistics, vocabularies, sequences and TF-IDF over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    SQL_DOC_TERMS, SQL_DOC_WORDS, doc_terms, doc_tokens, documents, joined, query, r6, sql_hash,
    sql_preprocess_tokens,
)
from prosemill.functions import text as T
from prosemill.functions.vectors import pad_sequence as pad
from prosemill.operators import sampling
from prosemill.operators import terms as O

SQL_COUNTS = f"SELECT word, count(*) AS n FROM ({SQL_DOC_WORDS}) GROUP BY word"


@query("vocab_size", f"SELECT count(DISTINCT word) AS vocab_size FROM ({SQL_DOC_WORDS})")
def vocab_size(spark, sf):
    return O.vocab_size(documents(spark, sf), doc_tokens())


@query(
    "term_frequency",
    f"SELECT doc_id, word AS term, count(*) AS tf FROM ({SQL_DOC_WORDS}) GROUP BY doc_id, word",
)
def term_frequency(spark, sf):
    return O.term_frequency(documents(spark, sf), "doc_id", doc_tokens())


_DF = f"SELECT term, count(DISTINCT doc_id) AS df FROM ({SQL_DOC_TERMS}) GROUP BY term"
_CUT = "df >= 0.01 * (SELECT count(*) FROM documents) AND df <= 0.85 * (SELECT count(*) FROM documents)"


SQL_CUT_TERMS = f"SELECT * FROM ({_DF}) WHERE {_CUT}"


@query("document_frequency", SQL_CUT_TERMS)
def document_frequency(spark, sf):
    return O.document_frequency(documents(spark, sf), doc_terms(), 0.01, 0.85)


@query("word_frequency_min", f"SELECT * FROM ({SQL_COUNTS}) WHERE n >= 2")
def word_frequency_min(spark, sf):
    return O.word_frequency_min(documents(spark, sf), doc_tokens(), 2)


@query("top_words", f"SELECT * FROM ({SQL_COUNTS}) ORDER BY n DESC, word LIMIT 100")
def top_words(spark, sf):
    return O.top_words(documents(spark, sf), doc_tokens(), 100)


@query("sorted_words", f"SELECT DISTINCT word FROM ({SQL_DOC_WORDS}) ORDER BY word")
def sorted_words(spark, sf):
    return O.exploded(documents(spark, sf), [], doc_tokens()).distinct().orderBy("word")


@query(
    "tfidf",
    f"""WITH w AS (
      SELECT t.doc_id, t.term, count(*) AS tf FROM ({SQL_DOC_TERMS}) t GROUP BY ALL),
    d AS (SELECT * FROM ({_DF}) WHERE {_CUT}),
    raw AS (
      SELECT doc_id, term, tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS v
      FROM w JOIN d USING (term))
    SELECT doc_id, term, round(v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM raw""",
)
def tfidf(spark, sf):
    weighted = O.tfidf(documents(spark, sf), "doc_id", F.col("text"), min_df=0.01, max_df=0.85)
    return weighted.select("doc_id", "term", r6("tfidf").alias("tfidf"))


# the token index counts the training part only
_SPLIT = f"""SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {sql_hash('doc_id')}, doc_id)
  <= ceil(0.2 * (SELECT count(*) FROM documents)) THEN 'test' ELSE 'train' END AS split FROM documents"""
SQL_INDEX = f"""
  SELECT word, count(*) AS n,
         CAST(row_number() OVER (ORDER BY count(*) DESC, word) AS INTEGER) AS token_id
  FROM ({SQL_DOC_WORDS}) JOIN ({_SPLIT}) USING (doc_id) WHERE split = 'train' GROUP BY word
"""


def training_index(spark, sf):
    docs = documents(spark, sf)
    train = sampling.train_test_split(docs, "doc_id", 0.2).where("split = 'train'")
    return O.token_index(train, doc_tokens())


@query("token_index", SQL_INDEX)
def token_index(spark, sf):
    return training_index(spark, sf)


_SEQ = f"""
  SELECT d.doc_id, coalesce(s.seq, []) AS seq FROM documents d LEFT JOIN (
    SELECT doc_id, list(token_id ORDER BY pos) AS seq
    FROM ({SQL_DOC_WORDS}) JOIN ({SQL_INDEX}) USING (word) GROUP BY doc_id) s USING (doc_id)
"""


@query("to_sequence", f"SELECT doc_id, array_to_string(seq, ' ') AS seq FROM ({_SEQ})")
def to_sequence(spark, sf):
    seq = O.to_sequence(documents(spark, sf), "doc_id", doc_tokens(), training_index(spark, sf))
    return seq.select("doc_id", joined("seq", " ").alias("seq"))


_LENGTH = """(SELECT CAST(round_even(avg(len(regexp_extract_all(text, '[^\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+'))), 0) AS INTEGER) FROM documents)"""


@query(
    "pad_sequence",
    f"""SELECT doc_id, array_to_string(CASE WHEN len(seq) >= n THEN seq[len(seq) - n + 1:]
      ELSE list_concat(seq, list_transform(range(n - len(seq)), lambda i: 0)) END, ' ') AS seq
    FROM (SELECT doc_id, seq, {_LENGTH} AS n FROM ({_SEQ}))""",
)
def pad_sequence(spark, sf):
    docs = documents(spark, sf)
    length = O.sequence_length(docs, T.word_count(F.col("text")))
    seq = O.to_sequence(docs, "doc_id", doc_tokens(), training_index(spark, sf))
    return seq.select("doc_id", joined(pad(F.col("seq"), length), " ").alias("seq"))
