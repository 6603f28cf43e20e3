"""Term statistics, TF-IDF, vocabularies and token sequences."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prosemill import dims
from prosemill.functions.text import drop_stopwords, tokenize_terms
from prosemill.operators.scaling import lookup_join, with_position
from prosemill.session import cut_lineage


def exploded(df: DataFrame, keep: Sequence[str], tokens: Column, name: str = "word") -> DataFrame:
    """(keep..., name): one row per token.

    An outer generator and a null filter after it: for an inner one the
    optimiser adds a filter below that computes the tokens a second time.
    """
    rows = df.select(*keep, F.explode_outer(tokens).alias(name))
    return rows.where(F.col(name).isNotNull())


def term_frequency(
    df: DataFrame, id_col: str, tokens: Column, keep_empty: bool = False
) -> DataFrame:
    """(id, term, tf), counted inside each row: no shuffle.

    The tokens are sorted and the lengths of equal runs taken.  Each step is its
    own projection, used by the next more than once, so that it is computed
    once; lambdas see only their own arguments (a captured array would be
    computed again for every element).  `keep_empty` keeps rows without tokens,
    with null term and tf.
    """
    before = F.concat(F.array(F.lit(None).cast("string")), F.col("_s")).alias("before")
    sorted_ = df.select(id_col, F.sort_array(tokens).alias("_s"))
    starts = sorted_.select(
        id_col,
        F.size("_s").alias("_n"),
        F.filter(
            F.transform(
                F.arrays_zip(F.col("_s").alias("term"), before),
                lambda p, i: F.struct(
                    p["term"].alias("term"),
                    F.when(
                        p["term"].isNotNull() & ~p["term"].eqNullSafe(p["before"]), i
                    ).alias("pos"),
                ),
            ),
            lambda p: p["pos"].isNotNull(),
        ).alias("_runs"),
    )
    stops = F.concat(
        F.slice("_runs.pos", 2, F.greatest(F.size("_runs"), F.lit(1))), F.array("_n")
    ).alias("stop")
    runs = starts.select(
        id_col,
        F.inline_outer(
            F.slice(
                F.arrays_zip(
                    F.col("_runs.term").alias("term"), F.col("_runs.pos").alias("pos"), stops
                ),
                F.lit(1),
                F.greatest(F.size("_runs"), F.lit(0)),
            )
        ),
    )
    counted = runs.select(id_col, "term", (F.col("stop") - F.col("pos")).cast("long").alias("tf"))
    return counted if keep_empty else counted.where(F.col("term").isNotNull())


def word_counts(df: DataFrame, tokens: Column) -> DataFrame:
    """(word, n) over all rows."""
    return exploded(df, [], tokens).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_frequency_min(df: DataFrame, tokens: Column, min_count: int = 2) -> DataFrame:
    """(word, n) of the words seen at least `min_count` times."""
    return word_counts(df, tokens).where(F.col("n") >= min_count)


def vocab_size(df: DataFrame, tokens: Column) -> DataFrame:
    """Number of distinct tokens."""
    return exploded(df, [], tokens).agg(F.count_distinct("word").alias("vocab_size"))


def top_words(df: DataFrame, tokens: Column, n: int = 100) -> DataFrame:
    """The n most frequent words."""
    return word_counts(df, tokens).orderBy(F.desc("n"), "word").limit(n)


def _df_bound(limit: float | int, docs: int) -> float:
    """A fraction of the documents, or a count if given as an integer."""
    return limit if isinstance(limit, int) else limit * docs


def document_frequency(
    df: DataFrame,
    tokens: Column,
    min_df: float | int = 1,
    max_df: float | int = 1.0,
) -> DataFrame:
    """(term, df) of the terms within the document-frequency cuts (both inclusive)."""
    docs = df.count()
    counts = (
        exploded(df, [], F.array_distinct(tokens), "term")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )
    return counts.where(
        (F.col("df") >= F.lit(_df_bound(min_df, docs)))
        & (F.col("df") <= F.lit(_df_bound(max_df, docs)))
    )


def tfidf(
    df: DataFrame,
    id_col: str,
    text: Column,
    stop: Sequence[str] = dims.STOP_WORDS,
    min_df: float | int = 0.01,
    max_df: float | int = 0.85,
) -> DataFrame:
    """(id, term, tfidf): tf * (ln((1+N)/(1+df)) + 1), unit length per document.

    Term counts come from inside the row.  The weights join on the term: with a
    fractional `min_df` the kept vocabulary is at most (distinct terms per
    document)/min_df and is broadcast once its size was checked; otherwise the
    hot terms of the shuffle join are salted.  One shuffle by document follows
    for the norm.
    """
    tokens = drop_stopwords(tokenize_terms(F.lower(text)), stop)
    docs = df.count()
    weights = cut_lineage(
        document_frequency(df, tokens, min_df, max_df).select(
            "term", (F.log(F.lit(1.0 + docs) / (1 + F.col("df"))) + 1).alias("idf")
        )
    )
    tf = term_frequency(df, id_col, tokens)
    raw = lookup_join(tf, weights, "term").withColumn("raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(id_col)))
    return raw.select(id_col, "term", (F.col("raw") / norm).alias("tfidf"))


def token_index(df: DataFrame, tokens: Column) -> DataFrame:
    """(word, n, token_id): ids from 1 by falling frequency, ties by word.

    The vocabulary is numbered by a distributed sort, not by a window over one
    partition, since it grows with the corpus.
    """
    counts = word_counts(df, tokens)
    ranked = with_position(counts, [F.desc("n"), F.col("word")], "token_id")
    return ranked.withColumn("token_id", (F.col("token_id") + 1).cast("int"))


def to_sequence(df: DataFrame, id_col: str, tokens: Column, index: DataFrame) -> DataFrame:
    """(id, seq array<int>): token ids in text order, unknown tokens dropped."""
    words = df.select(id_col, F.posexplode_outer(tokens).alias("pos", "word"))
    hits = lookup_join(words, index.select("word", "token_id"), "word", "left")
    pairs = F.collect_list(
        F.when(F.col("token_id").isNotNull(), F.struct("pos", "token_id"))
    )
    return hits.groupBy(id_col).agg(F.sort_array(pairs)["token_id"].alias("seq"))


def sequence_length(df: DataFrame, word_count: Column) -> int:
    """The pad length: the mean word count, rounded half to even."""
    mean = df.agg(F.avg(word_count)).first()[0]
    return int(round(mean)) if mean is not None and not math.isnan(mean) else 0
