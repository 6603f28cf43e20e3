"""Spelling correction as a corpus-wide job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.operators.scaling import lookup_join
from prosemill.operators.terms import word_counts
from prosemill.session import cut_lineage


def _deletions(word: Column) -> Column:
    """The word and every string with one character removed."""
    return F.array_union(
        F.array(word),
        F.transform(
            F.sequence(F.lit(1), F.length(word)),
            lambda i: F.concat(
                F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))
            ),
        ),
    )


def _swapped(a: Column, b: Column) -> Column:
    """Whether two words differ by exchanging two neighbouring characters, in one pass over both."""
    pairs = F.arrays_zip(F.split(a, "").alias("x"), F.split(b, "").alias("y"))
    differing = F.filter(
        F.transform(pairs, lambda p, i: F.struct(i.alias("i"), p["x"].alias("x"), p["y"].alias("y"))),
        lambda p: p["x"] != p["y"],
    )
    crossed = F.exists(
        F.array(differing),
        lambda d: (F.size(d) == 2)
        & (F.get(d["i"], F.lit(1)) == F.get(d["i"], F.lit(0)) + 1)
        & (F.get(d["x"], F.lit(0)) == F.get(d["y"], F.lit(1)))
        & (F.get(d["x"], F.lit(1)) == F.get(d["y"], F.lit(0))),
    )
    return F.when((F.length(a) == F.length(b)) & (F.levenshtein(a, b, 2) == 2), crossed).otherwise(False)


# Words up to here meet on their deletions, longer ones on halves (fewer and shorter keys).
SHORT = 24


def _half(n: Column) -> Column:
    """The length of a half of a word of n characters: two characters lie between its halves."""
    return F.floor(n / 2).cast("int") - 1


def _halves(word: Column, of_length: Column) -> Column:
    """First and last half as they are in a word of `of_length` characters."""
    n = of_length.cast("string")
    return F.array(
        F.concat(F.lit("<"), n, F.lit("|"), F.left(word, _half(of_length))),
        F.concat(F.lit(">"), n, F.lit("|"), F.right(word, _half(of_length))),
    )


def spelling_map(
    rare: DataFrame, dictionary: DataFrame, min_chars: int = 1
) -> DataFrame:
    """(word, corrected): the most frequent dictionary word one edit away.

    An edit inserts, deletes, replaces or swaps neighbouring characters.  Words
    one edit apart share a string with at most one character deleted, so short
    words meet on such keys in an equi join; a key of length L is shared by at
    most (L+1) x alphabet words.  In a long word an edit leaves the first or the
    last half as it is, so long words meet on halves: eight keys in all, each
    shorter than the word.
    """
    size = F.length("word")
    keyed = rare.where(size >= min_chars).select(
        "word",
        F.explode(
            F.when(size <= SHORT, _deletions(F.col("word"))).otherwise(_halves(F.col("word"), size))
        ).alias("key"),
    )
    near_lengths = F.flatten(
        F.transform(F.sequence(size - 1, size + 1), lambda n: _halves(F.col("word"), n))
    )
    none = F.array().cast("array<string>")
    known = dictionary.select(
        F.col("word").alias("candidate"), "n",
        F.explode(
            F.concat(
                F.when(size <= SHORT + 1, _deletions(F.col("word"))).otherwise(none),
                F.when(size >= SHORT, near_lengths).otherwise(none),
            )
        ).alias("key"),
    )
    near = (
        keyed.join(known, "key")
        .select("word", "candidate", "n")
        .where(
            (F.levenshtein("word", "candidate", 1) == 1)
            | _swapped(F.col("word"), F.col("candidate"))
        )
    )
    best = F.min_by("candidate", F.struct((-F.col("n")).alias("n"), F.col("candidate").alias("c")))
    return near.groupBy("word").agg(best.alias("corrected"))


def correct_spelling(
    df: DataFrame,
    id_col: str,
    tokens: Column,
    min_count: int = 5,
    dictionary: DataFrame | None = None,
    min_chars: int = 1,
) -> DataFrame:
    """(id, tokens): words outside the dictionary replaced by the nearest frequent word.

    Without a dictionary (word, n), the corpus words seen at least `min_count`
    times are the dictionary.  The tokens are made once and stored.  Only a
    document's words that have a correction are shuffled; they come back as one
    map for the document, and its token array is rewritten in place.
    """
    texts = cut_lineage(df.select(id_col, tokens.alias("tokens")))
    counts = cut_lineage(word_counts(texts, F.col("tokens")))
    if dictionary is None:
        known = counts.where(F.col("n") >= min_count)
        unknown = counts.where(F.col("n") < min_count)
    else:
        known = dictionary
        unknown = counts.join(dictionary.select("word"), "word", "left_anti")
    fixes = cut_lineage(spelling_map(unknown.select("word"), known, min_chars))
    words = texts.select(id_col, F.explode(F.array_distinct("tokens")).alias("word"))
    changes = (
        lookup_join(words, fixes, "word")
        .groupBy(id_col)
        .agg(F.map_from_entries(F.collect_set(F.struct("word", "corrected"))).alias("_fix"))
    )
    return texts.join(changes, id_col, "left").select(
        id_col,
        F.when(
            F.col("_fix").isNotNull(),
            F.transform("tokens", lambda t: F.coalesce(F.try_element_at("_fix", t), t)),
        ).otherwise(F.col("tokens")).alias("tokens"),
    )
