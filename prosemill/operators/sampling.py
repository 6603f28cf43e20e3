"""Deterministic sampling, splitting and balancing by id hash.

Rows are ordered by a hash of (id, seed), so the same rows are chosen on any
cluster, at any partitioning, and after any retry.  Exact sizes come from the
n-th smallest hash, so choosing rows is a filter: no sort, no shuffle of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.operators.scaling import nth_smallest


def id_hash(id_col: str, seed: int = 42) -> Column:
    """A 60-bit number from md5(id|seed); the same in any engine with md5."""
    digest = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _first_by_hash(df: DataFrame, id_col: str, n: int, seed: int) -> Column:
    """The condition that holds for the n rows with the smallest (hash, id)."""
    h = id_hash(id_col, seed)
    if n <= 0:
        return F.lit(False)
    cut, below, equal = nth_smallest(df.select(id_col), h, n, (0, (1 << 60) - 1))
    if cut is None:
        return F.lit(True)
    if below + equal == n:
        return h <= F.lit(cut)
    tied = df.select(id_col).where(h == F.lit(cut))
    last = tied.orderBy(id_col).limit(n - below).agg(F.max(id_col)).first()[0]
    return (h < F.lit(cut)) | ((h == F.lit(cut)) & (F.col(id_col) <= F.lit(last)))


def sample_n(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (all if there are fewer); `id_col` must be unique."""
    return df.where(_first_by_hash(df, id_col, n, seed))


def sample_fraction(df: DataFrame, id_col: str, fraction: float, seed: int = 42) -> DataFrame:
    """round(fraction x rows) rows, exactly (halves round to even)."""
    if fraction >= 1.0:
        return df
    return sample_n(df, id_col, round(fraction * df.count()), seed)


def train_test_split(df: DataFrame, id_col: str, test: float = 0.25, seed: int = 42) -> DataFrame:
    """`df` with a `split` column; the test part has exactly ceil(test x rows) rows."""
    chosen = _first_by_hash(df, id_col, math.ceil(test * df.count()), seed)
    return df.withColumn("split", F.when(chosen, "test").otherwise("train"))


def holdout_tail(df: DataFrame, id_col: str, share: float = 0.2, seed: int = 43) -> DataFrame:
    """Training rows with a `holdout` flag on a hash share of them."""
    bucket = id_hash(id_col, seed) % 10_000
    return df.withColumn("holdout", bucket >= int(round((1 - share) * 10_000)))


def fold_of(id_col: str, folds: int = 5, seed: int = 44) -> Column:
    """Fold number 0..folds-1 of a row."""
    return (id_hash(id_col, seed) % folds).cast("int")


def shuffle(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """Rows in a random but repeatable order."""
    return df.orderBy(id_hash(id_col, seed), id_col)


def balance_classes(
    df: DataFrame, id_col: str, label: str, n_negative: int, positive_share: float, seed: int = 42
) -> DataFrame:
    """n_negative rows with label 0 and a share of the rows with label 1."""
    negative = sample_n(df.where(F.col(label) == 0), id_col, n_negative, seed)
    positive = sample_fraction(df.where(F.col(label) == 1), id_col, positive_share, seed)
    return negative.unionByName(positive)
