"""Vector arithmetic on array<double> columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def dot_const(a: Column, weights: Sequence[float]) -> Column:
    """Dot product with a known vector, written out so that it compiles."""
    total = F.lit(0.0)
    for i, w in enumerate(weights):
        total = total + F.get(a, F.lit(i)).cast("double") * F.lit(float(w))
    return total


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a: Column, b: Column) -> Column:
    """a.b / (|a||b|); 0 when either vector is zero."""
    size = norm(a) * norm(b)
    return F.when(size == 0, F.lit(0.0)).otherwise(dot(a, b) / F.nullif(size, F.lit(0.0)))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - cosine_similarity(a, b)


def l2_normalize(a: Column) -> Column:
    """The vector at unit length; a zero vector stays zero.

    The norm enters as a repeated array so that it is computed once per row,
    not once per element.
    """
    n = norm(a)
    n = F.when(n == 0, F.lit(1.0)).otherwise(n)
    return F.zip_with(a, F.array_repeat(n, F.size(a)), lambda x, m: x.cast("double") / m)


def argmax_class(a: Column) -> Column:
    """Position (0-based) of the largest element, the first if several."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def threshold_label(p: Column, cut: float = 0.5) -> Column:
    """1 when the score is above `cut`, else 0."""
    return (p > cut).cast("int")


def pad_sequence(seq: Column, length: int) -> Column:
    """Exactly `length` ids: long sequences lose their front, short ones get zeros at the end."""
    n = F.size(seq)
    return F.when(n >= length, F.slice(seq, F.greatest(n - length + 1, F.lit(1)), length)).otherwise(
        F.concat(seq, F.array_repeat(F.lit(0), F.greatest(F.lit(length) - n, F.lit(0))))
    )
