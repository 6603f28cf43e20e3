"""Stored intermediate results, Arrow slices and word tables shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill.session import scratch_path

# Words are runs of anything but these six characters; all are single bytes in UTF-8.
WORD = r"[^\x20\x09-\x0D]+"
BLANK_BYTES = (9, 10, 11, 12, 13, 32)
SPACE = np.zeros(256, dtype=bool)
SPACE[list(BLANK_BYTES)] = True

# Bytes of text handled at once by the array code; longer texts are handled alone.
SLICE_BYTES = 1 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again.

    Cuts the lineage: a lost executor costs at most the stages since the last
    stored table.  The files go when the session ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(schema).parquet(path)


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet").select(*columns)


def word_count(text) -> F.Column:
    """Words of a text column as long; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, cuts): text i of a string column is bytes[cuts[i]:cuts[i + 1]]; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    kind = pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string()
    column = column.cast(kind)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    cuts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]], cuts - cuts[0]


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple]:
    """(first row, end row, bytes, cuts) for runs of texts of about `most` bytes."""
    data, cuts = utf8(column)
    n, lo = len(cuts) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(cuts, cuts[lo] + most, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[cuts[lo] : cuts[hi]], cuts[lo : hi + 1] - cuts[lo]
        lo = hi


def word_spans(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of all words; first[i] is the first word of text i."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(cuts), np.int64)
    blank = SPACE[data]
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = blank[:-1]
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = blank[1:]
    inner = cuts[(cuts > 0) & (cuts < n)]
    before[inner] = True
    after[inner - 1] = True
    starts = np.flatnonzero(before & ~blank)
    ends = np.flatnonzero(after & ~blank) + 1
    return starts, ends, np.searchsorted(starts, cuts)


U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), dtype=U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_IN_WORD = [_powers(_BASE, 256)]
_WORD_POWERS = {"up": np.zeros(0, U64), "down": np.zeros(0, U64)}


def _in_word(n: int) -> np.ndarray:
    if len(_IN_WORD[0]) < n:
        _IN_WORD[0] = _powers(_BASE, 2 * n)
    return _IN_WORD[0]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, U64)
    lens = ends - starts
    first = np.cumsum(lens) - lens
    at = np.arange(int(lens.sum())) - np.repeat(first, lens)
    own = _BYTE_VALUES[data[at + np.repeat(starts, lens)]] * _in_word(int(lens.max()))[at]
    return mix(np.add.reduceat(own, first) + lens.astype(U64))


class Rolling:
    """Hashes of any run of words in O(1) each, from prefix sums modulo 2^64."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes) + 1
        if len(_WORD_POWERS["up"]) < n:
            odd = 0xD1342543DE82EF95
            _WORD_POWERS["up"] = _powers(odd, 2 * n)
            _WORD_POWERS["down"] = _powers(pow(odd, -1, 2**64), 2 * n)
        self.sums = np.zeros(n, U64)
        np.cumsum(hashes * _WORD_POWERS["up"][: n - 1], out=self.sums[1:])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * _WORD_POWERS["down"][starts])


def int_matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """A list column of whole numbers as rows of equal length, padded with zeros (cut at `width`)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    wide = int(sizes.max(initial=0)) if width is None else width
    if len(sizes) and (sizes == wide).all():
        return values.reshape(len(sizes), wide)
    out = np.zeros((len(sizes), wide), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    fits = at < wide
    out[row[fits], at[fits]] = values[fits]
    return out
