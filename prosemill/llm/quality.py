"""Quality rules: surface counts, and a log-likelihood ratio of hashed n-grams.

Two multinomials over `buckets` hashed word unigrams and bigrams: one of trusted target texts, one of
the raw corpus (every text).  A text's score is the sum over its n-grams of log(target / raw),
divided by their number; it is kept if no base rule fails and the score reaches a threshold, by default
one that the scores of the trusted texts set.

A text is scored by what the other texts say: its own n-grams are taken out of both counts first, so
trusted texts have no advantage over equal ones without a label, at any size.  A bucket's ratio is
(seen in the target + SHRINK) / (expected there from the raw share + SHRINK): buckets that few other
texts use say nothing either way.

The raw counts cover all texts in one pass, which adds up a task's counts in an array of `buckets`
places before anything is shuffled.  The target counts come from the same pass, over every trusted
text; the trusted ids are broadcast only if their bytes allow, else joined by a shuffle.  The model is
two numbers per bucket.

Defined results: null text has no words and fails the base rules, as empty text does.  A text without
n-grams scores 0.  Without trusted texts all scores are 0.  Rows are judged each, repeated rows
included; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm.common import U64, mix, slices, stored, word_hashes, word_spans
from prosemill.operators.scaling import lookup_join, nth_smallest

BUCKETS = 1 << 16
FENCE = 0.05  # the share of trusted texts that the threshold is measured from
SYMBOLS = b"#*$%&|<>"
SHRINK = 20.0  # n-grams by which a bucket's ratio is drawn towards 1

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_ODD = U64(0xA0761D6478BD642F)


def _text_of(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def _runs(first: np.ndarray, words: int) -> np.ndarray:
    """Positions of windows of `words` words that stay in their text."""
    text = _text_of(first)
    n = len(text)
    if n < words:
        return np.zeros(0, np.int64)
    return np.flatnonzero(text[: n - words + 1] == text[words - 1 :])


def _grams(hashes: np.ndarray, first: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of all unigrams and bigrams."""
    text = _text_of(first)
    pairs = _runs(first, 2)
    two = mix(hashes[pairs] * _ODD + hashes[pairs + 1]) if len(pairs) else np.zeros(0, U64)
    keys = np.concatenate([hashes, two]) % U64(buckets)
    return keys.astype(np.int64), np.concatenate([text, text[pairs]])


def _counter(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            trusted = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi, data, cuts in slices(batch.column(0)):
                starts, ends, first = word_spans(data, cuts)
                bucket, text = _grams(word_hashes(data, starts, ends), first, buckets)
                raw += np.bincount(bucket, minlength=buckets)
                target += np.bincount(bucket[trusted[lo:hi][text]], minlength=buckets)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array(used.astype(np.int32)), "raw": pa.array(raw[used]), "target": pa.array(target[used])}
        )

    return count


def trusted_ids(labels: DataFrame, most: int | None = None, id_col: str = "doc_id",
                quality_col: str = "quality") -> DataFrame:
    """Ids of the rows labelled 1: all of them, or `most` by a hash of the id."""
    good = labels.where(F.col(quality_col) == 1).where(F.col(id_col).isNotNull())
    ids = good.select(F.col(id_col).alias("trusted_id")).distinct()
    return ids if most is None else ids.orderBy(F.xxhash64(F.lit(3), "trusted_id"), "trusted_id").limit(most)


def _marked(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, trusted) with `trusted` (trusted_id) looked up."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = trusted.select(F.col("trusted_id").alias("doc_id"), F.lit(True).alias("__yes"))
    return lookup_join(rows, known, "doc_id", "left").select(
        "doc_id", "text", F.coalesce("__yes", F.lit(False)).alias("trusted")
    )


def corpus_counts(marked: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of all texts and of the trusted ones, by bucket."""
    counts = (
        marked.select("text", "trusted")
        .mapInArrow(_counter(buckets), "bucket int, raw long, target long")
        .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toArrow()  # one row per bucket
    )
    raw, target = np.zeros(buckets), np.zeros(buckets)
    at = counts.column("bucket").to_numpy()
    raw[at], target[at] = counts.column("raw").to_numpy(), counts.column("target").to_numpy()
    return raw, target


def mean_log_ratios(raw, target, bucket, text, trusted, shrink: float) -> np.ndarray:
    """The score of each text; `bucket` and `text` tell the n-grams, `trusted` is by text."""
    if not target.sum():
        return np.zeros(len(trusted))
    own, uses = np.unique(text * len(raw) + bucket, return_counts=True)
    text, bucket = own // len(raw), own % len(raw)
    many = np.bincount(text, weights=uses, minlength=len(trusted))
    mine = trusted[text]
    others = raw[bucket] - uses
    seen = target[bucket] - uses * mine
    in_all = np.maximum(raw.sum() - many[text], 1)
    in_target = np.maximum(target.sum() - many[text] * mine, 0)
    ratio = np.log((seen + shrink) / (in_target * others / in_all + shrink))
    return np.bincount(text, weights=ratio * uses, minlength=len(trusted)) / np.maximum(many, 1)


_MEASURES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, score double"
)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split(b"\n")
    distinct = set(lines)
    if len(distinct) == len(lines):
        return 0
    lines = [x for x in lines if x.strip()]  # bytes strip the six blanks
    return len(lines) - len(set(lines))


def _per_text(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[cuts[1:]] - sums[cuts[:-1]]


def _measurer(sent, buckets: int, shrink: float):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = sent.value
        for batch in batches:
            trusted = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            out: list[list] = [[] for _ in range(6)]
            for lo, hi, data, cuts in slices(batch.column(1)):
                starts, ends, first = word_spans(data, cuts)
                hashes = word_hashes(data, starts, ends)
                n = np.diff(first)
                inside = np.zeros(len(data) + 1, np.int8)  # 1 in words
                inside[starts] += 1
                np.subtract.at(inside, ends, 1)
                inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
                chars = _per_text(inside & ((data & 0xC0) != 0x80), cuts)
                symbols = _per_text(_IS_SYMBOL[data], cuts)
                whole = data.tobytes()
                lines = [repeated_lines(whole[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                at = _runs(first, 3)
                covered = np.zeros(len(hashes), bool)
                if len(at):
                    keys = mix(hashes[at] * _ODD + hashes[at + 1])
                    keys = mix(keys * _ODD + hashes[at + 2])
                    keys = mix(keys + _text_of(first)[at].astype(U64) * U64(0xE7037ED1A0B428DB))
                    order = np.argsort(keys, kind="stable")
                    ranked = keys[order]
                    same = ranked[1:] == ranked[:-1]
                    twice = np.concatenate([order[1:][same], order[:-1][same]])
                    for k in range(3):
                        covered[at[twice] + k] = True
                repeats = _per_text(covered, first)
                bucket, text = _grams(hashes, first, buckets)
                score = mean_log_ratios(raw, target, bucket, text, trusted[lo:hi], shrink)
                for column, values in zip(out, (n, chars, symbols, lines, repeats, score)):
                    column.append(np.asarray(values))
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(pa.int64())]
                    + [pa.array(np.concatenate(c).astype(np.int64)) for c in out[:5]]
                    + [pa.array(np.concatenate(out[5]))],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"],
                )

    return measure


def threshold_of(measured: DataFrame, trusted: DataFrame) -> float:
    """As far below the 5th percentile of the trusted texts' scores as that is below their median.

    The scores are those that leave the text itself out, of texts that pass the base rules; their spread
    sets the distance, so the threshold follows the size of the tables.  Without trusted texts all pass.
    """
    passed = measured.where(~F.col("base_failed")).select("doc_id", "score")
    scores = lookup_join(passed, trusted.select(F.col("trusted_id").alias("doc_id")), "doc_id", "left_semi")
    scores = stored(scores.select("score"), "quality-trusted-scores")
    n = scores.count()
    if not n:
        return float("-inf")
    low, middle = (_quantile(scores, n, q) for q in (FENCE, 0.5))
    return round(2 * low - middle, 9)


def _quantile(scores: DataFrame, n: int, q: float) -> float:
    """The exact quantile of the n scores between its two neighbours, as `percentile` has it, from histograms."""
    place = q * (n - 1)
    at = int(place)
    value, below, equal = nth_smallest(scores, F.col("score"), at + 1)
    if place == at or below + equal >= at + 2:
        return value
    after, _, _ = nth_smallest(scores, F.col("score"), at + 2)
    return (at + 1 - place) * value + (place - at) * after


def assess(docs: DataFrame, trusted: DataFrame, threshold: float | None = None, buckets: int = BUCKETS,
           shrink: float = SHRINK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, the counts, score, base_failed, kept) of every row.

    Without a threshold it is taken from the trusted texts' scores.
    """
    trusted = stored(trusted.select("trusted_id").where("trusted_id is not null").distinct(), "quality-trusted")
    marked = _marked(docs, trusted, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(corpus_counts(marked, buckets))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = (
        marked.mapInArrow(_measurer(sent, buckets, shrink), _MEASURES)
        .withColumn("score", F.round("score", 9))
        .withColumn("base_failed", failed)
    )
    if threshold is None:
        measured = stored(measured, "quality-measures")
        threshold = threshold_of(measured, trusted)
    return measured.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
