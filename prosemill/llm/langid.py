"""Language identification by prediction by partial matching.

A language's model is a variable-order tree of byte contexts, up to `order` bytes, with counts frozen
after training.  A byte's code length in the longest context that has seen it is -log2 of its count
over the context's total plus its number of distinct successors; each longer context that has not
seen it adds its escape, -log2 of distinct successors over the same sum.  Below order 0 all bytes
are equal.  A text's language is the one that codes it in the fewest bits; all bytes of the text
count.

Because the counts are frozen, a byte's code length depends on it and its `order` predecessors only.
So each n-gram's code lengths in all languages and, for an n-gram as a context, its escapes are
worked out once; scoring looks up the longest known n-gram that ends at each byte and adds the
escapes of the longer known contexts, all in arrays over many texts.

Training is on a bounded sample (allowed for a classifier): texts of each language in the order of a
hash of the id, until they hold `sample_bytes`.  A text counts with at most a share of bytes, a text
longer than that with a piece of that size at a place drawn by the hash, so that no one document is the
sample; this limits the fit only, whole texts are judged.  The share is `sample_bytes` / 16, doubled
until the language's texts fill the sample, at most `sample_bytes`.  n-grams are counted in Spark; the
model is a table of less than (order + 1) x (`sample_bytes` + share) n-grams per language and is what
tasks receive.

A-Z are lower-cased and digits are one symbol before anything else.

score: the winner's share of 2^-(bits), with code lengths brought to those of EVIDENCE bytes where a
text has more, so that it tells near ties from clear cases also in long texts.

Defined results: a text that is null or has no letter is `und` with score 0.  Ties go to the
language first in code point order.  Rows are judged each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prosemill.llm.common import slices, stored

ORDER = 3
SAMPLE_BYTES = 400_000
EVIDENCE = 64
UNDETERMINED = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[48:58] = 48


def _grams(data: np.ndarray, cuts: np.ndarray, n: int) -> np.ndarray:
    """The n-gram that ends at each byte, as an integer; -1 where a text begins less than n back."""
    out = np.zeros(len(data), np.int64)
    for k in range(n):
        out[n - 1 :] |= data[n - 1 - k : len(data) - k].astype(np.int64) << (8 * k)
    starts = cuts[:-1][np.diff(cuts) > 0]
    for k in range(min(n - 1, len(data))):
        at = starts + k
        out[at[at < len(data)]] = -1
    return out


def _counter(order: int):
    schema = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("gram", pa.int64()), ("count", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for lo, hi, data, cuts in slices(batch.column(1)):
                data = _FOLD[data]
                of = np.repeat(np.arange(hi - lo), np.diff(cuts))
                for lang in sorted(set(langs[lo:hi])):
                    mine = (langs[lo:hi] == lang)[of]
                    for n in range(1, order + 2):
                        grams = _grams(data, cuts, n)[mine]
                        grams, counts = np.unique(grams[grams >= 0], return_counts=True)
                        m = len(grams)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * m, pa.string()), pa.array(np.full(m, n, np.int32)),
                             pa.array(grams), pa.array(counts)], schema=schema,
                        )

    return count


def training_sample(docs: DataFrame, lang: str, text: str, id_col: str, sample_bytes: int) -> DataFrame:
    """(lang, text as bytes): texts of less than `sample_bytes` and a share in all for each language, by
    a hash of the id; of a text longer than the share, a piece.

    The first pass counts bytes by language and hash bucket for each possible share, the second by finer
    buckets inside the one in which the sample fills up, so that the window below sorts the sample and
    one part in 2^28 of a language's texts at most, not the table.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).cast("binary").alias("text"),
        F.octet_length(text).cast("long").alias("whole"),
        F.xxhash64(F.lit(5), F.col(id_col), F.col(text)).alias("draw"),
    )
    shares = [max(1, sample_bytes >> k) for k in range(4, -1, -1)]
    bucket = F.pmod("draw", F.lit(1 << 14))
    per = known.groupBy("lang", bucket.alias("bucket")).agg(
        *[F.sum(F.least("whole", F.lit(share))).alias(f"bytes{k}") for k, share in enumerate(shares)]
    )
    every = Window.partitionBy("lang")
    upto = every.orderBy("bucket")  # at most 2^14 rows for a language
    share, size = F.lit(shares[-1]), F.col(f"bytes{len(shares) - 1}")
    for k in range(len(shares) - 2, -1, -1):  # the smallest share that fills the sample
        fills = F.col(f"total{k}") >= sample_bytes
        share, size = F.when(fills, shares[k]).otherwise(share), F.when(fills, F.col(f"bytes{k}")).otherwise(size)
    totals = [F.sum(f"bytes{k}").over(every).alias(f"total{k}") for k in range(len(shares) - 1)]
    buckets = stored(
        per.select("*", *totals).select("lang", "bucket", share.cast("long").alias("share"), size.alias("bytes"))
        .withColumn("before", F.sum("bytes").over(upto) - F.col("bytes"))
        .where(F.col("before") < sample_bytes),
        "langid-buckets",
    )
    fine = F.pmod(F.shiftrightunsigned("draw", 14), F.lit(1 << 14))
    mine = known.withColumn("bucket", bucket).withColumn("fine", fine)
    filling = buckets.where(F.col("before") + F.col("bytes") >= sample_bytes)  # one bucket of a language
    inside = mine.select("lang", "bucket", "fine", "whole").join(filling, ["lang", "bucket"]).groupBy("lang", "fine").agg(
        F.sum(F.least("whole", "share")).alias("bytes"), F.first("before").alias("before")
    )
    so_far = F.sum("bytes").over(every.orderBy("fine")) - F.col("bytes")  # at most 2^14 rows for a language
    last = (
        inside.withColumn("so_far", F.col("before") + so_far).where(F.col("so_far") < sample_bytes)
        .groupBy("lang").agg(F.max("fine").alias("last"))
    )
    cuts = stored(
        buckets.join(last, "lang", "left").select(
            "lang", "bucket", "share",
            F.when(F.col("before") + F.col("bytes") >= sample_bytes, F.col("last")).alias("last"),
        ),
        "langid-cuts",
    )
    chosen = mine.join(cuts, ["lang", "bucket"]).where("last is null or fine <= last").select(
        "lang", "text", "draw", "whole", F.least("whole", "share").alias("bytes")
    )
    at = F.pmod(F.xxhash64("draw"), F.col("whole") - F.col("bytes") + 1).cast("int")
    piece = F.col("text").substr(at + 1, F.col("bytes").cast("int"))
    running = every.orderBy("draw").rowsBetween(Window.unboundedPreceding, -1)
    return (
        chosen.withColumn("text", piece)
        .withColumn("before", F.coalesce(F.sum("bytes").over(running), F.lit(0)))
        .where(F.col("before") < sample_bytes).select("lang", "text")
    )


class Model:
    """Code lengths and escapes of all n-grams: `languages`, and per n sorted keys with two arrays."""

    def __init__(self, counts, order: int):
        self.order = order
        self.languages = sorted(set(counts["lang"]), key=lambda x: x.encode("utf-32-be"))
        index = {x: i for i, x in enumerate(self.languages)}
        wide = len(self.languages)
        counts = counts.assign(lang=counts["lang"].map(index))
        self.keys, self.bits, self.escapes = [], [], []
        dense = []
        for n in range(1, order + 2):
            part = counts[counts["n"] == n]
            keys, row = np.unique(part["gram"].to_numpy(np.int64), return_inverse=True)
            table = np.zeros((len(keys), wide))
            np.add.at(table, (row, part["lang"].to_numpy()), part["count"].to_numpy(float))
            self.keys.append(keys)
            dense.append(table)
        below_bits = np.full((1, wide), 8.0)  # order -1: 256 equal bytes
        below_keys = np.zeros(1, np.int64)
        for n, (keys, table) in enumerate(zip(self.keys, dense), start=1):
            context = keys >> 8  # the n-gram without its last byte; its successors are all n-grams of it
            _, group = np.unique(context, return_inverse=True)
            total = np.zeros((int(group.max(initial=-1)) + 1, wide))
            kinds = np.zeros_like(total)
            np.add.at(total, group, table)
            np.add.at(kinds, group, table > 0)
            total, kinds = total[group], kinds[group]
            seen = kinds > 0
            with np.errstate(divide="ignore", invalid="ignore"):
                own = -np.log2(table / (total + kinds))
                escape = np.where(seen, -np.log2(kinds / (total + kinds)), 0.0)
            if n == 1:
                shorter = np.repeat(below_bits, len(keys), axis=0)
            else:
                suffix = keys & ((1 << (8 * (n - 1))) - 1)
                shorter = below_bits[np.searchsorted(below_keys, suffix)]
            bits = np.where(table > 0, own, escape + shorter)
            self.bits.append(bits.astype(np.float32))
            below_bits, below_keys = bits, keys
            # escapes of the contexts of n - 1 bytes, by context
            unique, first = np.unique(context, return_index=True)
            self.escapes.append((unique, escape[first].astype(np.float32)))
        self._pack()

    def _pack(self) -> None:
        """Open-addressed tables: slot -> key and row, for look-ups by array."""
        self.tables = [_Slots(k, b) for k, b in zip(self.keys, self.bits)]
        self.contexts = [_Slots(k, e) for k, e in self.escapes]
        del self.keys, self.bits, self.escapes

    def code_lengths(self, data: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Bits of each text in each language."""
        data = _FOLD[data]
        n = len(data)
        wide = len(self.languages)
        per_byte = np.zeros((n, wide), np.float32)
        open_ = np.arange(n)
        for m in range(self.order + 1, 0, -1):
            grams = _grams(data, cuts, m)[open_]
            whole = np.flatnonzero(grams >= 0)
            row = self.tables[m - 1].find(grams[whole])
            hit = row >= 0
            per_byte[open_[whole[hit]]] += self.tables[m - 1].values[row[hit]]
            # not seen here by any language: its context's escapes, if there is one, and one byte less
            miss = whole[~hit]
            row = self.contexts[m - 1].find(grams[miss] >> 8)
            known = row >= 0
            per_byte[open_[miss[known]]] += self.contexts[m - 1].values[row[known]]
            rest = np.ones(len(open_), bool)
            rest[whole[hit]] = False
            open_ = open_[rest]
            if not len(open_):
                break
        per_byte[open_] += 8.0
        sums = np.zeros((len(cuts) - 1, wide))
        full = np.flatnonzero(np.diff(cuts) > 0)
        if len(full):
            sums[full] = np.add.reduceat(per_byte, cuts[full], axis=0, dtype=np.float64)
        return sums


class _Slots:
    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = 64 - max(4, int(np.ceil(np.log2(max(len(keys), 1) * 4))))
        self.values = values
        size = 1 << (64 - self.shift)
        self.keys = np.full(size, -1, np.int64)
        self.rows = np.full(size, -1, np.int32)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            free = self.keys[slot[left]] < 0
            first = np.unique(slot[left][free], return_index=True)[1]
            placed = left[free][first]
            self.keys[slot[placed]] = keys[placed]
            self.rows[slot[placed]] = placed
            left = left[~np.isin(left, placed)]
            slot[left] = (slot[left] + 1) % size

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(self.shift)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where there is none."""
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.rows[slot], np.int32(-1))
        left = np.flatnonzero((held != keys) & (held >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) % len(self.keys)
            held = self.keys[slot[left]]
            hit = held == keys[left]
            out[left[hit]] = self.rows[slot[left[hit]]]
            left = left[~hit & (held >= 0)]
        return out


def train(docs: DataFrame, lang: str = "lang", text: str = "text", id_col: str = "doc_id",
          order: int = ORDER, sample_bytes: int = SAMPLE_BYTES) -> Model | None:
    """The model of all languages in `docs`; None if there is no labelled text."""
    sample = training_sample(docs, lang, text, id_col, sample_bytes)
    counts = (
        sample.mapInArrow(_counter(order), "lang string, n int, gram long, count long")
        .groupBy("lang", "n", "gram").agg(F.sum("count").alias("count"))
        .toArrow().to_pandas()
    )
    return Model(counts, order) if len(counts) else None


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def _judge(model: Model, texts: pa.Array, letter: np.ndarray, evidence: int):
    """(index of the language, score) of each text; texts without a letter get the index after all."""
    best = np.full(len(letter), len(model.languages))
    score = np.zeros(len(letter))
    for lo, hi, data, cuts in slices(texts, 1 << 18):
        bits = model.code_lengths(data, cuts)
        sizes = np.maximum(np.diff(cuts), 1)
        over = bits - bits.min(axis=1, keepdims=True)
        over *= np.minimum(1.0, evidence / sizes)[:, None]
        best[lo:hi] = bits.argmin(axis=1)
        score[lo:hi] = 1.0 / np.exp2(-over).sum(axis=1)
    best[~letter] = len(model.languages)
    score[~letter] = 0.0
    return best, score


def _predictor(sent, evidence: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())]
    )

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(sent.value.languages + [UNDETERMINED], dtype=object)
        for batch in batches:
            letter = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            best, score = _judge(sent.value, batch.column(1), letter, evidence)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[best], pa.string()), pa.array(score)], schema=schema
            )

    return predict


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
             evidence: int = EVIDENCE) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
        has_letter(F.col(text_col)).alias("letter"),
    )
    if model is None:
        return rows.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_predictor(sent, evidence), "doc_id long, lang_pred string, score double")


def identified(docs: DataFrame, model: Model | None, min_score: float = 0.5, text_col: str = "text",
               evidence: int = EVIDENCE) -> DataFrame:
    """The rows of `docs` whose text has a language with a score of at least `min_score`."""
    if model is None:
        return docs.where(F.lit(False))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letter = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            best, score = _judge(sent.value, batch.column(text_at), letter, evidence)
            good = pa.array((best < len(sent.value.languages)) & (score >= min_score))
            rest = batch.select(list(range(batch.num_columns - 1)))
            yield rest.filter(good)

    rows = docs.select("*", has_letter(F.col(text_col)).alias("__has_letter"))
    return rows.mapInArrow(keep, docs.schema)
