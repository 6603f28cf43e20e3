"""Repeated passages across documents, by difference-cover anchors.

A window is `length` consecutive words.  Positions are taken modulo a period v with a difference
cover D: for any two positions some shift below v brings both into D.  So two equal windows hold, at
one common shift, equal anchors of length - v + 1 words that begin at cover positions in both texts.
Only anchors are hashed and grouped: |D| of every v words (6 of 31 for 50 words).  Anchors that two
different texts share are then extended: every window around them is hashed whole and grouped, and a
window that a document with a smaller id has too covers words to remove.

Exact copies are one text here, with the smallest of its ids; the other copies are removed as a
whole (if they have a window).  Groups are reduced to a smallest and a largest member map-side, never
gathered; what joins back to them is a stored table, so that skew handling can split the rows of a
passage that very many documents share.  Texts are shuffled once, compressed, and those with a
shared anchor once more.  Windows are told apart by 64-bit hashes of 64-bit word hashes: among 10^9
windows that share anchors a chance collision has probability 0.03.

Defined results: null or blank text has no words.  A row without an id is compared with nothing.
Rows of equal id are one document: a window of theirs is no repeat of the other's.  Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm.common import U64, Rolling, mix, slices, stored, word_hashes, word_spans

LENGTH = 50

# Perfect difference sets by period.
DIFFERENCE_SETS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
}


def cover(length: int) -> tuple[int, np.ndarray]:
    """(period, flags by residue): the longest period that leaves anchors of at least 2/5 of a window."""
    period = max(v for v in DIFFERENCE_SETS if v == 1 or 5 * (length - v + 1) >= 2 * length)
    flags = np.zeros(period, bool)
    flags[list(DIFFERENCE_SETS[period])] = True
    return period, flags


class _Words:
    """Word hashes of a slice of texts."""

    def __init__(self, data, cuts):
        starts, ends, self.first = word_spans(data, cuts)
        self.n = np.diff(self.first)
        self.roll = Rolling(word_hashes(data, starts, ends))
        # a text's own hash: all its words, and how many
        self.content = mix(
            self.roll.runs(self.first[:-1], self.first[1:]) + self.n.astype(U64) * U64(0x9FB21C651E98DF25)
        ).view(np.int64)

    def anchors(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, position in it, hash) of the anchors of texts that have a window."""
        period, flags = cover(length)
        words = length - period + 1
        text = np.repeat(np.arange(len(self.n)), self.n)
        at = np.arange(len(text)) - self.first[:-1][text] if len(text) else np.zeros(0, np.int64)
        n = self.n[text]
        use = np.flatnonzero(flags[at % period] & (n >= length) & (at + words <= n))
        return text[use], at[use], self.roll.runs(use, use + words).view(np.int64)


def _measurer():
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("cid", pa.int64()), ("sha", pa.string())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, cuts in slices(batch.column(1)):
                words = _Words(data, cuts)
                whole = data.tobytes()
                sha = [
                    hashlib.sha256(b" ".join(whole[a:b].split())).hexdigest()
                    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).cast(pa.int64()), pa.array(words.n),
                     pa.array(words.content), pa.array(sha, pa.string())], schema=schema,
                )

    return measure


def _anchorer(length: int):
    schema = pa.schema([("h", pa.int64()), ("cid", pa.int64())])

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, cuts in slices(batch.column(0)):
                words = _Words(data, cuts)
                text, _, h = words.anchors(length)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(words.content[text])], schema=schema)

    return anchors


def _packer(length: int):
    schema = pa.schema([("doc_id", pa.int64()), ("cid", pa.int64()), ("packed", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, _, data, cuts in slices(batch.column(1)):
                words = _Words(data, cuts)
                use = np.flatnonzero(words.n >= length)
                packed = [press.compress(data[cuts[i] : cuts[i + 1]].tobytes()) for i in use.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[lo + use].astype(np.int64)), pa.array(words.content[use]),
                     pa.array(packed, pa.binary())], schema=schema,
                )

    return pack


def _texts(packed: pa.Array) -> Iterator[np.ndarray]:
    unpress = zstandard.ZstdDecompressor()
    for x in packed:
        yield np.frombuffer(unpress.decompress(x.as_buffer()), np.uint8)


def _windower(length: int):
    schema = pa.schema([("w", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int32())])
    period, _ = cover(length)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc, data, shared in zip(ids, _texts(batch.column("packed")), batch.column("shared")):
                words = _Words(data, np.array([0, len(data)]))
                _, at, h = words.anchors(length)
                at = at[np.isin(h, shared.values.to_numpy(zero_copy_only=False))]
                # an anchor is in the windows that begin at it or up to period - 1 words before
                steps = np.zeros(int(words.n[0]) + 2, np.int64)
                np.add.at(steps, np.maximum(at - period + 1, 0), 1)
                np.add.at(steps, at + 1, -1)
                pos = np.flatnonzero(np.cumsum(steps)[: int(words.n[0]) - length + 1] > 0)
                w = words.roll.runs(pos, pos + length).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w), pa.array(np.full(len(pos), doc, np.int64)), pa.array(pos.astype(np.int32))],
                    schema=schema,
                )

    return windows


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))


def _remover(length: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("cid", pa.int64()), ("n_removed", pa.int64()), ("removed", _SPANS),
         ("kept_sha", pa.string())]
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, cid, data, hits in zip(
                batch.column("doc_id").to_pylist(), batch.column("cid").to_pylist(),
                _texts(batch.column("packed")), batch.column("hits"),
            ):
                words = data.tobytes().split()
                steps = np.zeros(len(words) + 1, np.int64)
                at = np.unique(hits.values.to_numpy(zero_copy_only=False)).astype(np.int64)
                steps[at] += 1
                np.subtract.at(steps, at + length, 1)
                gone = np.cumsum(steps)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                spans = [{"first": int(a), "words": int(b - a)} for a, b in edge.reshape(-1, 2)]
                kept = b" ".join(words[i] for i in np.flatnonzero(~gone).tolist())
                rows.append((doc, cid, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema
                )

    return remove


def repeated_passages(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, removed, kept_sha256) of every row.

    removed: runs of words (first, words) that windows of smaller documents cover; kept_sha256: of the
    other words, joined by one space.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = stored(
        rows.mapInArrow(_measurer(), "doc_id long, n_words long, cid long, sha string"), "substrings-docs"
    )
    texts = stored(
        known.where((F.col("n_words") >= length) & F.col("doc_id").isNotNull())
        .groupBy("sha", "cid").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")),
        "substrings-texts",
    )

    # anchors that different texts share, by text
    anchors = rows.where("doc_id is not null").select("text").mapInArrow(_anchorer(length), "h long, cid long")
    shared = stored(
        anchors.groupBy("h").agg(F.min("cid").alias("a"), F.max("cid").alias("b")).where("a < b").select("h"),
        "substrings-anchors",
    )
    by_text = (
        anchors.join(shared, "h", "left_semi").groupBy("cid").agg(F.collect_set("h").alias("shared"))
        .join(texts.select("cid", "doc_id"), "cid")
    )
    packed = rows.where("doc_id is not null").mapInArrow(_packer(length), "doc_id long, cid long, packed binary")
    chosen = stored(
        packed.join(by_text, ["doc_id", "cid"]).dropDuplicates(["doc_id", "cid"]), "substrings-chosen"
    )

    # whole windows around them, and which of them a smaller document has too
    windows = chosen.select("doc_id", "packed", "shared").mapInArrow(
        _windower(length), "w long, doc_id long, pos int"
    )
    firsts = stored(
        windows.groupBy("w").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last").select("w", "first"),
        "substrings-windows",
    )
    hits = (
        windows.join(firsts, "w").where("doc_id > first")
        .groupBy("doc_id").agg(F.collect_list("pos").alias("hits"))
    )
    cut = stored(
        chosen.select("doc_id", "cid", "packed").join(hits, "doc_id").select("doc_id", "cid", "packed", "hits")
        .mapInArrow(
            _remover(length),
            "doc_id long, cid long, n_removed long, removed array<struct<first:long,words:long>>, kept_sha string",
        ),
        "substrings-cut",
    )

    copied = stored(
        texts.where("copies > 1").select("sha", F.col("doc_id").alias("original")), "substrings-copies"
    )
    is_copy = F.coalesce(F.col("doc_id") > F.col("original"), F.lit(False)) & (F.col("n_words") >= length)
    nothing = F.array().cast("array<struct<first:bigint,words:bigint>>")
    everything = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_words").alias("words")))
    return (
        known.join(copied, "sha", "left").join(cut, ["doc_id", "cid"], "left")
        .select(
            "doc_id", "n_words",
            F.when(is_copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(is_copy, everything).otherwise(F.coalesce("removed", nothing)).alias("removed"),
            F.when(is_copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
        )
    )
