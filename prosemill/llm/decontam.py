"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts are brought to one form: words of lower-case ASCII letters, digits and non-ASCII characters, one
blank before and after each.  Patterns are the benchmark's windows of ten words in that form (an item
of fewer words is one pattern), so an occurrence of a pattern's bytes is an occurrence of its words.

For the patterns of equal word count, with m bytes in the shortest, the search looks at blocks of up
to eight bytes.  A shift table over hashed blocks says how far a block lies, at least, from the end of
some pattern's first m bytes: positions that no pattern can end at are jumped over.  Where the shift is
0, the block (the suffix of the first m bytes) and the first block (the prefix) select a bucket of
patterns; the words at that place are looked up in it by hash, and compared byte by byte.  The text is
searched in many segments at once, each with its own position, so that a jump is one array operation.

Patterns reach the tasks in blocks of bounded bytes, dealt by a hash of window and item, so a window
of very many items fills several.  One block, the usual case, needs no shuffle of documents; more are a
scan each, whose hits are joined to the documents by row.  A document is searched whole, in pieces that
overlap by no less than a pattern; its memory is bounded by its own size.

Defined results: null texts and texts without words have no words, hits or items.  A null item_id's
windows hit words but no item is listed for them; rows of one item_id are one item.  Repeated documents
are judged each.  Other columns are ignored.  An empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm.common import slices, stored, word_hashes

WINDOW = 10
BLOCK_BYTES = 32 << 20  # patterns sent to the tasks at once
WIDTH = 8  # bytes of a Wu-Manber block
TABLE_BITS = 24
SLICE = 4 << 20  # bytes of text searched at once
MANY = 1 << 16  # windows handed on at once
SEGMENT = 2048  # bytes of text that one position walks through

_BLANK = 32
_LOWER = np.full(256, _BLANK, np.uint8)
_LOWER[48:58] = np.arange(48, 58)
_LOWER[97:123] = np.arange(97, 123)
_LOWER[65:91] = np.arange(97, 123)
_LOWER[128:] = np.arange(128, 256)


def plain_form(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, blanks, first): texts as ` w1 w2 ... wn ` one after the other, a zero byte around each.

    blanks: places of all blanks, one before a text's first word and one after each word; first[t]: the
    number of text t's first blank.  A text has one blank more than words.
    """
    n = len(cuts) - 1
    bounds = cuts + 3 * np.arange(n + 1)
    added = np.zeros(len(data) + 3 * (n + 1), bool)
    low = np.full(len(added), _BLANK, np.uint8)
    for i in range(3):  # blank, zero, blank
        added[bounds + i] = True
    low[~added] = _LOWER[data]
    low[bounds + 1] = 0
    keep = low != _BLANK
    keep[1:] |= keep[:-1]  # the first blank after a word, or after a zero
    out = low[keep]
    blanks = np.flatnonzero(out == _BLANK)
    return out, blanks, np.searchsorted(blanks, np.flatnonzero(out == 0))


class Searcher:
    """Wu-Manber tables of patterns with one number of words."""

    def __init__(self, patterns: list[bytes], words: int, numbers: np.ndarray):
        self.words, lens = words, np.array([len(p) for p in patterns], np.int64)
        self.data = np.frombuffer(b"".join(patterns), np.uint8)
        self.starts = np.cumsum(lens) - lens
        self.lens = lens
        self.m = int(lens.min())
        self.width = min(WIDTH, self.m)
        self.mask = np.uint64((1 << (8 * self.width)) - 1)
        bits = min(TABLE_BITS, max(8, int(len(patterns) * self.m * 4).bit_length()))
        self.down = np.uint64(64 - bits)
        most = self.m - self.width + 1
        self.shift = np.full(1 << bits, min(most, 32767), np.int16)
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        for j in range(most):  # the block that ends at byte j + width of the first m
            blocks = self._blocks(padded, self.starts + j)
            np.minimum.at(self.shift, self._slot(blocks), np.int16(min(most - 1 - j, 32767)))
        # buckets: by suffix and prefix blocks and the hash of all words
        self.keys = np.unique(self._key(padded, self.starts))
        hashes = word_hashes(self.data, self.starts, self.starts + lens)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.order, self.numbers = hashes[order], order, numbers
        self.alike = int(np.unique(hashes, return_counts=True)[1].max())  # 1 unless hashes collide

    def _blocks(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The `width` bytes at each place as numbers; data has 8 bytes to spare."""
        words = np.lib.stride_tricks.as_strided(
            data[: len(data) - 7].view(), shape=(len(data) - 7, 8), strides=(1, 1)
        )
        return np.ascontiguousarray(words[at]).view("<u8").reshape(-1) & self.mask

    def _slot(self, blocks: np.ndarray) -> np.ndarray:
        return ((blocks * np.uint64(0x9E3779B97F4A7C15)) >> self.down).astype(np.int64)

    def _key(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        prefix, suffix = self._blocks(data, starts), self._blocks(data, starts + self.m - self.width)
        return prefix * np.uint64(0xD1342543DE82EF95) ^ suffix

    def places(self, data: np.ndarray) -> np.ndarray:
        """Places in the text where a bucket's suffix and prefix agree; data ends in 8 spare bytes."""
        n = len(data) - 8 - self.m + 1  # starts of m bytes
        if n <= 0:
            return np.zeros(0, np.int64)
        at = np.arange(0, n, SEGMENT)
        ends = np.minimum(at + SEGMENT, n)
        found = []
        while len(at):
            jump = self.shift[self._slot(self._blocks(data, at + (self.m - self.width)))]
            zero = jump == 0
            if zero.any():
                found.append(at[zero])
            at = at + np.maximum(jump, 1)
            on = at < ends
            if not on.all():
                at, ends = at[on], ends[on]
        if not found:
            return np.zeros(0, np.int64)
        at = np.concatenate(found)
        at = at[data[at] == 32]  # every pattern begins with a blank
        keys = self._key(data, at)
        near = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.sort(at[self.keys[near] == keys])

    def occurrences(self, data: np.ndarray, blanks: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(blank, pattern): each occurrence by the number of its first blank."""
        at = self.places(data)
        blank = np.searchsorted(blanks, at)
        fits = blank + self.words < len(blanks)
        blank = blank[fits]
        blank = blank[text_of[blank] == text_of[blank + self.words]]
        start, end = blanks[blank], blanks[np.minimum(blank + self.words, len(blanks) - 1)] + 1
        hashes = word_hashes(data, start, end)
        near = np.searchsorted(self.hashes, hashes)
        out = []
        for i in range(self.alike):
            hit = np.minimum(near + i, len(self.hashes) - 1)
            rows = np.flatnonzero(self.hashes[hit] == hashes)
            pattern = self.order[hit[rows]]
            sure = self._equal(data, start[rows], end[rows], pattern)
            out.append((blank[rows[sure]], self.numbers[pattern[sure]]))
        return tuple(np.concatenate(x) for x in zip(*out))

    def _equal(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, pattern: np.ndarray) -> np.ndarray:
        size = end - start
        sure = size == self.lens[pattern]
        rows = np.flatnonzero(sure)
        if len(rows):
            size = size[rows]
            at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            same = data[at + np.repeat(start[rows], size)] == self.data[at + np.repeat(self.starts[pattern[rows]], size)]
            sure[rows] = np.logical_and.reduceat(same, np.cumsum(size) - size)
        return sure


class Block:
    """What is sent to the tasks of a block of patterns; a Python worker makes the tables once."""

    def __init__(self, windows: list[bytes], items: list[int | None]):
        self.windows, self.items, self._tables = windows, items, None

    def tables(self) -> Patterns:
        if self._tables is None:
            self._tables = Patterns(self.windows, self.items)
        return self._tables


class Patterns:
    """A block of patterns: their searchers and the items of each."""

    def __init__(self, windows: list[bytes], items: list[int | None]):
        distinct: dict[bytes, list] = {}
        for w, i in zip(windows, items):
            distinct.setdefault(w, []).append(i)
        names = list(distinct)
        self.items = [np.array([i for i in distinct[w] if i is not None], np.int64) for w in names]
        by_words: dict[int, list[int]] = {}
        for number, w in enumerate(names):
            by_words.setdefault(w.count(b" ") - 1, []).append(number)
        self.searchers = [
            Searcher([names[i] for i in numbers], words, np.array(numbers)) for words, numbers in sorted(by_words.items())
        ]


def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow over (item_id, text): (item_id, window), the windows in the plain form."""
    for batch in batches:
        ids = batch.column("item_id")
        for lo, hi, data, cuts in slices(batch.column("text"), 64 << 10):
            form, blanks, first = plain_form(data, cuts)
            words = np.diff(first) - 1
            size = np.minimum(words, WINDOW)
            many = np.where(words > 0, words - size + 1, 0)
            text = np.repeat(np.arange(hi - lo), many)
            at = first[text] + np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
            for i in range(0, len(text), MANY):
                t, a = text[i : i + MANY], at[i : i + MANY]
                windows = [form[x:y].tobytes() for x, y in zip(blanks[a], blanks[a + size[t]] + 1)]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(t + lo)), pa.array(windows, pa.binary())], ["item_id", "window"]
                )


def patterns_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, window): the distinct patterns of every item."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    return stored(rows.mapInArrow(windows_of, "item_id long, window binary").distinct(), "decontam-patterns")


def _finder(sent):
    """For mapInArrow over rows ending in a text: the rows without it, with words, spans and items."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = sent.value.tables()
        for batch in batches:
            key = batch.column(0)
            words, spans, items = [], [], []
            for lo, hi, data, cuts in slices(batch.column("text"), SLICE):
                form, blanks, first = plain_form(data, cuts)
                words.append(np.diff(first) - 1)
                text_of = np.searchsorted(first[1:], np.arange(len(blanks)), side="right")
                form = np.concatenate([form, np.zeros(8, np.uint8)])
                starts, ends, found = [], [], []
                for s in patterns.searchers:
                    blank, pattern = s.occurrences(form, blanks, text_of)
                    starts.append(blank)
                    ends.append(blank + s.words)
                    found.append(pattern)
                spans_of, items_of = _by_text(starts, ends, found, patterns, text_of, first, hi - lo)
                spans += spans_of
                items += items_of
            yield pa.RecordBatch.from_arrays(
                [
                    key, pa.array(np.concatenate(words) if words else [], pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(items, pa.list_(pa.int64())),
                ],
                ["key", "n_words", "spans", "items"],
            )

    return find


def _by_text(starts, ends, found, patterns: Patterns, text_of, first, n: int) -> tuple[list, list]:
    """Of each text: the word spans covered (merged, by word number in the text) and the sorted items."""
    spans, items = [[] for _ in range(n)], [[] for _ in range(n)]
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    if not len(start):
        return spans, items
    end, pattern = np.concatenate(ends), np.concatenate(found)
    order = np.argsort(start, kind="stable")
    start, end, pattern = start[order], end[order], pattern[order]
    text = text_of[start]
    cuts = np.flatnonzero(np.diff(text)) + 1
    for rows in np.split(np.arange(len(start)), cuts):
        t = int(text[rows[0]])
        reach = np.maximum.accumulate(end[rows])
        fresh = np.append(True, start[rows[1:]] > reach[:-1])
        lows = start[rows][fresh] - first[t]
        highs = reach[np.append(np.flatnonzero(fresh)[1:] - 1, len(rows) - 1)] - first[t]
        spans[t] = [{"start": int(a), "end": int(b)} for a, b in zip(lows, highs)]
        items[t] = np.unique(np.concatenate([patterns.items[p] for p in np.unique(pattern[rows])])).tolist()
    return spans, items


FOUND = "n_words long, spans array<struct<start:long,end:long>>, items array<long>"


def _blocks(patterns: DataFrame, block_bytes: int) -> Iterator[Block]:
    total = patterns.agg(F.sum(F.octet_length("window") + F.lit(64))).first()[0] or 0
    n = -(-total // block_bytes)
    for b in range(n):
        part = patterns.where(F.pmod(F.xxhash64("window", "item_id"), F.lit(n)) == b).toArrow()
        if part.num_rows:
            yield Block(part.column("window").to_pylist(), part.column("item_id").to_pylist())


def search(docs: DataFrame, patterns: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, spans, items) of every document.

    spans: the covered words as merged [start, end) word numbers; items: sorted ids of the items with
    occurring windows.  patterns: as `patterns_of` gives them.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    blocks = _blocks(patterns, block_bytes)
    one = next(blocks, Block([], []))
    two = next(blocks, None)
    if two is None:
        sent = spark.sparkContext.broadcast(one)
        return rows.mapInArrow(_finder(sent), f"key {kind}, {FOUND}").withColumnRenamed("key", "doc_id")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "decontam-rows")
    hits, words = [], None
    for windows in (one, two, *blocks):
        sent = spark.sparkContext.broadcast(windows)
        part = stored(rows.select("row", "text").mapInArrow(_finder(sent), f"key long, {FOUND}"), "decontam-part")
        sent.unpersist()
        words = words or part.select(F.col("key").alias("row"), "n_words")
        hits.append(part.where(F.size("spans") > 0).select(F.col("key").alias("row"), "spans", "items"))
    every = hits[0]
    for h in hits[1:]:
        every = every.unionByName(h)
    merged = every.groupBy("row").agg(
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"),  # one text's, so bounded by it
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    ).mapInArrow(_join_spans, "row long, spans array<struct<start:long,end:long>>, items array<long>")
    no = {"spans": "array<struct<start:bigint,end:bigint>>", "items": "array<bigint>"}
    return (
        rows.select("row", "doc_id").join(words, "row").join(merged, "row", "left")
        .select("doc_id", "n_words", *[F.coalesce(c, F.array().cast(t)).alias(c) for c, t in no.items()])
    )


def _join_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: sorted spans with those that touch or overlap made one."""
    for batch in batches:
        out = []
        for spans in batch.column("spans").to_pylist():
            merged: list[dict] = []
            for s in spans:
                if merged and s["start"] <= merged[-1]["end"]:
                    merged[-1]["end"] = max(merged[-1]["end"], s["end"])
                else:
                    merged.append(s)
            out.append(merged)
        kind = batch.schema.field("spans").type
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(out, kind), batch.column("items")], ["row", "spans", "items"]
        )
