"""SimHash near-duplicates through deletion-variant signatures.

A text's fingerprint has a bit set where over half of its shingles' XXH64 values have it.  Two
fingerprints link at `distance` (4) or fewer differing bits.  The 64 bits are cut into 3 segments,
fewer than the 5 that an exact match of one segment would need: of 4 differing bits one segment has
at most one.  So each fingerprint is indexed by every segment with every single bit of it wiped out:
64 signatures.  Linked fingerprints share a signature, and what shares one is verified.

Sizes.  Only distinct fingerprints are indexed, so copies cost nothing here.  Rows are shuffled by
signature and sorted; a task compares what shares a signature as it streams by, and a bucket is
walked breadth-first from its first fingerprint, which gives a tree of links, never all its pairs: a
dense bucket is used up by a few comparisons with each member.  A bucket with more than `block`
members (known beforehand from counts by segment) is dealt into blocks; every two blocks meet in a
task of their own.  For unrelated fingerprints the comparisons grow as n^2 * 64 / 2^21: one for
every two rows of the index at 2 million distinct fingerprints.

Defined results: null or blank text has fingerprint zero, which links like any other.  A null id
never is a component's id; a component of such rows only has a null id.  Repeated rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.llm.common import stored
from prosemill.llm.graph import components

SHINGLE = 4
DISTANCE = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
BLOCK = 8192  # distinct fingerprints that meet in one comparison
NEAR_ROWS = 8  # buckets up to here are compared by array shifts, larger ones are walked


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of UTF-8 text, words lower-cased in A-Z."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [digest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = ends - np.fromiter(map(len, words), np.int64, len(words)) - 1
        hashes = [
            digest(joined[a:b], 42)
            for a, b in zip(starts[: len(words) - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist())
        ]
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 16384):
        raw = np.frombuffer(b"".join(hashes[at : at + 16384]), np.uint8).reshape(-1, 8)
        bits += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(hashes)).tobytes(), "big")


def _fingerprinter(shingle: int):
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [
                fingerprint(t.as_py().encode(), shingle) if t.is_valid else 0 for t in batch.column(1)
            ]
            signed = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], schema=schema)

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row; fp holds the 64 bits as a signed long."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_fingerprinter(shingle), "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _signatures(fp: Column) -> Column:
    """The 64 signatures: which bit is wiped out, and the rest of that bit's segment."""
    out = []
    for first, bits in SEGMENTS:
        for bit in range(first, first + bits):
            mask = _signed((((1 << bits) - 1) << first) & ~(1 << bit))
            rest = F.shiftrightunsigned(fp.bitwiseAND(F.lit(mask)), first)
            out.append(rest.bitwiseOR(F.lit(bit << 32)))
    return F.array(*out)


def _segment_values(fp: Column) -> Column:
    return F.array(*[
        F.struct(
            F.lit(k).alias("segment"),
            F.shiftrightunsigned(fp.bitwiseAND(F.lit(_signed(((1 << bits) - 1) << first))), first).alias("value"),
        )
        for k, (first, bits) in enumerate(SEGMENTS)
    ])


def _hot_signatures(nodes: DataFrame, block: int) -> DataFrame:
    """(sig, blocks): signatures that more than `block` fingerprints may have, by their segments' counts."""
    hot = (
        nodes.select(F.explode(_segment_values(F.col("fp"))).alias("s"))
        .groupBy("s.segment", "s.value").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > block // 2)
    )
    bits = F.array(*[F.sequence(F.lit(a), F.lit(a + b - 1)) for a, b in SEGMENTS])
    first = F.array(*[F.lit(a) for a, _ in SEGMENTS])
    return (
        hot.withColumn("bit", F.explode(F.get(bits, F.col("segment"))))
        .withColumn("at", F.col("bit") - F.get(first, F.col("segment")))
        .withColumn("rest", F.expr("value & ~shiftleft(1L, at)"))
        .select(F.expr("rest | shiftleft(cast(bit as bigint), 32)").alias("sig"), "n")
        .groupBy("sig").agg(F.sum("n").alias("n"))
        .select("sig", F.ceil((F.col("n") + block // 2) / F.lit(block // 2)).cast("int").alias("blocks"))
    )


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _walk(prints: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join all of `prints` that links join, one for each fingerprint reached."""
    rest = prints
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            here = frontier.pop()
            near = _popcount(rest ^ here) <= distance
            if near.any():
                found, rest = rest[near], rest[~near]
                yield np.full(len(found), here), found
                frontier.extend(found)


def _linker(distance: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(sig, pair, fp) -> Iterator[pa.RecordBatch]:
        n = len(fp)
        same = (sig[1:] == sig[:-1]) & (pair[1:] == pair[:-1])
        starts = np.flatnonzero(np.concatenate([[True], ~same]))
        sizes = np.diff(np.append(starts, n))
        links = []
        size_of = np.repeat(sizes, sizes)
        few = np.flatnonzero((size_of > 1) & (size_of <= NEAR_ROWS))
        run_of = np.repeat(np.arange(len(starts)), sizes)
        for step in range(1, NEAR_ROWS):
            left = few[few + step < n]
            left = left[run_of[left] == run_of[left + step]]
            if not len(left):
                break
            hit = left[_popcount(fp[left] ^ fp[left + step]) <= distance]
            links.append((fp[hit], fp[hit + step]))
        for at in np.flatnonzero(sizes > NEAR_ROWS).tolist():
            links.extend(_walk(fp[starts[at] : starts[at] + sizes[at]], distance))
        if links:
            both = np.stack([np.concatenate(x) for x in zip(*links)], axis=1)
            if len(both):
                both = np.unique(both, axis=0).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], schema=schema
                )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # of the bucket that the next batch may continue
        for batch in batches:
            if not batch.num_rows:
                continue
            new = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if held and (new[0][-1], new[1][-1]) == (held[0][0][0], held[0][1][0]):
                held.append(new)
                continue
            sig, pair, fp = (np.concatenate(x) for x in zip(*held, new))
            last = (sig == sig[-1]) & (pair == pair[-1])
            cut = len(sig) - int(last.sum())
            if cut:
                yield from compare(sig[:cut], pair[:cut], fp[:cut].view(np.uint64))
            held = [(sig[cut:], pair[cut:], fp[cut:])]
        if held:
            sig, pair, fp = (np.concatenate(x) for x in zip(*held))
            yield from compare(sig, pair, fp.view(np.uint64))

    return link


def links(nodes: DataFrame, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """(a, b): links between the distinct fingerprints `fp`, enough to connect what links connect."""
    if distance >= 2 * len(SEGMENTS):
        raise ValueError("with this many differing bits no segment need be near")
    hot = stored(_hot_signatures(nodes, block), "simhash-hot")
    index = (
        nodes.select("fp", F.explode(_signatures(F.col("fp"))).alias("sig"))
        .join(hot, "sig", "left")
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int"))
    )
    # in a hot bucket a block meets every other one; a pair of blocks is numbered lower * blocks + higher
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: k != F.col("own"))
    pairs = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(
            others,
            lambda k: (F.least(k, F.col("own")) * F.col("blocks") + F.greatest(k, F.col("own"))).cast("long"),
        )
    )
    dealt = (
        index.select("sig", F.explode(pairs).alias("pair"), "fp")
        .repartition("sig", "pair")
        .sortWithinPartitions("sig", "pair")
    )
    return dealt.mapInArrow(_linker(distance), "a long, b long").distinct()


def _named(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, label, rep): the component of every distinct fingerprint, and its smallest id."""
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-nodes")
    found = stored(links(nodes.select("fp"), distance), "simhash-links")
    label = stored(components(found, "a", "b"), "simhash-labels")
    return nodes.join(label.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("label", "fp").alias("label"), "rep"
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): the smallest id that links reach from each row."""
    prints = stored(fingerprints(docs, shingle, id_col, text_col), "simhash-prints")
    named = stored(_named(prints, distance), "simhash-named")
    smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_fp = stored(named.join(smallest, "label").select("fp", "component_id"), "simhash-components")
    return prints.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def distinct_documents(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component the row with the smallest id.

    Rows are numbered where they lie, so that of fully equal rows exactly one stays.
    """
    at = docs.columns.index(text_col)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py().encode(), shingle) if t.is_valid else 0 for t in batch.column(at)]
            signed = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, signed], names=[*batch.schema.names, "__fp"])

    fields = docs.select("*", F.lit(0).cast("long").alias("__fp")).schema
    marked = stored(
        docs.mapInArrow(mark, fields).withColumn("__row", F.monotonically_increasing_id()), "simhash-rows"
    )
    prints = marked.select(F.col(id_col).cast("long").alias("doc_id"), F.col("__fp").alias("fp"), F.col("__row").alias("row"))
    named = stored(_named(prints, distance).select("fp", "label"), "simhash-named")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    chosen = stored(
        prints.groupBy("fp").agg(F.min(order).alias("first")).join(named, "fp")
        .groupBy("label").agg(F.min("first").alias("first")).select(F.col("first.row").alias("__row")),
        "simhash-chosen",
    )
    # always by shuffle: one plan at every size, whatever a broadcast threshold says of few rows
    return marked.join(chosen.hint("merge"), "__row", "left_semi").drop("__fp", "__row")
