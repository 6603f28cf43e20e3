"""Sequence packing: tokens by a public byte-level BPE, first-fit decreasing in random groups.

A document's ids (and the end id) are cut at every `length`-th place; full pieces fill a sequence
each, and the rests are packed first-fit decreasing.  Pieces, not documents, are dealt at random into
groups of about `group_size`, so the pieces of one document lie in different groups and a long document
is no large group; a group is packed by itself, with a tournament tree over the room left in its
sequences: the leftmost sequence with enough room is found by walking down from the root.  A group
holds lengths only (no ids), so it is small whatever the texts are.

Ids.  `tiktoken` with the same vocabulary gives the ids that `tokenizers` gives with the JSON file
(tests compare them) at four times the speed; strings that name special tokens are ordinary text.
A text is cut before each space that a non-blank follows, where the splitting pattern always cuts
too, and each cut's ids are remembered in a bounded table of the task; a text with blanks in other
places is encoded whole.

Defined results: null text is empty and has the end id only.  Rows are packed each, repeated rows
and rows without an id included.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm.common import stored

LENGTH = 2048
END = 1
GROUP_SIZE = 20_000  # pieces a group holds on average
KNOWN_WORDS = 400_000  # remembered cuts per task; the table starts anew beyond that


class Encoder:
    """Text -> the bytes of its ids (little-endian unsigned 32-bit)."""

    def __init__(self, ranks_path: str, pattern: str, known: int = KNOWN_WORDS):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.coder = tiktoken.Encoding(
            "bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.most = known
        encode = self._whole

        class Known(dict):
            def __missing__(self, cut):
                self[cut] = ids = encode(" " + cut)
                return ids

        self.known = Known()

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.coder.encode_ordinary(text), dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        cuts = text.split(" ")
        # a cut that is empty or begins with a blank continues a run of blanks
        if not all(cuts[1:]) or any(c[0].isspace() for c in cuts[1:]):
            return self._whole(text)
        if len(self.known) > self.most:
            self.known.clear()
        return self._whole(cuts[0]) + b"".join(map(self.known.__getitem__, cuts[1:]))


def _piece_maker(ranks_path: str, pattern: str, length: int, end: int):
    end_bytes = np.asarray([end], dtype="<u4").tobytes()
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
         ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(ranks_path, pattern)
        step = 4 * length
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end_bytes
                total = len(ids) // 4
                for at in range(0, len(ids), step):
                    cut = ids[at : at + step]
                    rows.append((doc, at // 4, len(cut) // 4, zlib.crc32(cut), total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema
            )

    return pieces


def first_fit_decreasing(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size; bins are numbered in order of opening.

    The tournament tree's leaves are the room left in each bin, unopened bins included; a node holds
    the larger of its children.
    """
    n = len(sizes)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    leaves = 1
    while leaves < max(n, 1):
        leaves *= 2
    tree = [room] * (2 * leaves)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, room - tree[node]
        tree[node] -= size
        node //= 2
        while node:
            larger = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == larger:
                break
            tree[node] = larger
            node //= 2
    return bins, offsets


def _packer(length: int):
    def pack(group: pa.Table) -> pa.Table:
        # the order of arrival must not matter to a task that runs again
        group = group.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("row", "ascending")])
        sizes = group.column("length").to_numpy().astype(np.int64)
        bins, offsets = first_fit_decreasing(sizes, length)
        first = group.column("grp").to_numpy().astype(np.int64) << 32
        out = group.drop_columns(["grp", "row"])
        return out.append_column("sequence_id", pa.array(first + bins)).append_column(
            "offset", pa.array(offsets)
        )

    return pack


def token_pieces(
    docs: DataFrame, ranks_path: str, pattern: str, length: int = LENGTH, end: int = END,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document's ids in pieces of `length`."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        _piece_maker(ranks_path, pattern, length, end),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long",
    )


def pack(pieces: DataFrame, length: int = LENGTH, group_size: int = GROUP_SIZE) -> DataFrame:
    """`pieces` with sequence_id and offset; their lengths are at most `length`."""
    known = stored(pieces, "pack-pieces")
    n = known.count()
    groups = max(1, round(n / group_size))
    # the place in the stored table tells repeated rows apart, alike in every attempt
    placed = known.withColumn("row", F.concat_ws(":", "_metadata.file_name", "_metadata.file_block_start")).withColumn(
        "row", F.xxhash64("row", F.monotonically_increasing_id())
    )
    dealt = placed.withColumn("grp", F.pmod(F.xxhash64("doc_id", "start", "row"), F.lit(groups)))
    schema = (
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long"
    )
    return dealt.groupBy("grp").applyInArrow(_packer(length), schema)
