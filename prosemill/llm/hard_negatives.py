"""Hard negatives by inner product, found with LEMP-style coordinate pruning.

The rows are range-sorted by the length of their vectors.  A task cuts what it reads into buckets of
rows of similar length and keeps, for the coordinates that are asked for, a list of the bucket's rows
sorted by that coordinate of the unit vector.  For an anchor q that still needs scores of t or more:

* a bucket whose longest vector cannot reach t is skipped: t > |q| * longest;
* otherwise a row must have a cosine of c = t / (|q| * longest) at least, so for each of the anchor's
  focus coordinates f (its largest) the row's coordinate lies within acos(c) of q's as angles to the
  axis; the sorted list gives the rows of that range, and the candidates are the rows in all ranges;
* the candidates' scores are computed exactly, as integers.  An anchor whose ranges exclude nothing
  in a bucket has the whole bucket as candidates, scored for all such anchors at once.

t starts at the k-th best score among a bounded sample of the rows (any rows give a valid start) and
rises with what the task finds.  The first pass finds each anchor's positives, the second the
negatives of every (anchor, positive), whose scores lie in a band below the positive's.  Each task
hands on its k best only; a shuffle by anchor merges them.  Anchors go to the tasks in blocks of
bounded size, the only thing broadcast; the rows never move after the sort.  Nothing is grouped by
label, so a label or vector with a third of all rows is no hot group.

Defined results: rows with a null id, label or vector or a null or non-finite component take no part.
A vector's missing trailing components count as zero; zero vectors score 0.  Repeated rows are rows
each: as anchors, positives and negatives (only the anchor's own row is not its positive).  Scores are
64-bit integers.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prosemill.llm.common import int_matrix, stored

ANCHOR_BLOCK = 4096  # anchors sent to the tasks at once
SAMPLE = 2048  # rows, about, that give the first thresholds
BUCKET, LEAST, SHRINK = 1024, 64, 0.9  # rows of a bucket at most, and at least where lengths fall below 0.9
FOCUS = 3  # focus coordinates of an anchor
GROUP = 256  # anchors scored at once against a whole bucket
MANY = 1 << 19  # scores held at once before the best are picked
SLACK = 1e-9  # for rounding in lengths and cosines


def labelled_vectors(df: DataFrame, id_col: str, vec_col: str, label: Column, scale: float) -> DataFrame:
    """(vec_id, label, terms) with terms = floor(scale * x) as longs, of the rows that take part."""
    x = F.col(vec_col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    return df.where(F.col(id_col).isNotNull() & x.isNotNull() & label.isNotNull()).where(~bad).select(
        F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double"))).alias("terms"),
    )


def by_length(vectors: DataFrame) -> DataFrame:
    """The rows with a row number and their length, sorted by falling length within range partitions."""
    length = F.sqrt(F.aggregate("terms", F.lit(0.0), lambda a, t: a + t.cast("double") * t.cast("double")))
    spread = F.xxhash64("vec_id", "terms", "label")  # many rows of one length fill several partitions
    return stored(
        vectors.withColumn("length", length)
        .repartitionByRange(F.desc("length"), spread)
        .sortWithinPartitions(F.desc("length"), "vec_id")
        .withColumn("row", F.monotonically_increasing_id()),
        "lemp-rows",
    )


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integer rows, exact; by floating point where that is exact too."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


class Bucket:
    """Rows of similar length with lists sorted by coordinate, made when first asked for."""

    def __init__(self, matrix: np.ndarray, lengths: np.ndarray):
        self.matrix, self.longest = matrix, float(lengths[0])
        self.unit = matrix / np.where(lengths > 0, lengths, 1.0)[:, None]
        self.low, self.high = self.unit.min(axis=0), self.unit.max(axis=0)
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self._lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self._lists[f] = order, self.unit[order, f]
        return self._lists[f]


def buckets(matrix: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of rows, whose lengths fall."""
    lo, n = 0, len(lengths)
    while lo < n:
        near = int(np.searchsorted(-lengths[lo:], -SHRINK * lengths[lo], side="right"))
        hi = min(n, lo + min(BUCKET, max(near, LEAST)))
        yield lo, hi
        lo = hi


class Anchors:
    """A block of anchors: their integer rows, lengths, unit vectors and focus coordinates."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.lengths = np.sqrt((matrix.astype(np.float64) ** 2).sum(axis=1))
        self.unit = matrix / np.where(self.lengths > 0, self.lengths, 1.0)[:, None]
        few = min(FOCUS, matrix.shape[1])
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, :few]

    def scored(self, bucket: Bucket, need: np.ndarray) -> Iterator[tuple]:
        """(anchors, rows of the bucket, scores), flat: every pair with a score of need[anchor] or more
        is among them; `need` is a float array, infinite for anchors that need nothing."""
        reach = self.lengths * bucket.longest * (1 + SLACK)
        alive = np.flatnonzero((need <= reach) & (need < np.inf))
        if not len(alive):
            return
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(reach[alive] > 0, need[alive] / reach[alive], -1.0)
        # a zero or negative threshold says nothing about rows shorter than the longest
        cosine = np.where(need[alive] > 0, np.clip(cosine, -1.0, 1.0), -1.0)
        focus = self.focus[alive]
        at = np.arccos(np.clip(self.unit[alive[:, None], focus], -1.0, 1.0))
        wide = np.arccos(cosine)[:, None] + 1e-7
        low = np.where(at + wide >= np.pi, -1.1, np.cos(np.minimum(at + wide, np.pi))) - SLACK
        high = np.where(at - wide <= 0, 1.1, np.cos(np.maximum(at - wide, 0))) + SLACK
        low[cosine <= -1.0], high[cosine <= -1.0] = -np.inf, np.inf
        cuts = (low > bucket.low[focus]) | (high < bucket.high[focus])
        pruned = cuts.any(axis=1)
        whole = alive[~pruned]
        rows = np.arange(len(bucket.matrix))
        for first in range(0, len(whole), GROUP):
            some = whole[first : first + GROUP]
            scores = dots(self.matrix[some], bucket.matrix)
            keep = scores >= need[some, None]
            a, c = np.nonzero(keep)
            yield some[a], rows[c], scores[a, c]
        for i in np.flatnonzero(pruned):
            a = alive[i]
            seen = np.zeros(len(bucket.matrix), np.uint8)
            for f, lo, hi in zip(focus[i][cuts[i]], low[i][cuts[i]], high[i][cuts[i]]):
                order, values = bucket.sorted_list(int(f))
                first, end = np.searchsorted(values, lo, "left"), np.searchsorted(values, hi, "right")
                seen[order[first:end]] += 1
            found = np.flatnonzero(seen == int(cuts[i].sum()))
            if len(found):
                scores = dots(self.matrix[a : a + 1], bucket.matrix[found])[0]
                keep = scores >= need[a]
                yield np.full(int(keep.sum()), a), found[keep], scores[keep]


def best_of(key: np.ndarray, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Positions of each key's k best, in the order of key, falling score, id and row."""
    order = np.lexsort((row, vec_id, ~score, key))
    key = key[order]
    return order[np.arange(len(key)) - np.searchsorted(key, key, side="left") < k]


class Best:
    """The k best of each key so far, and the score a further row needs."""

    def __init__(self, need: np.ndarray, k: int):
        self.need, self.k = need.copy(), k
        self.held = [np.zeros(0, np.int64)] * 4  # key, score, vec_id, row

    def add(self, parts: list[tuple]) -> None:
        if not parts:
            return
        every = [np.concatenate([h, *x]) for h, x in zip(self.held, zip(*parts))]
        best = best_of(*every, self.k)
        self.held = [e[best] for e in every]
        key, score = self.held[:2]
        last = np.arange(len(key)) - np.searchsorted(key, key, side="left") == self.k - 1
        self.need[key[last]] = np.maximum(self.need[key[last]], score[last])

    def later(self, parts: list[tuple], part: tuple) -> list[tuple]:
        """`parts` with one more, or none after they were added because they are many."""
        if not len(part[0]):
            return parts
        parts = [*parts, part] if len(parts) < 64 else [tuple(np.concatenate(x) for x in zip(*parts, part))]
        if sum(len(p[0]) for p in parts) < MANY:
            return parts
        self.add(parts)
        return []


def _columns(batch: pa.RecordBatch, wide: int) -> tuple:
    return (
        *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "vec_id", "label", "length")),
        int_matrix(batch.column("terms"), wide),
    )


def _positive_pass(block, k: int):
    """For mapInArrow over the sorted rows: each anchor's k best other rows of its label."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, label, matrix, need = block.value
        anchors, best = Anchors(matrix), Best(need, k)
        for batch in batches:
            row, vec_id, labels, lengths, rows = _columns(batch, matrix.shape[1])
            for lo, hi in buckets(rows, lengths):
                parts = []
                for a, c, s in anchors.scored(Bucket(rows[lo:hi], lengths[lo:hi]), best.need):
                    c = c + lo
                    fits = (labels[c] == label[a]) & (row[c] != own[a])
                    a, c, s = a[fits], c[fits], s[fits]
                    parts = best.later(parts, (a, s, vec_id[c], row[c]))
                best.add(parts)
        a, s, v, r = best.held
        yield pa.RecordBatch.from_arrays(
            [pa.array(own[a]), pa.array(s), pa.array(v), pa.array(r)], ["anchor", "score", "vec_id", "row"]
        )

    return search


def _negative_pass(block, k: int):
    """For mapInArrow over the sorted rows: each (anchor, positive)'s k best rows inside its band."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, label, matrix, pairs = block.value
        of, place, high, need = pairs  # of each pair: its anchor's position, its number there, its band
        anchors, best = Anchors(matrix), Best(need, k)
        first = np.searchsorted(of, np.arange(len(own) + 1))
        most = int(np.diff(first).max(initial=0))

        for batch in batches:
            row, vec_id, labels, lengths, rows = _columns(batch, matrix.shape[1])
            for lo, hi in buckets(rows, lengths):
                least = np.full(len(own), np.inf)
                np.minimum.at(least, of, best.need)
                parts = []
                for a, c, s in anchors.scored(Bucket(rows[lo:hi], lengths[lo:hi]), least):
                    c = c + lo
                    fits = labels[c] != label[a]
                    a, c, s = a[fits], c[fits], s[fits]
                    for j in range(most):
                        pair = first[a] + j
                        has = pair < first[a + 1]
                        pair, cj, sj = pair[has], c[has], s[has]
                        fits = (sj >= best.need[pair]) & (sj <= high[pair])
                        pair, cj, sj = pair[fits], cj[fits], sj[fits]
                        parts = best.later(parts, (pair, sj, vec_id[cj], row[cj]))
                best.add(parts)
        p, s, v, r = best.held
        yield pa.RecordBatch.from_arrays(
            [pa.array(own[of[p]]), pa.array(place[p]), pa.array(s), pa.array(v), pa.array(r)],
            ["anchor", "place", "score", "vec_id", "row"],
        )

    return search


def _seed(sample, kind: str, k: int):
    """For mapInArrow over anchors: the k-th best fitting score among the sample, per anchor or pair."""

    def kth(scores: np.ndarray, fits: np.ndarray, least: float) -> float:
        scores = scores[fits]
        return least if len(scores) < k else max(least, float(np.partition(scores, len(scores) - k)[-k]))

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, _, labels, matrix = sample.value
        for batch in batches:
            own = batch.column("row").to_numpy(zero_copy_only=False)
            label = batch.column("label").to_numpy(zero_copy_only=False)
            asked = int_matrix(batch.column("terms"), matrix.shape[1])
            bands = [None] * len(own)
            if kind == "negatives":
                bands = [list(zip(*b)) for b in zip(batch.column("low").to_pylist(), batch.column("high").to_pylist())]
            need = []
            for i in range(len(own)):
                if i % GROUP == 0:
                    block = dots(asked[i : i + GROUP], matrix)
                s = block[i % GROUP]
                if kind == "positives":
                    need.append([kth(s, (labels == label[i]) & (row != own[i]), -np.inf)])
                else:
                    other = labels != label[i]
                    need.append([kth(s, other & (s >= lo) & (s <= hi), float(lo)) for lo, hi in bands[i]])
            yield batch.append_column("need", pa.array(need, pa.list_(pa.float64())))

    return seed


def _sample(rows: DataFrame, n: int):
    share = max(1, n // SAMPLE)
    got = rows.where(F.pmod(F.xxhash64("row"), F.lit(share)) == 0).select("row", "vec_id", "label", "terms").toArrow()
    return (
        *(got.column(c).to_numpy() for c in ("row", "vec_id", "label")),
        int_matrix(got.column("terms"), rows.agg(F.max(F.size("terms"))).first()[0] or 0),
    )


def _blocks(asked: DataFrame, block: int) -> Iterator[pa.Table]:
    """The anchors, about `block` at a time."""
    n = -(-asked.count() // block)
    for b in range(n):
        part = asked.where(F.pmod(F.xxhash64("row"), F.lit(n)) == b).orderBy("row").toArrow()
        if part.num_rows:
            yield part


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50,
         high: int = 95, block: int = ANCHOR_BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    vectors: (vec_id, label, terms).  Of the rows where `anchor` holds, each is paired with its
    `positives` best other rows of its label, and for each pair come the `negatives` best rows of other
    labels whose score is between `low` and `high` percent of the positive's.  Equal scores: smaller ids first.
    """
    spark = vectors.sparkSession
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = by_length(vectors)
    n = rows.count()
    if not n:
        return spark.createDataFrame([], empty)
    sample = spark.sparkContext.broadcast(_sample(rows, n))
    wide = sample.value[3].shape[1]
    asked = rows.where(anchor).select("row", "vec_id", "label", "terms")
    seeded = stored(
        asked.mapInArrow(
            _seed(sample, "positives", positives),
            "row long, vec_id long, label long, terms array<long>, need array<double>",
        ),
        "lemp-anchors",
    )

    def head(part: pa.Table) -> tuple:
        return (
            part.column("row").to_numpy(), part.column("label").to_numpy(), int_matrix(part.column("terms"), wide)
        )

    found = None
    for part in _blocks(seeded, block):
        need = np.array([x[0] for x in part.column("need").to_pylist()])
        sent = spark.sparkContext.broadcast((*head(part), need))
        one = stored(
            rows.mapInArrow(_positive_pass(sent, positives), "anchor long, score long, vec_id long, row long"),
            "lemp-positives",
        )
        sent.unpersist()
        found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], empty)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id", "row")
    chosen = (
        found.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= positives)
        .where("score >= 0")  # no score lies between percentages of a negative one
        .select("anchor", F.col("place").cast("long").alias("place"), "score", "vec_id")
    )
    pairs = stored(
        chosen.groupBy("anchor")
        .agg(F.sort_array(F.collect_list(F.struct("place", "score", "vec_id"))).alias("p"))  # `positives` at most
        .join(seeded.drop("need"), F.col("anchor") == F.col("row")).drop("anchor")
        .select(
            "row", "vec_id", "label", "terms", "p.place", F.col("p.score").alias("positive_score"),
            F.col("p.vec_id").alias("positive_id"),
            F.expr(f"transform(p.score, s -> s div 100 * {low} + (s % 100 * {low} + 99) div 100)").alias("low"),
            F.expr(f"transform(p.score, s -> s div 100 * {high} + s % 100 * {high} div 100)").alias("high"),
        ),
        "lemp-pairs",
    )
    longs = "place array<long>, positive_score array<long>, positive_id array<long>, low array<long>, high array<long>"
    banded = stored(
        pairs.mapInArrow(
            _seed(sample, "negatives", negatives),
            f"row long, vec_id long, label long, terms array<long>, {longs}, need array<double>",
        ),
        "lemp-bands",
    )
    found = None
    for part in _blocks(banded, block):
        sizes = part.column("low").combine_chunks().value_lengths().to_numpy()

        def flat(name: str, part=part) -> np.ndarray:
            return part.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)

        of = np.repeat(np.arange(part.num_rows), sizes)
        sent = spark.sparkContext.broadcast((*head(part), (of, flat("place"), flat("high"), flat("need"))))
        one = stored(
            rows.mapInArrow(
                _negative_pass(sent, negatives), "anchor long, place long, score long, vec_id long, row long"
            ),
            "lemp-negatives",
        )
        sent.unpersist()
        found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], empty)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    known = banded.select(
        F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"),
        F.explode(F.arrays_zip("place", "positive_id", "positive_score")).alias("p"),
    ).select("anchor", "anchor_id", "p.*")
    return ranked.join(known, ["anchor", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
