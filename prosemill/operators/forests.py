"""Random forests of several settings, grown together from binned rows.

Features are cut into bins once and the rows stored with them; every tree of every setting is grown
from that table.  The rows of a tree are drawn by a hash of (row, tree) as Poisson weights, the
features that a node may use by a hash of (tree, node), so a fit does not depend on partitions, and
settings are compared on the same draws.  Equal settings are grown once.

* **Large nodes** are cut level by level: a scan sums rows by (node, feature, bin, class) for the open
  nodes of all trees, at most `cells` sums in a task (a level with more takes more scans), Spark adds the
  sums of the tasks, and each node's cut is found from its own sums.
* **Nodes of at most `node_rows` rows** are finished apart: their rows are sent once, by node, and a task
  grows each subtree to its end.  At most `copies` rows are on the way at a time (None: four times the
  table's).  A table of at most `node_rows` rows is sent whole to each group of trees.
* Both use the same search for a cut, so the trees do not depend on `node_rows` (tested).  Ties go to
  the smaller feature, then to the smaller bin.

The driver gets one cut per node, never rows.  Rows with a null label or null features take no part
in a fit and get a null prediction; a NaN counts as larger than any number.  A fit without rows is an
error; equal rows without a `key` are drawn alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.operators.boosting import BINS, _arrays, _cut, _dense, _rows, quantile_cuts
from prosemill.session import cut_lineage, discard

NODE_ROWS = 50_000
CELLS = 8 << 20
# Sums whose cuts are searched at once.
CHUNK = 1 << 20


@dataclass(frozen=True)
class Setting:
    """What tells one forest from another."""

    impurity: str = "gini"
    featureSubsetStrategy: str = "sqrt"
    minInfoGain: float = 0.0
    bootstrap: bool = True

    def __post_init__(self):
        if self.impurity not in ("gini", "entropy"):
            raise ValueError(f"impurity: {self.impurity}")
        if self.featureSubsetStrategy not in ("auto", "sqrt", "log2", "all"):
            raise ValueError(f"featureSubsetStrategy: {self.featureSubsetStrategy}")
        if self.featureSubsetStrategy == "auto":
            object.__setattr__(self, "featureSubsetStrategy", "sqrt")

    def subset(self, d: int) -> int:
        """How many of `d` features a node may use."""
        wanted = {"sqrt": math.ceil(math.sqrt(d)), "log2": math.ceil(math.log2(d)) if d > 1 else 1, "all": d}
        return max(1, min(d, wanted[self.featureSubsetStrategy]))


@dataclass(frozen=True)
class Shape:
    """What all trees of a fit share."""

    classes: int
    depth: int
    features: int
    bins: int
    seed: int


def _mix(*parts) -> np.ndarray:
    """A 64-bit hash of whole numbers, place by place."""
    h = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for p in parts:
            h = (h ^ np.asarray(p).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(32))
    return h


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])


def _draws(ids: np.ndarray, tree: int, setting: Setting, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson with mean 1, or once without bootstrap."""
    if not setting.bootstrap:
        return np.ones(len(ids), np.int64)
    u = (_mix(seed, tree, ids.view(np.uint64)) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return np.searchsorted(_POISSON, u, side="right")


def _subsets(tree: int, nodes: np.ndarray, setting: Setting, shape: Shape) -> np.ndarray:
    """The features that each node may use, in rising order."""
    d, m = shape.features, setting.subset(shape.features)
    if m == d:
        return np.tile(np.arange(d), (len(nodes), 1))
    order = _mix(shape.seed + 1, tree, nodes[:, None], np.arange(d)[None, :]).argsort(axis=1, kind="stable")
    return np.sort(order[:, :m], axis=1)


def _entropy(counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The entropy of class counts that add up to `rows`, in bits (none: 0)."""
    p = counts / np.maximum(rows, 1)[..., None]
    return -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=-1)


def _best_cuts(sums: np.ndarray, features: np.ndarray, setting: Setting):
    """(cut or not, feature, bin, class counts on the left) of each node from its (feature, bin, class) sums."""
    n, m, b, k = sums.shape
    left = sums.cumsum(axis=2)
    total = left[:, 0, -1]
    rows_of = total.sum(axis=1)[:, None, None]
    nl = left.sum(axis=-1)
    nr = rows_of - nl
    if setting.impurity == "gini":  # in whole numbers: the squares on the right are T T - 2 L T + L L
        ll = np.einsum("nmbk,nmbk->nmb", left, left)
        lt = np.einsum("nmbk,nk->nmb", left, total)
        tt = (total * total).sum(axis=1)[:, None, None]
        gain = (ll / np.maximum(nl, 1) + (tt - 2 * lt + ll) / np.maximum(nr, 1) - tt / rows_of) / rows_of
    else:
        right = total[:, None, None] - left
        below = (nl * _entropy(left, nl) + nr * _entropy(right, nr)) / rows_of
        gain = _entropy(total[:, None, None], rows_of) - below
    gain = np.where((nl > 0) & (nr > 0), gain, -1.0).reshape(n, m * b)
    at, rows = gain.argmax(axis=1), np.arange(n)
    best = gain[rows, at]
    good = (best > 1e-12) & (best >= setting.minInfoGain)
    return good, features[rows, at // b], at % b, left.reshape(n, m * b, k)[rows, at]


def _sums(place, bins, y, w, features, shape: Shape) -> np.ndarray:
    """(node, feature, bin, class) sums of the rows, `place` being each row's node among those of `features`."""
    n, m = features.shape
    cell = (place[:, None] * m + np.arange(m)) * shape.bins + np.take_along_axis(bins, features[place], axis=1)
    cell = cell * shape.classes + y[:, None]
    flat = np.bincount(cell.ravel(), np.repeat(w, m), n * m * shape.bins * shape.classes)
    return flat.reshape(n, m, shape.bins, shape.classes)


def _grow(bins, y, w, tree: int, root: int, setting: Setting, shape: Shape) -> list[tuple]:
    """The subtree below `root`: (node, feature or -1, bin, class counts) of each node, from all its rows."""
    out: list[tuple] = []
    at = np.zeros(len(y), np.int64)  # each row's place in `nodes`, or -1 in a finished one
    nodes = np.array([root])
    counts = np.bincount(y, w, shape.classes)[None, :]
    level = (root + 1).bit_length() - 1
    per = max(1, CHUNK // (setting.subset(shape.features) * shape.bins * shape.classes))
    while len(nodes):
        mixed = (counts > 0).sum(axis=1) > 1
        if level >= shape.depth:
            mixed[:] = False
        child = np.full(len(nodes), -1)
        feature, cut = np.full(len(nodes), -1), np.zeros(len(nodes), np.int64)
        below, below_counts = [], []
        todo = np.flatnonzero(mixed)
        order = np.argsort(at, kind="stable")
        at_sorted = at[order]
        for start in range(0, len(todo), per):
            some = todo[start : start + per]
            # `some` rises, so its rows lie between two places of the sorted rows
            span = order[np.searchsorted(at_sorted, some[0]) : np.searchsorted(at_sorted, some[-1], side="right")]
            place = np.full(len(nodes), -1)
            place[some] = np.arange(len(some))
            span = span[place[at[span]] >= 0]
            features = _subsets(tree, nodes[some], setting, shape)
            sums = _sums(place[at[span]], bins[span], y[span], w[span], features, shape)
            good, f, b, left = _best_cuts(sums, features, setting)
            for i in np.flatnonzero(good):
                j = some[i]
                child[j], feature[j], cut[j] = len(below), f[i], b[i]
                below += [2 * nodes[j] + 1, 2 * nodes[j] + 2]
                below_counts += [left[i], counts[j] - left[i]]
        out += zip(nodes.tolist(), feature.tolist(), cut.tolist(), counts.tolist())
        inside = np.flatnonzero(at >= 0)
        j = at[inside]
        right = bins[inside, np.maximum(feature[j], 0)] > cut[j]
        at[inside] = np.where(child[j] >= 0, child[j] + right, -1)
        nodes, counts = np.array(below, np.int64), np.array(below_counts).reshape(-1, shape.classes)
        level += 1
    return out


@dataclass
class ClassTree:
    """Nodes in rising heap order (children of i: 2 i + 1, 2 i + 2); `left` is the place of the left child."""

    node: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, nodes: Mapping[int, tuple], classes: int) -> ClassTree:
        """A tree from node -> (feature or -1, bin, counts)."""
        ids = np.array(sorted(nodes), np.int64)
        feature = np.array([nodes[i][0] for i in ids.tolist()], np.int32)
        counts = np.array([nodes[i][2] for i in ids.tolist()], np.float64).reshape(-1, classes)
        bin_ = np.array([nodes[i][1] for i in ids.tolist()], np.int32)
        return cls(ids, feature, bin_, np.searchsorted(ids, 2 * ids + 1), counts)

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The place of the leaf each row reaches."""
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            f = self.feature[at]
            if (f < 0).all():
                return at
            right = bins[rows, np.maximum(f, 0)] > self.bin[at]
            at = np.where(f >= 0, self.left[at] + right, at)


@dataclass
class Forest:
    """A fitted forest; a row's class shares are the means of those of its leaves."""

    setting: Setting
    shape: Shape
    features: str
    label: str
    thresholds: list[np.ndarray]
    trees: list[ClassTree]

    def shares(self, x: np.ndarray) -> np.ndarray:
        bins = _cut(x, self.thresholds)
        total = np.zeros((len(x), self.shape.classes))
        for tree in self.trees:
            share = tree.counts / np.maximum(tree.counts.sum(axis=1, keepdims=True), 1)
            total += share[tree.place(bins)]
        return total / len(self.trees)

    def transform(self, df: DataFrame) -> DataFrame:
        """`df` with `probability` (one share per class) and `prediction` (ties: the smaller class)."""
        model = self

        @F.pandas_udf("array<double>")
        def probability(x: pd.Series) -> pd.Series:
            out = [None] * len(x)
            there = x.notna().to_numpy()
            if there.any():
                for i, share in zip(np.flatnonzero(there), model.shares(np.stack(x[there].to_numpy()))):
                    out[i] = share
            return pd.Series(out, dtype=object)

        p = F.col("probability")
        return df.withColumn("probability", probability(_dense(df, self.features))).withColumn(
            "prediction", (F.array_position(p, F.array_max(p)) - 1).cast("double")
        )


def accuracies(forests: Sequence[Forest], df: DataFrame) -> list[float | None]:
    """The share of rows that each forest names rightly, all from one scan (None: no rows)."""
    first = forests[0]

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y in _arrays(batches):
            right = [int((f.shares(x).argmax(axis=1) == y).sum()) for f in forests]
            yield pa.RecordBatch.from_pydict({
                "forest": pa.array(range(len(forests)), pa.int32()),
                "n": pa.array([len(y)] * len(forests), pa.int64()), "hits": pa.array(right, pa.int64()),
            })

    got = (
        _rows(df, first.label, first.features)
        .mapInArrow(hits, "forest int, n long, hits long")
        .groupBy("forest").agg((F.sum("hits") / F.sum("n")).alias("share")).collect()
    )
    share = {r.forest: r.share for r in got}
    return [share.get(i) for i in range(len(forests))]


_STATE = "id long, bins binary, y int"


def _state(batches, thresholds) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for x, y in _arrays([b]):
            bins = _cut(x, thresholds)
            yield pa.RecordBatch.from_pydict({
                "id": b.column("id"), "bins": pa.array([r.tobytes() for r in bins], pa.binary()), "y": pa.array(y, pa.int32()),
            })


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _open_rows(batches, forest, where, shape):
    """For each batch and open tree: (setting, tree number, node, bins, label, draws, place) of its open rows.

    `forest` has (setting, number, tree so far) of each open tree, `where` the place of each of its open
    nodes in the pass, by the nodes' order in the tree (-1: not in this pass).
    """
    for b in batches:
        if not b.num_rows:
            continue
        ids, bins, y = b.column("id").to_numpy(), _matrix(b.column("bins")), b.column("y").to_numpy()
        for (setting, number, tree), places in zip(forest, where):
            w = _draws(ids, number, setting, shape.seed)
            at = tree.place(bins)
            mine = np.flatnonzero((w > 0) & (places[at] >= 0))
            if len(mine):
                yield setting, number, tree.node[at[mine]], bins[mine], y[mine], w[mine], places[at[mine]]


def _partial_sums(batches, forest, where, spots, shape) -> Iterator[pa.RecordBatch]:
    """(place, cell, n) of this task's rows; `spots` holds each place's first cell, and the end."""
    flat = np.zeros(spots[-1])
    k = shape.bins * shape.classes
    for setting, number, node, bins, y, w, place in _open_rows(batches, forest, where, shape):
        used, first, local = np.unique(place, return_index=True, return_inverse=True)
        nodes = node[first]
        features = _subsets(number, nodes, setting, shape)
        sums = _sums(local, bins, y, w, features, shape).reshape(len(used), -1)
        for p, s in zip(used, sums):
            flat[spots[p] : spots[p] + features.shape[1] * k] += s
    there = np.flatnonzero(flat)
    for start in range(0, len(there), 100_000):
        at = there[start : start + 100_000]
        place = np.searchsorted(spots, at, side="right") - 1
        yield pa.RecordBatch.from_pydict({
            "place": pa.array(place, pa.int32()), "cell": pa.array(at - spots[place], pa.int64()),
            "n": pa.array(flat[at].astype(np.int64)),
        })


_NODES = "place int, node array<long>, feature array<int>, bin array<int>, counts array<long>"


def _node_table(place: int, rows: Sequence[tuple]) -> pa.Table:
    """One row with the nodes of a subtree; the counts of all its nodes follow each other."""
    return pa.table({
        "place": pa.array([place], pa.int32()), "node": pa.array([[r[0] for r in rows]], pa.list_(pa.int64())),
        "feature": pa.array([[r[1] for r in rows]], pa.list_(pa.int32())),
        "bin": pa.array([[r[2] for r in rows]], pa.list_(pa.int32())),
        "counts": pa.array([[int(c) for r in rows for c in r[3]]], pa.list_(pa.int64())),
    })


def _nodes(found: DataFrame, classes: int) -> Iterator[tuple]:
    """(place, node, feature, bin, counts) of each node."""
    for r in found.toArrow().to_pylist():
        counts = np.array(r["counts"]).reshape(-1, classes).tolist()
        for node in zip(r["node"], r["feature"], r["bin"], counts):
            yield r["place"], *node


def _cut_large(stored: DataFrame, trees, some, forest, shape: Shape) -> dict[tuple, tuple]:
    """(tree, node) -> (feature, bin, left counts, counts) of the large nodes `some` of a pass."""
    widths = [trees[t][0].subset(shape.features) * shape.bins * shape.classes for t, _ in some]
    spots = np.concatenate([[0], np.cumsum(widths)])
    opened, where = forest(some)

    def cut(key, table):
        place = key[0].as_py()
        t, node = some[place]
        setting, number = trees[t]
        features = _subsets(number, np.array([node]), setting, shape)
        sums = np.zeros(widths[place])
        sums[table.column("cell").to_numpy()] = table.column("n").to_numpy()
        sums = sums.reshape(1, features.shape[1], shape.bins, shape.classes)
        good, f, b, left = _best_cuts(sums, features, setting)
        total = sums[0, 0].sum(axis=0)
        return _node_table(place, [
            (0, int(f[0]) if good[0] else -1, int(b[0]) if good[0] else 0, left[0]), (1, -1, 0, total),
        ])

    added = (
        stored.mapInArrow(lambda it: _partial_sums(it, opened, where, spots, shape), "place int, cell long, n long")
        .groupBy("place", "cell").agg(F.sum("n").alias("n"))
    )
    got: dict[int, dict[int, tuple]] = {}
    for place, part, *node in _nodes(added.groupBy("place").applyInArrow(cut, _NODES), shape.classes):
        got.setdefault(place, {})[part] = node
    return {some[p]: (c[0][0], c[0][1], c[0][2], c[1][2]) for p, c in got.items()}


def _finish_small(stored: DataFrame, trees, some, forest, shape: Shape, rows: int) -> list:
    """(tree, node, feature, bin, counts) of all nodes in and below the small nodes `some` of a pass."""
    opened, where = forest(some)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, _, _, bins, y, w, place in _open_rows(batches, opened, where, shape):
            held.append((bins, y, w, place))
            size += len(y)
            if size >= 10_000:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    def packed(held) -> pa.RecordBatch:
        bins, y, w, place = (np.concatenate(c) for c in zip(*held))
        ends = pa.py_buffer(np.arange(0, bins.size + 1, bins.shape[1], dtype=np.int32).tobytes())
        return pa.RecordBatch.from_pydict({
            "place": pa.array(place, pa.int32()),
            "bins": pa.Array.from_buffers(pa.binary(), len(y), [None, ends, pa.py_buffer(bins.tobytes())]),
            "y": pa.array(y, pa.int32()), "w": pa.array(w, pa.int32()),
        })

    def grow(key, table):
        place = key[0].as_py()
        t, node = some[place]
        setting, number = trees[t]
        bins = _matrix(table.column("bins").combine_chunks())
        y, w = table.column("y").to_numpy(), table.column("w").to_numpy()
        return _node_table(place, _grow(bins, y, w, number, node, setting, shape))

    tasks = min(len(some), max(4 * stored.sparkSession.sparkContext.defaultParallelism, rows // 500_000))
    sent = stored.mapInArrow(send, "place int, bins binary, y int, w int").repartition(tasks, "place")
    grown = sent.groupBy("place").applyInArrow(grow, _NODES)
    return [(some[place][0], *node) for place, *node in _nodes(grown, shape.classes)]


def _grow_whole(stored: DataFrame, trees, shape: Shape) -> list:
    """(tree, node, feature, bin, counts) of all trees over a small table, sent once to each group of trees."""
    groups = min(len(trees), 4 * stored.sparkSession.sparkContext.defaultParallelism)

    def grow(key, table):
        ids, bins = table.column("id").to_numpy(), _matrix(table.column("bins").combine_chunks())
        y, grown = table.column("y").to_numpy(), []
        for t in range(key[0].as_py(), len(trees), groups):
            setting, number = trees[t]
            w = _draws(ids, number, setting, shape.seed)
            mine = w > 0
            grown.append(_node_table(t, _grow(bins[mine], y[mine], w[mine], number, 0, setting, shape)))
        return pa.concat_tables(grown)

    group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    sent = stored.select(group, "id", "bins", "y").repartition(groups, "group")
    return list(_nodes(sent.groupBy("group").applyInArrow(grow, _NODES), shape.classes))


def _passes(items: Sequence, size, most: int) -> Iterator[list]:
    """`items` in runs whose sizes add up to at most `most` (a larger item is a run of its own)."""
    held, total = [], 0
    for item in items:
        n = size(item)
        if held and total + n > most:
            yield held
            held, total = [], 0
        held.append(item)
        total += n
    if held:
        yield held


def fit(
    train: DataFrame, settings: Sequence[Setting], label: str = "label", features: str = "features",
    key: str | None = None, trees: int = 200, depth: int = 10, classes: int | None = None, seed: int = 42,
    bins: int = BINS, node_rows: int = NODE_ROWS, cells: int = CELLS, copies: int | None = None,
) -> list[Forest]:
    """One forest per setting, in their order: `trees` trees of at most `depth` levels of cuts.

    `key` tells rows apart when they are drawn (None: their features and label do).  Labels are 0 to
    `classes` - 1 (None: as many as the greatest label says).
    """
    if depth < 1 or trees < 1:
        raise ValueError("a forest has a tree and a level")
    if key is not None:
        train = train.withColumn("id", F.xxhash64(key))
    dense, y = _dense(train, features).alias("x"), F.col(label).cast("int").alias("y")
    rows = train.select(F.col("id") if key is not None else F.xxhash64(dense, y).alias("id"), dense, y).where(
        "x IS NOT NULL AND y IS NOT NULL"
    )
    n, top = rows.agg(F.count(F.lit(1)), F.max("y")).first()
    if not n:
        raise ValueError("no rows to fit")
    thresholds = quantile_cuts(rows, bins)
    shape = Shape(max(classes or 0, int(top) + 1, 2), depth, len(thresholds), bins, seed)
    stored = cut_lineage(rows.mapInArrow(lambda it: _state(it, thresholds), _STATE))

    distinct = list(dict.fromkeys(settings))
    grown = [(setting, number) for setting in distinct for number in range(trees)]
    blank = [0] * shape.classes
    found: list[dict[int, tuple]] = [{0: (-1, 0, blank)} for _ in grown]

    def forest(some):
        """The open trees of a pass and the places of their open nodes."""
        mine: dict[int, dict[int, int]] = {}
        for place, (t, node) in enumerate(some):
            mine.setdefault(t, {})[node] = place
        opened = [(*grown[t], ClassTree.of(found[t], shape.classes)) for t in mine]
        where = [
            np.array([places.get(i, -1) for i in tree.node.tolist()]) for (_, _, tree), places in zip(opened, mine.values())
        ]
        return opened, where

    def width(item):
        return grown[item[0]][0].subset(shape.features) * shape.bins * shape.classes

    large, small, sizes = [], [], {}
    if n > node_rows:
        large = [(t, 0) for t in range(len(grown))]
    else:
        for t, node, feature, bin_, counts in _grow_whole(stored, grown, shape):
            found[t][node] = (feature, bin_, counts)
    while large:
        below = []
        cuts: dict[tuple, tuple] = {}
        for some in _passes(large, width, cells):
            cuts |= _cut_large(stored, grown, some, forest, shape)
        for (t, node), (feature, bin_, left, total) in sorted(cuts.items()):
            found[t][node] = (feature, bin_, total)
            if feature < 0:
                continue
            for child, counts in ((2 * node + 1, left), (2 * node + 2, [a - b for a, b in zip(total, left)])):
                found[t][child] = (-1, 0, counts)
                level = (child + 1).bit_length() - 1
                if level < depth and sum(c > 0 for c in counts) > 1:
                    sizes[t, child] = sum(counts)
                    (below if sizes[t, child] > node_rows else small).append((t, child))
        large = below
    for some in _passes(small, sizes.get, copies or max(4 * n, 1 << 20)):
        for t, node, feature, bin_, counts in _finish_small(
            stored, grown, some, forest, shape, sum(sizes[item] for item in some)
        ):
            found[t][node] = (feature, bin_, counts)
    discard(stored)
    made = {
        setting: Forest(
            setting, shape, features, label, thresholds,
            [ClassTree.of(found[i * trees + j], shape.classes) for j in range(trees)],
        )
        for i, setting in enumerate(distinct)
    }
    return [made[s] for s in settings]
