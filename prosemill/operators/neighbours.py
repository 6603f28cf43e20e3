"""Exact nearest neighbours and exact Euclidean silhouette, block by block.

Rows are placed in blocks of bounded size by id hash (inside Voronoi cells for
neighbours).  Two blocks meet in one task through an equi join on their block
numbers; a task holds two blocks whatever the skew, and emits k rows or one sum
per cluster for each of its rows, never a pair table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prosemill.functions.vectors import l2_normalize
from prosemill.operators.sampling import sample_n
from prosemill.operators.scaling import lookup_join
from prosemill.session import cut_lineage

# Distances are compared after rounding to this many places, ties by id.
PLACES = 9
# The blocks of a silhouette, and the rows of a block at most.
BLOCKS, MOST_BLOCK_ROWS = 32, 1 << 16
CELLS = 1 << 21  # distances that a task holds at once
SCORED_ROWS = 4096  # rows whose sums of all blocks a task adds at once
NO_CLUSTER = 1 << 40
# The blocks of a neighbour search, and the rows of a block at least.
KNN_BLOCKS, LEAST_BLOCK_ROWS = 16, 1024


def _matrix(s: pd.Series) -> np.ndarray:
    return np.stack(s.to_numpy()).astype(np.float64) if len(s) else np.empty((0, 0))


def _k_best(
    ids: np.ndarray, other: np.ndarray, a: np.ndarray, b: np.ndarray, k: int, bound: np.ndarray | None = None
) -> pd.DataFrame:
    """The k nearest rows of b for each row of a (unit vectors), itself and those beyond its bound excluded."""
    parts = []
    step = min(256, max(1, CELLS // max(len(b), 1)))
    for at in range(0, len(a), step):
        mine = ids[at:at + step]
        dist = np.round(1.0 - a[at:at + step] @ b.T, PLACES) + 0.0
        dist[mine[:, None] == other[None, :]] = np.inf
        near = np.isfinite(dist)
        if bound is not None:
            near &= dist <= bound[at:at + step, None]
        if dist.shape[1] > k:
            near &= dist <= np.partition(dist, k - 1, axis=1)[:, k - 1:k]
        row, col = np.nonzero(near)
        d = dist[row, col]
        order = np.lexsort((other[col], d, row))
        row, col, d = row[order], col[order], d[order]
        best = np.arange(len(row)) - np.searchsorted(row, row) < k
        parts.append((mine[row[best]], other[col[best]], d[best]))
    if not parts:
        return pd.DataFrame({"id": [], "nbr": [], "dist": []}).astype(
            {"id": "int64", "nbr": "int64", "dist": "float64"}
        )
    i, n, d = (np.concatenate(x) for x in zip(*parts))
    return pd.DataFrame({"id": i, "nbr": n, "dist": d})


def knn_graph(
    df: DataFrame, id_col: str, vec_col: str, k: int = 40, block_rows: int | None = None,
    max_cells: int | None = None,
) -> DataFrame:
    """(id, nbr, dist, rank): the k nearest rows by cosine distance, exact, for every row.

    Where the data has no structure, every row visits every block, so there are about `KNN_BLOCKS` blocks as long
    as a task can hold two of them, and what is shuffled grows with the rows.

    Rows with the same direction are one group, represented by its smallest id.
    The neighbours of the representatives give the k + 1 nearest rows of each
    group; every row takes that list without itself.  A group of any size thus
    costs one search.  Distances count to nine places, ties by id.  Ids must be
    whole numbers.
    """
    rows = cut_lineage(
        df.select(F.col(id_col).cast("long").alias("id"), l2_normalize(F.col(vec_col)).alias("vec"))
        .withColumn("key", F.md5(F.array_join(F.transform("vec", lambda x: (x + 0.0).cast("string")), ",")))
    )
    # a limit on a row number is applied before the shuffle as well as after it
    few = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    members = cut_lineage(rows.withColumn("n", few).where(F.col("n") <= k + 1))
    heads = members.where("n = 1").select("id", "vec", "key")
    near = _distinct_knn(heads.select("id", "vec"), k, block_rows, max_cells)
    groups = near.select("id", "nbr", "dist").unionByName(
        heads.select("id", F.col("id").alias("nbr"), F.lit(0.0).alias("dist"))
    )
    of_head = members.join(heads.select("key", F.col("id").alias("nbr")), "key").select(
        "nbr", F.col("id").alias("member")
    )
    candidates = groups.join(of_head, "nbr").select("id", F.col("member").alias("nbr"), "dist")
    best = F.row_number().over(Window.partitionBy("id").orderBy("dist", "nbr"))
    lists = (
        candidates.withColumn("n", best)
        .where(F.col("n") <= k + 1)
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("dist", "nbr"))).alias("list"))
        .join(heads.select("id", "key"), "id")
        .select("key", "list")
    )
    lists = cut_lineage(lists)
    mine = lookup_join(rows.select("id", "key"), lists, "key").select(
        "id",
        F.posexplode(
            F.slice(F.filter("list", lambda x: x["nbr"] != F.col("id")), 1, k)
        ).alias("at", "hit"),
    )
    return mine.select(
        F.col("id").alias(id_col), F.col("hit.nbr").alias("nbr"), F.col("hit.dist").alias("dist"),
        (F.col("at") + 1).alias("rank"),
    )


def _distinct_knn(unit: DataFrame, k: int, block_rows: int | None, max_cells: int | None) -> DataFrame:
    """(id, nbr, dist, rank) for distinct unit vectors (id, vec).

    1. Unit vectors are assigned to the nearest pivot: one for each block of rows, at
       most the root of their number (so that assigning costs n^1.5), or `max_cells`;
       cells are split into blocks of about `block_rows` rows.
    2. Each row finds its k nearest in its own block, which bounds its k-th
       distance.
    3. Triangle inequalities on the pivots rule out cells that cannot hold a
       nearer row; the row visits the blocks of the remaining cells.
    4. The candidates of all visited blocks are merged.
    """
    n = unit.count()
    block_rows = block_rows or min(max(math.ceil(n / KNN_BLOCKS), LEAST_BLOCK_ROWS), MOST_BLOCK_ROWS)
    cells = max(1, min(max_cells or math.ceil(math.sqrt(n)), n // block_rows))
    pivots = np.array([r.vec for r in sample_n(unit, "id", cells).orderBy("id").collect()])
    if not len(pivots):
        return _rank(unit.select("id", F.col("id").alias("nbr"), F.lit(0.0).alias("dist")), k)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                gap = np.sqrt(np.maximum(0, 2 - 2 * _matrix(pdf.vec) @ pivots.T))
                cell = gap.argmin(axis=1)
                yield pdf.assign(cell=cell.astype("int32"), gap=gap[np.arange(len(pdf)), cell])

    placed = unit.mapInPandas(place, "id long, vec array<double>, cell int, gap double")
    stats = {
        r.cell: r
        for r in placed.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("n"), F.min("gap").alias("lo"), F.max("gap").alias("hi"))
        .collect()
    }
    blocks = {c: math.ceil(s.n / block_rows) for c, s in stats.items()}
    per_cell = F.create_map(*[F.lit(x) for kv in blocks.items() for x in kv])
    rows = cut_lineage(
        placed.withColumn(
            "block", F.pmod(F.xxhash64("id"), F.element_at(per_cell, F.col("cell"))).cast("int")
        )
    )

    def own_block(pdf: pd.DataFrame) -> pd.DataFrame:
        v, ids = _matrix(pdf.vec), pdf.id.to_numpy()
        return _k_best(ids, ids, v, v, k)

    first = rows.groupBy("cell", "block").applyInPandas(own_block, "id long, nbr long, dist double")
    if n <= 1 or (len(blocks) == 1 and max(blocks.values()) == 1):
        return _rank(first, k)
    first = cut_lineage(first)
    bound = first.groupBy("id").agg(
        F.when(F.count(F.lit(1)) >= k, F.max("dist")).alias("bound")
    )

    order = sorted(stats)
    centre = pivots[order]
    apart = np.sqrt(np.maximum(1e-12, 2 - 2 * centre @ centre.T))
    lo = np.array([stats[c].lo for c in order])
    hi = np.array([stats[c].hi for c in order])
    position = {c: i for i, c in enumerate(order)}

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            gap = np.sqrt(np.maximum(0, 2 - 2 * _matrix(pdf.vec) @ centre.T))
            own = pdf.cell.map(position).to_numpy()
            mine = gap[np.arange(len(pdf)), own][:, None]
            least = np.maximum.reduce(
                [gap - hi, lo - gap, (gap**2 - mine**2) / (2 * apart[own])]
            )
            least[np.arange(len(pdf)), own] = 0
            reach = np.sqrt(2 * (pdf.bound.fillna(np.inf).to_numpy() + 10.0**-PLACES))
            open_ = least <= reach[:, None] + 1e-7
            yield pdf[["id", "vec", "bound", "cell", "block"]].assign(
                targets=[[order[j] for j in np.flatnonzero(o)] for o in open_]
            )

    # stored once for each row, not for each visit
    aimed = cut_lineage(
        rows.join(bound, "id", "left").mapInPandas(
            visits, "id long, vec array<double>, bound double, cell int, block int, targets array<int>"
        )
    )
    going = (
        aimed.select("id", "vec", "bound", F.col("cell").alias("home"), F.col("block").alias("from"),
                F.explode("targets").alias("cell"))
        .withColumn(
            "block",
            F.explode(F.sequence(F.lit(0), F.element_at(per_cell, F.col("cell")) - 1)),
        )
        .where((F.col("cell") != F.col("home")) | (F.col("block") != F.col("from")))
        .select("id", "vec", "bound", "cell", "block")
    )
    # one count per visited cell: (row, block) visits, spread evenly over its blocks
    load = {r.cell: r.n for r in going.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not load:
        return _rank(first, k)
    chunks = {c: max(1, math.ceil(m / blocks[c] / block_rows)) for c, m in load.items()}
    per_target = F.create_map(*[F.lit(x) for kv in chunks.items() for x in kv])
    chunk = F.pmod(F.xxhash64("id", F.lit(7)), F.element_at(per_target, F.col("cell"))).cast("int")
    guests = going.withColumn("chunk", chunk)
    hosts = rows.where(F.col("cell").isin(list(chunks))).select(
        "id", "vec", "cell", "block",
        F.explode(F.sequence(F.lit(0), F.element_at(per_target, F.col("cell")) - 1)).alias("chunk"),
    )

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return _k_best(np.array([], "int64"), np.array([], "int64"), np.empty((0, 1)), np.empty((0, 1)), k)
        bound = a.bound.fillna(np.inf).to_numpy(dtype=np.float64)
        return _k_best(a.id.to_numpy(), b.id.to_numpy(), _matrix(a.vec), _matrix(b.vec), k, bound)

    keys = ["cell", "block", "chunk"]
    more = guests.groupBy(*keys).cogroup(hosts.groupBy(*keys)).applyInPandas(
        meet, "id long, nbr long, dist double"
    )
    return _rank(first.unionByName(more), k)


def _rank(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("id").orderBy("dist", "nbr")
    return (
        found.where(F.col("id") != F.col("nbr"))
        .withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("id", "nbr", "dist", "rank")
    )


def silhouette(
    df: DataFrame, vec_col: str, cluster: str, block_rows: int | None = None
) -> DataFrame:
    """Mean Euclidean silhouette, exact, as the one of `silhouettes`."""
    return silhouettes(df, vec_col, [cluster], block_rows).select("silhouette")


def silhouettes(
    df: DataFrame, vec_col: str, clusters: Sequence[str], block_rows: int | None = None
) -> DataFrame:
    """(place, silhouette): the mean Euclidean silhouette, exact, of each clustering of the same rows.

    All clusterings share the distances, which are taken once.  A row of a block has one sum for each
    cluster of each clustering: sums are taken over the rows of a block that share all their clusters,
    then added by cluster.  A row without a cluster scores 0 and is no neighbour.

    Every block meets every block, so rows travel once for each block: about `BLOCKS` blocks as long
    as a task can hold two of them, so that what is shuffled grows with the rows.

    Copies of a row within its clusters are one weighted row.  Needs the distance
    of every two distinct rows; for more than a few million of them use the
    squared distance, which needs one pass.
    """
    spark = df.sparkSession
    rows = cut_lineage(
        df.groupBy(
            F.transform(F.col(vec_col), lambda x: x.cast("double") + 0.0).alias("vec"),
            F.array(*[F.coalesce(F.col(c).cast("int").cast("long"), F.lit(NO_CLUSTER)) for c in clusters]).alias("own"),
        )
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    n = rows.count()
    block_rows = block_rows or min(max(math.ceil(n / BLOCKS), 4096), MOST_BLOCK_ROWS)
    blocks = max(1, math.ceil(n / block_rows))
    sizes = (
        rows.select("copies", F.posexplode("own").alias("place", "cluster")).where(F.col("cluster") != NO_CLUSTER)
        .groupBy("place", "cluster").agg(F.sum("copies").alias("size")).orderBy("place", "cluster").collect()
    )  # a row for each cluster
    kinds = [np.array([s.cluster for s in sizes if s.place == p], np.int64) for p in range(len(clusters))]
    size = [np.array([s["size"] for s in sizes if s.place == p], np.float64) for p in range(len(clusters))]
    starts = np.cumsum([0, *map(len, kinds)])
    mine = rows.withColumn("a", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = mine.withColumn("b", every)
    # columns of its own, or Spark drops those it shares with the other side
    right = mine.select(*[F.col(c).alias(c) for c in rows.columns], F.col("a").alias("b")).withColumn("a", every)

    def places(own: np.ndarray) -> np.ndarray:
        """Of rows with their clusters, each cluster's column among those of all clusterings; -1 if it has none."""
        out = np.full(own.shape, -1)
        for p, of in enumerate(kinds):
            if len(of):
                at = np.minimum(np.searchsorted(of, own[:, p]), len(of) - 1)
                out[:, p] = np.where(of[at] == own[:, p], starts[p] + at, -1)
        return out

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"id": np.zeros(0, "int64"), "own": [], "copies": np.zeros(0, "int64"), "totals": []})
        x, y = _matrix(a.vec), _matrix(b.vec)
        shared, of = np.unique(np.stack(b.own.to_numpy()), axis=0, return_inverse=True)
        order = np.argsort(of.ravel(), kind="stable")
        first = np.searchsorted(of.ravel()[order], np.arange(len(shared)))
        y, copies = y[order], b.copies.to_numpy()[order].astype(np.float64)
        member = np.zeros((len(shared), starts[-1]))
        place = places(shared)
        group, at = np.nonzero(place >= 0)
        member[group, place[group, at]] = 1.0
        # |x|^2 + |y|^2 - 2 xy as one product
        x = np.hstack([-2 * x, (x * x).sum(axis=1)[:, None], np.ones((len(x), 1))])
        y = np.hstack([y, np.ones((len(y), 1)), (y * y).sum(axis=1)[:, None]]).T
        # a row meets itself where a block meets itself only
        itself = a.a.iloc[0] == a.b.iloc[0]
        if itself:
            ids = b.id.to_numpy()[order]
            by_id = np.argsort(ids)
            twin = by_id[np.searchsorted(ids[by_id], a.id.to_numpy())]
        totals = np.empty((len(x), starts[-1]))
        step = min(512, max(1, CELLS // y.shape[1]))
        for at in range(0, len(x), step):
            d = x[at:at + step] @ y
            if itself:
                d[np.arange(len(d)), twin[at:at + step]] = 0
            np.maximum(d, 0, out=d)
            np.sqrt(d, out=d)
            if (copies != 1).any():
                d *= copies
            totals[at:at + step] = np.add.reduceat(d, first, axis=1) @ member
        return pd.DataFrame({"id": a.id, "own": a.own, "copies": a.copies, "totals": list(totals)})

    def score(rows: pd.DataFrame) -> pd.DataFrame:
        """Of a group of rows with the sums of each block, each clustering's scores added, and the rows."""
        _, one, of = np.unique(rows.id.to_numpy(), return_index=True, return_inverse=True)
        total = np.zeros((len(one), starts[-1]))
        np.add.at(total, of.ravel(), np.stack(rows.totals.to_numpy()))
        place = places(np.stack(rows.own.to_numpy()[one]))
        copies = rows.copies.to_numpy()[one].astype(np.float64)
        sums = []
        for p, n in enumerate(size):
            mean = total[:, starts[p]:starts[p + 1]].copy()
            known = np.flatnonzero(place[:, p] >= 0)
            own = place[known, p] - starts[p]
            within = np.full(len(one), np.nan)
            alone = n[own] == 1 if len(n) else np.zeros(0, bool)
            within[known] = np.where(alone, np.nan, mean[known, own] / np.where(alone, 1, n[own] - 1))
            mean /= n
            mean[known, own] = np.inf
            between = mean.min(axis=1, initial=np.inf)
            most = np.maximum(within, between)
            good = (place[:, p] >= 0) & np.isfinite(between) & ~np.isnan(within) & (most > 0)
            sums.append(((between[good] - within[good]) / most[good] * copies[good]).sum())
        return pd.DataFrame({"place": np.arange(len(size), dtype="int32"), "s": sums, "n": copies.sum()})

    if not n:
        return spark.range(len(clusters)).select(F.col("id").cast("int").alias("place"), F.lit(None).cast("double").alias("silhouette"))
    met = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInPandas(
        meet, "id long, own array<long>, copies long, totals array<double>"
    )
    groups = -(-n // SCORED_ROWS)
    scores = met.groupBy(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(groups))).applyInPandas(
        score, "place int, s double, n double"
    )
    return scores.groupBy("place").agg((F.sum("s") / F.sum("n")).alias("silhouette"))
