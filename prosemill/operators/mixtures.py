"""Gaussian mixtures of many sizes and folds, fitted together.

All fits share their scans: an iteration of expectation-maximisation reads the rows once, each task adds
up the sufficient statistics of every fit still open, keyed (fit, component), Spark adds those up, and the
driver gets components x (1 + d + d^2) numbers a fit, whatever the number of rows.  A fit that has settled
leaves the scan.  The fit of fold f does not see the rows of fold f; the fit of no fold sees all.

A fit starts from a k-means clustering of a sample of at most `SAMPLE` of its rows; the sample has no other
use.  It has settled when the mean log-likelihood of its rows changes by less than `tol`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.operators.sampling import fold_of
from prosemill.session import cut_lineage

SAMPLE = 4096
HELD = 1 << 19  # numbers of rows and their products that a task holds at once
FLOOR = 1e-6  # added to the variances
WHOLE = -1  # the fold of a fit that sees all rows


@dataclass
class Mixture:
    """Weights (k), means (k, d) and covariances (k, d, d); rows and log-likelihood of the last scan."""

    weights: np.ndarray
    means: np.ndarray
    covs: np.ndarray
    rows: int = 0
    log_likelihood: float = -np.inf
    steps: int = 0
    settled: bool = False

    def logs(self, x: np.ndarray) -> np.ndarray:
        """ln (weight * density) of each row and component; one product gives the distances to all components."""
        k, d = self.means.shape
        roots = np.linalg.cholesky(self.covs)
        turned = np.linalg.solve(roots, np.broadcast_to(np.eye(d), roots.shape))  # the roots' inverses
        log_det = 2 * np.log(np.diagonal(roots, axis1=1, axis2=2)).sum(axis=1)
        centre = self.means.mean(axis=0)  # small numbers lose less
        shift = np.einsum("kij,kj->ki", turned, self.means - centre).ravel()
        z = (x - centre) @ turned.reshape(k * d, d).T
        z -= shift
        z *= z
        far = z @ np.repeat(np.eye(k), d, axis=0)
        return np.log(self.weights + 1e-300) - 0.5 * (d * np.log(2 * np.pi) + log_det) - 0.5 * far

    def bic(self) -> float:
        """-2 ln L + p ln n with p = (k-1) + k d + k d (d+1)/2."""
        k, d = self.means.shape
        p = (k - 1) + k * d + k * d * (d + 1) / 2
        return -2 * self.log_likelihood + p * float(np.log(self.rows))


def _from_sums(n: np.ndarray, s: np.ndarray, ss: np.ndarray) -> tuple:
    d = s.shape[1]
    n = np.maximum(n, 10 * np.finfo(float).eps)
    means = s / n[:, None]
    covs = ss / n[:, None, None] - means[:, :, None] * means[:, None, :]
    covs = (covs + covs.transpose(0, 2, 1)) / 2 + FLOOR * np.eye(d)
    return n / n.sum(), means, np.stack([_positive(c) for c in covs])


def _positive(cov: np.ndarray) -> np.ndarray:
    """The covariance with eigenvalues of `FLOOR` at least."""
    values, vectors = np.linalg.eigh(cov)
    return cov if values[0] >= FLOOR else (vectors * np.maximum(values, FLOOR)) @ vectors.T


def _top_sum(logs: np.ndarray) -> np.ndarray:
    top = logs.max(axis=1)
    return top + np.log(np.exp(logs - top[:, None]).sum(axis=1))


def _start(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 20) -> Mixture:
    """From k-means on sample rows, its first centres drawn far from each other."""
    centres = x[[int(rng.integers(len(x)))]]
    while len(centres) < k:
        far = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2).min(axis=1)
        share = far / far.sum() if far.sum() > 0 else np.full(len(x), 1 / len(x))
        centres = np.vstack([centres, x[rng.choice(len(x), p=share)]])
    for _ in range(rounds):
        own = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.stack([x[own == j].mean(axis=0) if (own == j).any() else centres[j] for j in range(k)])
        if np.allclose(new, centres):
            break
        centres = new
    r = np.eye(k)[own] + 1e-3 / k  # no component starts without rows
    return Mixture(*_from_sums(r.sum(axis=0), r.T @ x, np.einsum("nk,ni,nj->kij", r, x, x)))


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _scan(fits: dict[tuple[int, int], Mixture]):
    """For mapInArrow over (fold, x): (k, fold, component, sums) of a task's rows; the component -1
    holds the rows and their log-likelihood.  The products of a row's numbers serve all components and fits."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}

        def put(key: tuple, value: np.ndarray) -> None:
            sums[key] = sums[key] + value if key in sums else value

        for batch in batches:
            folds, rows = batch.column("fold").to_numpy(), _rows(batch)
            step = max(1, HELD // (1 + rows.shape[1] + rows.shape[1] ** 2)) if len(rows) else 1
            for lo in range(0, len(rows), step):
                fold, every = folds[lo : lo + step], rows[lo : lo + step]
                products = (every[:, :, None] * every[:, None, :]).reshape(len(every), -1)
                moments = np.hstack([np.ones((len(every), 1)), every, products])
                for (k, f), fit in fits.items():
                    seen = fold != f
                    x = every[seen]
                    if not len(x):
                        continue
                    logs = fit.logs(x)
                    top = logs.max(axis=1)
                    share = np.exp(logs - top[:, None])
                    whole = share.sum(axis=1)
                    put((k, f, -1), np.array([len(x), (top + np.log(whole)).sum()]))
                    share /= whole[:, None]
                    added = share.T @ (moments if len(x) == len(every) else moments[seen])
                    for j in range(k):
                        put((k, f, j), added[j])
        keys = sorted(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[i] for key in keys], pa.int32()) for i in range(3)]
            + [pa.array([sums[key] for key in keys], pa.list_(pa.float64()))],
            ["k", "fold", "component", "sums"],
        )

    return add


def _added(data: DataFrame, fits: dict) -> dict[tuple[int, int, int], np.ndarray]:
    part = data.mapInArrow(_scan(fits), "k int, fold int, component int, sums array<double>")
    got = (
        part.select("k", "fold", "component", F.posexplode("sums").alias("at", "s"))
        .groupBy("k", "fold", "component", "at").agg(F.sum("s").alias("s"))
        .groupBy("k", "fold", "component")
        .agg(F.sort_array(F.collect_list(F.struct("at", "s")))["s"].alias("sums"))  # 1 + d + d^2 numbers
        .collect()  # one row for each component of a fit
    )
    return {(r.k, r.fold, r.component): np.array(r.sums) for r in got}


def prepared(df: DataFrame, id_col: str, features: str, folds: int) -> DataFrame:
    """(id, fold, x) stored, read once an iteration."""
    return cut_lineage(
        df.select(id_col, fold_of(id_col, folds).cast("int").alias("fold"), vector_to_array(features).alias("x"))
    )


def fit(
    data: DataFrame, specs: Sequence[tuple[int, int]], max_iter: int = 100, tol: float = 1e-3, seed: int = 42
) -> dict[tuple[int, int], Mixture]:
    """Mixtures by (k, fold), from rows as `prepared` gives them."""
    n = data.count()
    share = max(1, n // SAMPLE)
    some = (
        data.where(F.pmod(F.xxhash64("x"), F.lit(share)) == 0).select("fold", "x").orderBy(F.xxhash64("x"), "x")
        .limit(SAMPLE).toArrow()
    )
    if not some.num_rows:
        return {}
    fold = some.column("fold").to_numpy()
    x = np.array(some.column("x").to_pylist(), dtype=float).reshape(len(fold), -1)
    fits = {}
    for k, f in specs:
        mine = x[fold != f]
        if len(mine):
            fits[k, f] = _start(mine, k, np.random.default_rng([seed, k]))
    for step in range(max_iter):
        left = {key: m for key, m in fits.items() if not m.settled}
        if not left:
            break
        sums = _added(data.select("fold", "x"), left)
        for (k, f), m in left.items():
            rows, total = sums[k, f, -1]
            m.settled = m.rows > 0 and abs(total - m.log_likelihood) < tol * rows
            m.rows, m.log_likelihood, m.steps = int(rows), float(total), step + 1
            if not m.settled:
                parts = np.stack([sums[k, f, j] for j in range(k)])
                d = m.means.shape[1]
                m.weights, m.means, m.covs = _from_sums(
                    parts[:, 0], parts[:, 1 : d + 1], parts[:, d + 1 :].reshape(k, d, d)
                )
    return fits


def held_out(data: DataFrame, fits: dict[tuple[int, int], Mixture]) -> dict[tuple[int, int], float]:
    """The mean log-likelihood of each fold under the fit that did not see it; one scan for all."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold, every = batch.column("fold").to_numpy(), _rows(batch)
            out = []
            for (k, f), m in fits.items():
                x = every[fold == f]
                if f != WHOLE and len(x):
                    out.append((k, f, len(x), float(_top_sum(m.logs(x)).sum())))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.float64()))],
                ["k", "fold", "n", "s"],
            )

    got = data.select("fold", "x").mapInArrow(score, "k int, fold int, n long, s double").groupBy("k", "fold").agg(
        (F.sum("s") / F.sum("n")).alias("mean")
    )
    return {(r.k, r.fold): r.mean for r in got.collect()}  # a row for each fit


def clusters(data: DataFrame, id_col: str, fits: dict[tuple[int, int], Mixture]) -> DataFrame:
    """(id, x, one column `k<k>` for each fit of all rows): the most likely component; one scan."""
    whole = {k: m for (k, f), m in fits.items() if f == WHOLE}
    kind = data.schema[id_col].dataType.simpleString()

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch)
            own = [pa.array(m.logs(x).argmax(axis=1).astype(np.int32)) for m in whole.values()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), batch.column("x"), *own], [id_col, "x", *[f"k{k}" for k in whole]]
            )

    columns = "".join(f", k{k} int" for k in whole)
    return data.select(id_col, "x").mapInArrow(label, f"`{id_col}` {kind}, x array<double>{columns}")
