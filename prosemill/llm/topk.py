"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

The query rows are cut into blocks of bounded size.  For a block, every partition of the candidates
turns each of its Arrow batches into postings (dimension -> rows and weights), scatters the weighted
postings of each query's non-zero terms into a dense score array, selects each query's k best of the
partition and hands only those on; a shuffle by query merges them.  A block of queries is the only
thing sent to all tasks, and its size is a parameter; the candidates never move.  Work is queries x
rows, as exhaustive search demands.

Defined results: vectors that are null, or hold null or non-finite components, and null ids take no
part.  A vector's missing trailing components count as zero.  Repeated rows are rows each: a query's
own row, told by a row number, is no candidate, rows equal to it are, and repeated queries get results
each.  Scores are 64-bit integers (sums wrap beyond that range).  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prosemill.llm.common import int_matrix, stored

QUERY_BLOCK = 4096  # queries sent to the tasks at once
STRIPE = 2048  # candidates scored at once; with it the score array stays in the cache
GROUP = 64  # queries scored at once


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(id, terms): floor(scale * x) as longs, without the vectors that take no part."""
    x = F.col(vec_col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    return (
        df.where(F.col(id_col).isNotNull() & x.isNotNull())
        .where(~bad)
        .select(
            F.col(id_col).alias("vec_id"),
            F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double"))).alias("terms"),
        )
    )


def _postings(matrix: np.ndarray) -> list[tuple[np.ndarray | slice, np.ndarray]]:
    lists = []
    for d in range(matrix.shape[1]):
        rows = np.flatnonzero(matrix[:, d])
        full = 2 * len(rows) > len(matrix)  # nearly all rows: a plain column is the same postings
        lists.append((slice(None), matrix[:, d].copy()) if full else (rows, matrix[rows, d]))
    return lists


def _scores(queries: np.ndarray, postings: list, n: int) -> np.ndarray:
    """Dense scores of a group of queries, one term after the other."""
    scores = np.zeros((len(queries), n), np.int64)
    for d, (rows, weights) in enumerate(postings):
        having = np.flatnonzero(queries[:, d])
        if not len(having) or not len(weights):
            continue
        if isinstance(rows, slice):
            if len(having) == len(queries):
                scores += queries[:, d, None] * weights
            else:
                scores[having] += queries[having, d, None] * weights
        else:
            scores[np.ix_(having, rows)] += queries[having, d, None] * weights
    return scores


def _searcher(block, k: int):
    schema = pa.schema(
        [("query_row", pa.int64()), ("query_id", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()),
         ("score", pa.int64())]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_rows, query_ids, queries = block.value
        wide = queries.shape[1]
        nq = len(query_rows)
        best: list[tuple] = []  # (query index, row, vec_id, score) arrays of what may still win
        held = 0

        def trim() -> None:
            nonlocal best, held
            if not best:
                return
            q, r, v, s = (np.concatenate(x) for x in zip(*best))
            order = np.lexsort((r, v, ~s, q))  # ~s falls as s rises, without overflow
            q, r, v, s = q[order], r[order], v[order], s[order]
            first = np.searchsorted(q, q, side="left")
            keep = np.arange(len(q)) - first < k
            best = [(q[keep], r[keep], v[keep], s[keep])]
            held = int(keep.sum())

        for batch in batches:
            rows_all = batch.column("row").to_numpy(zero_copy_only=False)
            ids_all = batch.column("vec_id").to_numpy(zero_copy_only=False)
            matrix_all = int_matrix(batch.column("terms"), wide)
            for lo in range(0, len(ids_all), STRIPE):
                rows, ids, matrix = (x[lo : lo + STRIPE] for x in (rows_all, ids_all, matrix_all))
                order = np.lexsort((rows, ids))
                rows, ids, matrix = rows[order], ids[order], matrix[order]
                postings = _postings(matrix)
                for at in range(0, nq, GROUP):
                    scores = _scores(queries[at : at + GROUP], postings, len(ids))
                    own = query_rows[at : at + GROUP, None] == rows[None, :]
                    few = min(len(ids), k)
                    ranked = np.where(own, np.iinfo(np.int64).min, scores)
                    floor = np.partition(ranked, len(ids) - few, axis=1)[:, len(ids) - few, None]
                    # all rows above the k-th best, and of those equal to it the smallest ids
                    above, level = ranked > floor, ranked == floor
                    room = few - above.sum(axis=1, keepdims=True)
                    picked = (above | (level & (np.cumsum(level, axis=1) <= room))) & ~own
                    q, c = np.nonzero(picked)
                    best.append((q + at, rows[c], ids[c], scores[q, c]))
                    held += len(q)
                if held > 8 * nq * k + 100_000:
                    trim()
        trim()
        if best:
            q, r, v, s = best[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(query_rows[q]), pa.array(query_ids[q]), pa.array(r), pa.array(v), pa.array(s)], schema=schema
            )

    return search


FOUND = "query_row long, query_id long, row long, vec_id long, score long"


def _merge(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def top_k(vectors: DataFrame, query: Column, k: int = 5, block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows for each row where `query` holds.

    vectors: as `integer_vectors` gives them.  Ties go to smaller ids.
    """
    spark = vectors.sparkSession
    rows = stored(vectors.withColumn("row", F.monotonically_increasing_id()), "topk-rows")
    asked = rows.where(query)
    blocks = -(-asked.count() // block)
    parts = []
    for b in range(blocks):
        chunk = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).toArrow()
        if not chunk.num_rows:
            continue
        sent = spark.sparkContext.broadcast(
            (chunk.column("row").to_numpy(), chunk.column("vec_id").to_numpy(), int_matrix(chunk.column("terms")))
        )
        merged = _merge(rows.mapInArrow(_searcher(sent, k), FOUND), k)
        if blocks == 1:
            return merged
        parts.append(stored(merged, "topk-part"))  # a block's queries are in no other
        sent.unpersist()
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
