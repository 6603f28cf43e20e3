"""Labels, categories, unions, profiles and plain aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.operators.scaling import lookup_join, with_running_total


def drop_neutral(df: DataFrame, score: str = "overall") -> DataFrame:
    """Rows whose whole-number score is not 3."""
    return df.where(F.col(score).cast("int") != 3)


def binary_label(c: Column) -> Column:
    """1 for scores above 3, else 0."""
    return (c > 3).cast("int")


def split_by_label(df: DataFrame, label: str = "rating") -> tuple[DataFrame, DataFrame]:
    """(negative rows, positive rows)."""
    return df.where(F.col(label) == 0), df.where(F.col(label) == 1)


def group_categories(df: DataFrame, col: str, groups: Mapping[str, str] | DataFrame) -> DataFrame:
    """Category replaced by its group name; categories without a group stay.

    A dict is written into the plan; a DataFrame (category, group) is joined.
    """
    if isinstance(groups, DataFrame):
        dim = groups.select(
            F.col(groups.columns[0]).alias(col), F.col(groups.columns[1]).alias("_group")
        )
        joined = lookup_join(df, dim, col, "left")
        return joined.withColumn(col, F.coalesce("_group", col)).drop("_group").select(df.columns)
    by_group: dict[str, list[str]] = {}
    for category, group in groups.items():
        by_group.setdefault(group, []).append(category)
    out = F.col(col)
    grouped = None
    for group, categories in by_group.items():
        hit = F.col(col).isin(categories)
        grouped = F.when(hit, group) if grouped is None else grouped.when(hit, group)
    return df if grouped is None else df.withColumn(col, grouped.otherwise(out))


def false_positives(df: DataFrame, label: str = "rating", pred: str = "prediction") -> DataFrame:
    return df.where((F.col(pred) == 1) & (F.col(label) == 0))


def false_negatives(df: DataFrame, label: str = "rating", pred: str = "prediction") -> DataFrame:
    return df.where((F.col(pred) == 0) & (F.col(label) == 1))


def rows_by_id(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of `df` whose id is in `ids`."""
    return df.join(ids.select(id_col), id_col, "left_semi")


def cluster_members(df: DataFrame, cluster: int, col: str = "cluster") -> DataFrame:
    return df.where(F.col(col) == cluster)


def union_rows(*dfs: DataFrame) -> DataFrame:
    """Rows of all tables, matched by column name; missing columns are null."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_rows(*dfs).distinct()


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), col)


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows, non-null values and distinct values of every column, in one pass."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"v{i}"), F.count_distinct(F.col(c)).alias(f"d{i}")]
    wide = df.agg(*aggs)
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col("rows"),
                F.col(f"v{i}").alias("non_null"),
                F.col(f"d{i}").alias("distinct"),
            )
            for i, c in enumerate(cols)
        ]
    )
    return wide.select(F.inline(entries))


def avg_length(df: DataFrame, col: str) -> DataFrame:
    """Mean length, rounded half to even."""
    return df.agg(F.bround(F.avg(col)).cast("int").alias("avg_length"))


def length_histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """`bins` equal-width bins over [min, max]: bin (1..bins), lo, hi, n (zero bins included)."""
    lo, hi = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()
    schema = "bin int, lo double, hi double, n long"
    if lo is None:
        return df.sparkSession.createDataFrame([], schema)
    width = (hi - lo) / bins or 1.0 / bins
    where = F.floor((F.col(col).cast("double") - F.lit(lo)) / F.lit(width)).cast("int") + 1
    counts = (
        df.where(F.col(col).isNotNull())
        .groupBy(F.least(where, F.lit(bins)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = df.sparkSession.range(1, bins + 1, 1, 1).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(lo) + (F.col("id") - 1) * F.lit(width)).alias("lo"),
        (F.lit(lo) + F.col("id") * F.lit(width)).alias("hi"),
    )
    return (
        edges.join(F.broadcast(counts), "bin", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
        .orderBy("bin")
    )


def _long_form(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols
    ]
    return df.select(key, F.inline(F.array(*entries))).where(F.col("value").isNotNull())


def quantiles_by(
    df: DataFrame, key: str, cols: Sequence[str], quantiles: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """Exact linearly interpolated quantiles: key, column, quantile, value.

    Equal values are counted first, so a common value is one row however many
    rows have it.  The distinct values are sorted once by (key, column, value)
    with the running count of rows; only the values at the two places around
    each quantile are kept.  No group is gathered in one task.
    """
    counts = (
        _long_form(df, key, cols).groupBy(key, "column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    placed = with_running_total(counts, [F.col(key), F.col("column"), F.col("value")], "n")
    groups = placed.groupBy(key, "column").agg(
        F.min(F.col("upto") - F.col("n")).alias("start"), F.sum("n").alias("rows")
    )
    # the places (0-based within the group) that each quantile needs, with their weights
    wanted = F.flatten(
        F.array(*[
            F.array(
                F.struct(F.lit(float(q)).alias("quantile"), F.floor(at).alias("at"), (1 - at + F.floor(at)).alias("w")),
                F.struct(F.lit(float(q)).alias("quantile"), F.ceil(at).alias("at"), (at - F.floor(at)).alias("w")),
            )
            for q in quantiles
            for at in [F.lit(float(q)) * (F.col("rows") - 1)]
        ])
    )
    first = F.col("upto") - F.col("n") - F.col("start")
    hits = (
        placed.join(groups.select(key, "column", "start", wanted.alias("wanted")), [key, "column"])
        .select(
            key, "column", "value",
            F.inline(
                F.filter("wanted", lambda x: (x["at"] >= first) & (x["at"] < F.col("upto") - F.col("start")))
            ),
        )
    )
    return hits.groupBy(key, "column", "quantile").agg(F.sum(F.col("w") * F.col("value")).alias("value"))


def describe_by(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max of each column per key (one row per key, column)."""
    basic = (
        _long_form(df, key, cols)
        .groupBy(key, "column")
        .agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    q = quantiles_by(df, key, cols)
    wide = q.groupBy(key, "column").agg(
        *[
            F.max(F.when(F.col("quantile") == v, F.col("value"))).alias(name)
            for v, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
        ]
    )
    return basic.join(wide, [key, "column"]).select(
        key, "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in one pass: a, b, r."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    where = {p: f"r{i}" for i, p in enumerate(pairs)}
    entries = [
        F.struct(
            F.lit(a).alias("a"),
            F.lit(b).alias("b"),
            F.col(where.get((a, b)) or where[(b, a)]).alias("r"),
        )
        for a in cols
        for b in cols
    ]
    return wide.select(F.inline(F.array(*entries)))
