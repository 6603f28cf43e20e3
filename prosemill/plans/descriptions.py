"""Entity tables from descriptions and condition counts from volumes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill import dims
from prosemill.operators import extract
from prosemill.sources import files


def entity_table(spark: SparkSession, path: str, cities: DataFrame | None = None) -> DataFrame:
    """The ten entity columns of every row of a description CSV."""
    rows = files.read_csv(spark, path, files.DESCRIPTIONS).withColumn(
        "row", F.monotonically_increasing_id()
    )
    return extract.extract_entities(rows, "row", "Description", cities)


def volume_counts(
    spark: SparkSession, path: str, conditions: Sequence[str] = tuple(dims.CONDITIONS),
    pattern: str = r"v(\d+)\.txt$",
) -> DataFrame:
    """One row per volume, one column per condition."""
    volumes = files.read_volumes(spark, path, pattern)
    counts = extract.condition_pivot(volumes, "volume", "text", conditions)
    return counts.orderBy("volume")
