"""Reviews prepared as their files arrive.

All inputs of the analyses are bounded files, so nothing here keeps state: the
same projections and filters run on a stream of JSON-lines files, and each file
is written once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from prosemill.plans.reviews import label_reviews
from prosemill.session import scratch_path
from prosemill.sources.files import REVIEWS


def stream_reviews(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Labelled and cleaned reviews of every JSON-lines file put into `folder`."""
    raw = (
        spark.readStream.schema(REVIEWS)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(folder)
    )
    return label_reviews(raw)


def write_reviews(stream: DataFrame, path: str, progress: str | None = None) -> StreamingQuery:
    """Append to Parquet, all files present now, exactly once per file.

    `progress` keeps the state between runs; give the same folder each time.
    """
    progress = progress or scratch_path(stream.sparkSession, "progress")
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
