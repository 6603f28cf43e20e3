"""The training-data pipeline: stages that each read what the one before has written.

Every stage but the last returns the columns of `documents`.  The operators say how they treat nulls,
empty and repeated rows; a stage adds nothing to that but `n_chars` after masking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill.llm import langid, mixing, packing, pii, simhash
from prosemill.llm.common import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; without a letter, or undecided, they go."""
    return langid.identified(docs, langid.train(docs), min_score=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates, the one with the smallest id."""
    return simhash.distinct_documents(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars counts the new text."""
    out = pii.masked(docs)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(size))
    return out


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    import public_tokenizers

    pieces = packing.token_pieces(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return packing.pack(pieces)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("sequences", sequences),
]
ORACLE_SQL = None  # SQL can't express the language model, fingerprints or tokens


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
