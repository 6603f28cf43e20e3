"""Registry and shared pieces of the query catalog."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill import dims
from prosemill.functions import text as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under an operator's name, with its SQL if there is one."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str, spread: bool = False) -> DataFrame:
    """A test table; `spread` deals one that is read in fewer tasks than the session has cores.

    The test tables are single row groups, which Spark cannot split.  Nothing in the library reads
    tables this way.
    """
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if spread and df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents", True)


# --- the same building blocks as SQL text -------------------------------------

WORD = r"[\p{L}\p{N}_]"
SPACES = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SPACE = f"[{SPACES}]"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(words) -> str:
    return "(" + ", ".join(lit(w) for w in words) + ")"


STOP = in_list(dims.STOP_WORDS)
PUNCT = lit(dims.PUNCTUATION)
BLANKS = lit(" " * len(dims.PUNCTUATION))


def sql_strip_punct(x: str) -> str:
    return f"translate({x}, {PUNCT}, {BLANKS})"


def sql_squeeze(x: str) -> str:
    return f"regexp_replace({x}, '{SPACE}+', ' ', 'g')"


def sql_digits(x: str) -> str:
    return f"regexp_replace({x}, '\\p{{Nd}}+', '', 'g')"


def sql_ws(x: str) -> str:
    """Blank-separated tokens."""
    return f"regexp_extract_all({x}, '[^{SPACES}]+')"


def sql_words(x: str) -> str:
    return f"regexp_extract_all({x}, '{WORD}+')"


def sql_terms(x: str) -> str:
    return f"regexp_extract_all({x}, '{WORD}{{2,}}')"


def sql_unstopped(tokens: str) -> str:
    return f"list_filter({tokens}, lambda w: w NOT IN {STOP})"


def sql_preprocess_tokens(x: str) -> str:
    return sql_unstopped(sql_ws(sql_digits(sql_squeeze(sql_strip_punct(f"lower({x})")))))


def sql_preprocess(x: str) -> str:
    return f"array_to_string({sql_preprocess_tokens(x)}, ' ')"


def sql_hash(key: str, seed: int = 42) -> str:
    """The 60-bit sampling hash."""
    return f"('0x' || substr(md5({key} || '|{seed}'), 1, 15))::BIGINT"


def doc_tokens() -> Column:
    """Preprocessed tokens of `documents.text`."""
    return T.preprocess_tokens(F.lower("text"))


def doc_terms() -> Column:
    """TF-IDF tokens of `documents.text`, stop words removed."""
    return T.drop_stopwords(T.tokenize_terms(F.lower("text")))


# words of the preprocessed documents, one row each, in order
SQL_DOC_WORDS = f"""
  SELECT doc_id, unnest(toks) AS word, generate_subscripts(toks, 1) AS pos
  FROM (SELECT doc_id, {sql_preprocess_tokens('text')} AS toks FROM documents)
"""
SQL_DOC_TERMS = f"""
  SELECT doc_id, unnest({sql_unstopped(sql_terms('lower(text)'))}) AS term FROM documents
"""


def joined(c: str | Column, by: str = "|") -> Column:
    """An array as text, for results that compare as plain values."""
    return F.array_join(F.col(c) if isinstance(c, str) else c, by)


def r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)
