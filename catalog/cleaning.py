"""Text cleaning and standardising queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (
    PUNCT,
    SQL_DOC_WORDS,
    documents,
    joined,
    query,
    sql_digits,
    sql_preprocess,
    sql_squeeze,
    sql_strip_punct,
    sql_terms,
    sql_unstopped,
    sql_words,
    sql_ws,
    STOP,
    table,
)
from prosemill import dims
from prosemill.functions import text as T
from prosemill.operators import spelling


def _documents(name: str, column, sql: str, out: str = "result"):
    """Register a text expression over documents.text."""

    @query(name, f"SELECT doc_id, {sql} AS {out} FROM documents")
    def run(spark, sf):
        return documents(spark, sf).select("doc_id", column(F.col("text")).alias(out))


_documents("lower_text", T.lower_text, "lower(text)")
_documents("text_or_empty", T.text_or_empty, "coalesce(CAST(text AS VARCHAR), '')")
_documents("strip_punct", T.strip_punct, sql_strip_punct("text"))
_documents("squeeze_ws", T.squeeze_ws, sql_squeeze("text"))
_documents("strip_digits", T.strip_digits, sql_digits("text"))
_documents("word_count", T.word_count, f"CAST(len({sql_ws('text')}) AS INTEGER)", "n_words")
_documents(
    "preprocess_text",
    lambda c: T.preprocess_text(F.lower(c)),
    sql_preprocess("text"),
)
_documents(
    "drop_stopwords",
    lambda c: joined(T.drop_stopwords(T.tokenize_words(F.lower(c))), " "),
    f"array_to_string({sql_unstopped(sql_words('lower(text)'))}, ' ')",
)
_documents(
    "tokenize_ws",
    lambda c: joined(T.tokenize_ws(c), " "),
    f"array_to_string({sql_ws('text')}, ' ')",
)
_documents(
    "tokenize_words",
    lambda c: joined(T.tokenize_words(c), " "),
    f"array_to_string({sql_words('text')}, ' ')",
)
_documents(
    "standardize_decimals",
    T.standardize_decimals,
    r"regexp_replace(text, '(\p{Nd}+),(\p{Nd}+)', '\1.\2', 'g')",
)

_THOUSANDS = r"""
  array_to_string(list_transform(
    list_zip(regexp_split_to_array({x}, '\p{{Nd}}+'),
             list_append(regexp_extract_all({x}, '\p{{Nd}}+'), '')),
    lambda p: p[1] || CASE WHEN length(p[2]) > 3 THEN
       ltrim(reverse(regexp_replace(reverse(p[2]), '(\p{{Nd}}{{3}})', '\1,', 'g')), ',')
       ELSE p[2] END), '')
"""
_documents("standardize_thousands", T.standardize_thousands, _THOUSANDS.format(x="text"))


@query(
    "concat_text",
    "SELECT conv_id, turn, coalesce(role, '') || ' ' || coalesce(text, '') AS result FROM conversations",
)
def concat_text(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", T.concat_text(F.col("role"), F.col("text")).alias("result")
    )


@query(
    "standardize_dates",
    """SELECT o_orderkey, 'placed ' || strftime(o_orderdate, '%Y-%m-%d') || ', again '
       || strftime(o_orderdate, '%Y-%m-%d') || ' not 13/45/2020' AS result FROM orders""",
)
def standardize_dates(spark, sf):
    d = F.col("o_orderdate")
    text = F.concat(
        F.lit("placed "), F.month(d), F.lit("/"), F.dayofmonth(d), F.lit("/"), F.year(d),
        F.lit(", again "), F.year(d), F.lit("-"), F.month(d), F.lit("-"), F.dayofmonth(d),
        F.lit(" not 13/45/2020"),
    )
    return table(spark, sf, "orders", True).select(
        "o_orderkey", T.standardize_dates(text).alias("result")
    )


@query(
    "standardize_currency",
    r"""SELECT l_orderkey, l_linenumber, l_partkey, 'price ' || format('${:,.2f}', l_extendedprice)
       || ' per ' || format('${:,.2f}', l_quantity) || ' units' AS result FROM lineitem""",
)
def standardize_currency(spark, sf):
    # prices as written by hand: no commas, one to two decimals, a blank after the sign
    text = F.concat(
        F.lit("price $ "), F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
        F.lit(" per $"), F.col("l_quantity").cast("decimal(18,1)").cast("string"),
        F.lit(" units"),
    )
    return table(spark, sf, "lineitem", True).select(
        "l_orderkey", "l_linenumber", "l_partkey", T.standardize_currency(text).alias("result")
    )


@query(
    "expand_contractions",
    """SELECT c_custkey, 'they have said ' || lower(c_name) || ' cannot pay, it is late; we will not '
       || 'wait, you would know: ' || lower(c_mktsegment) || ' is not fun' AS result FROM customer""",
)
def expand_contractions(spark, sf):
    text = F.concat(
        F.lit("They've said "), F.col("c_name"), F.lit(" can't pay, it’s late; we won't "),
        F.lit("wait, you'd know: "), F.col("c_mktsegment"), F.lit(" isn't fun"),
    )
    return table(spark, sf, "customer", True).select(
        "c_custkey", T.expand_contractions(T.lower_text(text)).alias("result")
    )


_NOTE = sql_squeeze(sql_strip_punct("lower(text)"))
_NUMBERS = (
    r"regexp_replace(" + _THOUSANDS.format(x="note").strip()
    + r", '(\p{Nd}+),(\p{Nd}+)', '\1.\2', 'g')"
)
# spelling: rare words (fewer than 5 uses) and frequent words meet on strings
# with at most one character deleted
_SPELL = """
  counts AS (SELECT word, count(*) AS n FROM words GROUP BY word),
  keyed AS (
    SELECT word, n, unnest(list_distinct(list_append(list_transform(
      range(1, length(word) + 1), lambda i: word[1:i - 1] || word[i + 1:]), word))) AS key
    FROM counts),
  near AS (
    SELECT DISTINCT a.word, b.word AS candidate, b.n
    FROM keyed a JOIN keyed b ON a.key = b.key
    WHERE a.n < 5 AND b.n >= 5
      AND damerau_levenshtein_chars(a.word, b.word)),
  fixes AS (
    SELECT word, candidate AS corrected FROM near
    QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, candidate) = 1)
"""
# one edit apart, by characters: for equal lengths the differing positions are
# one, or two neighbours swapped; otherwise the longer word loses one character
_ONE_EDIT = """(
  (length(a.word) = length(b.word) AND (
     len(list_filter(range(1, length(a.word) + 1), lambda i: a.word[i] <> b.word[i])) = 1
     OR len(list_filter(range(1, length(a.word)), lambda i:
          a.word[1:i - 1] || a.word[i + 1] || a.word[i] || a.word[i + 2:] = b.word)) > 0))
  OR (length(a.word) = length(b.word) + 1 AND
     len(list_filter(range(1, length(a.word) + 1), lambda i:
          a.word[1:i - 1] || a.word[i + 1:] = b.word)) > 0)
  OR (length(b.word) = length(a.word) + 1 AND
     len(list_filter(range(1, length(b.word) + 1), lambda i:
          b.word[1:i - 1] || b.word[i + 1:] = a.word)) > 0))"""
_SPELL = _SPELL.replace("damerau_levenshtein_chars(a.word, b.word)", _ONE_EDIT)


@query(
    "correct_spelling",
    f"""WITH words AS ({SQL_DOC_WORDS}), {_SPELL}
    SELECT d.doc_id, coalesce(t.result, '') AS result
    FROM documents d LEFT JOIN (
      SELECT doc_id, string_agg(coalesce(corrected, w.word), ' ' ORDER BY pos) AS result
      FROM words w LEFT JOIN fixes f ON w.word = f.word GROUP BY doc_id) t USING (doc_id)""",
)
def correct_spelling(spark, sf):
    fixed = spelling.correct_spelling(
        documents(spark, sf), "doc_id", T.preprocess_tokens(F.lower("text")), min_count=5
    )
    return fixed.select("doc_id", joined("tokens", " ").alias("result"))


@query(
    "preprocess_note",
    f"""WITH notes AS (SELECT doc_id, {_NOTE} AS note FROM documents),
    words AS (
      SELECT doc_id, unnest(toks) AS word, generate_subscripts(toks, 1) AS pos
      FROM (SELECT doc_id, {sql_ws('note')} AS toks FROM notes)),
    {_SPELL},
    spelled AS (
      SELECT doc_id, string_agg(coalesce(corrected, w.word), ' ' ORDER BY pos) AS note
      FROM words w LEFT JOIN fixes f ON w.word = f.word GROUP BY doc_id),
    numbered AS (SELECT doc_id, {_NUMBERS} AS note FROM spelled)
    SELECT d.doc_id,
           coalesce(array_to_string({sql_unstopped(sql_ws('note'))}, ' '), '') AS result
    FROM documents d LEFT JOIN numbered n USING (doc_id)""",
)
def preprocess_note(spark, sf):
    from prosemill.plans.notes import preprocess_note as run

    return run(documents(spark, sf), "doc_id", "text").select("doc_id", F.col("note").alias("result"))
