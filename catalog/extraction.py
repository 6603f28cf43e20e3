"""Entity extraction and condition counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SPACE, SPACES, WORD, documents, in_list, joined, lit, query, sql_words, sql_ws, table
from prosemill import dims
from prosemill.functions import entities as E
from prosemill.operators import extract
from prosemill.operators import tables as tables_ops

CITIES = sorted(dims.CITIES)

# A sentence per customer, with name, town, state, address, county, mail and phones.
SQL_PEOPLE = f"""
  SELECT c_custkey,
    'Customer ' || c_custkey || ': a ' || lower(c_mktsegment) || ' buyer from '
    || list_extract({'[' + ', '.join(lit(c) for c in CITIES) + ', ' + lit('Nowhere') + ']'},
                    CAST(c_custkey % {len(CITIES) + 1} AS INTEGER) + 1)
    || ', ' || list_extract({'[' + ', '.join(lit(s) for s in sorted(dims.STATES)) + ']'},
                    CAST(c_nationkey + 1 AS INTEGER))
    || ' lives at ' || (c_custkey + 1) || ' Main St, ' || c_mktsegment || ' County, works at Acme'
    || c_nationkey || ', c' || c_custkey || '@shop.example.com, (415) 555-'
    || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || ' or 1-212-555-0199.' AS text
  FROM customer
"""


def people(spark, sf):
    key = F.col("c_custkey")
    cities = F.array(*[F.lit(c) for c in [*CITIES, "Nowhere"]])
    states = F.array(*[F.lit(s) for s in sorted(dims.STATES)])
    text = F.concat(
        F.lit("Customer "), key, F.lit(": a "), F.lower("c_mktsegment"), F.lit(" buyer from "),
        F.element_at(cities, (key % (len(CITIES) + 1)).cast("int") + 1), F.lit(", "),
        F.element_at(states, (F.col("c_nationkey") + 1).cast("int")),
        F.lit(" lives at "), key + 1, F.lit(" Main St, "), F.col("c_mktsegment"),
        F.lit(" County, works at Acme"), F.col("c_nationkey"), F.lit(", c"), key,
        F.lit("@shop.example.com, (415) 555-"),
        F.lpad((key % 10000).cast("string"), 4, "0"), F.lit(" or 1-212-555-0199."),
    )
    return table(spark, sf, "customer", True).select("c_custkey", text.alias("text"))


def _people(name, column, sql, out="result"):
    @query(name, f"SELECT c_custkey, {sql} AS {out} FROM ({SQL_PEOPLE})")
    def run(spark, sf):
        return people(spark, sf).select("c_custkey", column(F.col("text")).alias(out))


def _documents(name, column, sql, out="result"):
    @query(name, f"SELECT doc_id, {sql} AS {out} FROM documents")
    def run(spark, sf):
        return documents(spark, sf).select("doc_id", column(F.col("text")).alias(out))


def sql_address(x):
    return (
        f"nullif(regexp_extract({x}, '(?:^|[^\\p{{L}}\\p{{N}}_])(\\p{{Nd}}.*?(?:St|Blvd))"
        f"(?:[^\\p{{L}}\\p{{N}}_]|$)', 1), '')"
    )


def sql_emails(x):
    return (
        f"list_filter({sql_ws(x)}, lambda w: "
        r"regexp_matches(w, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]+.$'))"
    )


def sql_email(x):
    return f"regexp_replace({sql_emails(x)}[-1], '[[:punct:]]+$', '')"


def sql_county(x):
    return f"nullif(regexp_extract({x}, '(?i)({WORD}+){SPACE}+county(?:[^\\p{{L}}\\p{{N}}_]|$)', 1), '')"


def sql_phones(x):
    return (
        rf"regexp_extract_all({x}, '\b(?:\+?1{SPACE}*[-.{SPACES}]?)?\(?\p{{Nd}}{{3}}\)?"
        rf"[-.{SPACES}]?\p{{Nd}}{{3}}[-.{SPACES}]?\p{{Nd}}{{4}}\b')"
    )


_CODES = "[" + ", ".join(lit(s) for s in dims.STATES) + "]"
_NAMES = "MAP {" + ", ".join(f"{lit(k)}: {lit(v)}" for k, v in dims.STATES.items()) + "}"


def sql_state(x):
    code = f"list_min(list_intersect({sql_words(x)}, {_CODES}))"
    return f"{code} || '-' || {_NAMES}[{code}]"


def sql_first(x, i):
    return f"CASE WHEN len({sql_words(x)}) >= 2 THEN {sql_words(x)}[{i}] END"


def sql_after_name(x, joint, prepositions):
    # the name is word characters only, so it needs no escaping in the pattern
    name = f"{sql_words(x)}[1] || ' ' || {sql_words(x)}[2]"
    return (
        f"nullif(regexp_extract(replace({x}, ',', ''), {name} || "
        f"'{joint}(?:.*?)(?:{prepositions}){SPACE}+({WORD}+)', 1), '')"
    )


SQL_CANDIDATES = f"""
  SELECT *, {sql_after_name('text', ': ', 'from|of|in')} AS city_word,
         {sql_after_name('text', ' ', 'at|of|from')} AS company_word
  FROM ({SQL_PEOPLE})
"""
SQL_CITY = f"CASE WHEN city_word IN {in_list(CITIES)} THEN city_word END"
SQL_COMPANY = f"CASE WHEN company_word NOT IN {in_list(CITIES)} THEN company_word END"


@query(
    "extract_name",
    f"SELECT doc_id, {sql_first('text', 1)} AS first_name, {sql_first('text', 2)} AS last_name FROM documents",
)
def extract_name(spark, sf):
    name = E.extract_name(F.col("text"))
    return documents(spark, sf).select(
        "doc_id", name["first"].alias("first_name"), name["last"].alias("last_name")
    )


_documents("first_words", lambda c: joined(E.first_words(c), " "),
           f"array_to_string({sql_words('text')}[1:2], ' ')")
_documents("extract_email", E.extract_email, sql_email("text"))
_documents("extract_phones", lambda c: joined(E.extract_phones(c)),
           f"array_to_string({sql_phones('text')}, '|')")
_documents("extract_state", E.extract_state, sql_state("text"))
_documents("extract_address", E.extract_address, sql_address("text"))
_documents("count_literal", lambda c: E.count_literal(c, "the"),
           "CAST((length(lower(text)) - length(replace(lower(text), 'the', ''))) // 3 AS INTEGER)", "n")
_documents(
    "intersect_words",
    lambda c: joined(F.array_sort(F.array_intersect(
        E.tokenize_words(c), F.array(*[F.lit(s) for s in dims.STATES])))),
    f"array_to_string(list_sort(list_distinct(list_intersect({sql_words('text')}, {_CODES}))), '|')",
)
_people("extract_county", E.extract_county, sql_county("text"))
_people("last_email", E.extract_email, sql_email("text"))
_people("state_lookup", E.extract_state, sql_state("text"))


@query(
    "first_phones",
    f"SELECT c_custkey, {sql_phones('text')}[1] AS phone_1, {sql_phones('text')}[2] AS phone_2 "
    f"FROM ({SQL_PEOPLE})",
)
def first_phones(spark, sf):
    p = E.extract_phones(F.col("text"))
    return people(spark, sf).select(
        "c_custkey", F.get(p, 0).alias("phone_1"), F.get(p, 1).alias("phone_2")
    )


@query("extract_city", f"SELECT c_custkey, {SQL_CITY} AS city FROM ({SQL_CANDIDATES})")
def extract_city(spark, sf):
    found = extract.extract_city(people(spark, sf), "text", extract.city_table(spark))
    return found.select("c_custkey", F.col("City").alias("city"))


@query("extract_company", f"SELECT c_custkey, {SQL_COMPANY} AS company FROM ({SQL_CANDIDATES})")
def extract_company(spark, sf):
    found = extract.extract_company(people(spark, sf), "text", extract.city_table(spark))
    return found.select("c_custkey", F.col("Company name").alias("company"))


@query(
    "gazetteer_city",
    f"""SELECT c_custkey, w AS word, CASE WHEN w IN {in_list(CITIES)} THEN w END AS city
    FROM (SELECT c_custkey, unnest({sql_words('text')}) AS w FROM ({SQL_PEOPLE}))""",
)
def gazetteer_city(spark, sf):
    words = people(spark, sf).select("c_custkey", F.explode(E.tokenize_words(F.col("text"))).alias("word"))
    found = extract.gazetteer_city(words, "word", extract.city_table(spark))
    return found.select("c_custkey", "word", F.col("City").alias("city"))


@query(
    "exclude_city",
    f"""SELECT c_custkey, w AS word, CASE WHEN w NOT IN {in_list(CITIES)} THEN w END AS company
    FROM (SELECT c_custkey, unnest({sql_words('text')}) AS w FROM ({SQL_PEOPLE}))""",
)
def exclude_city(spark, sf):
    words = people(spark, sf).select("c_custkey", F.explode(E.tokenize_words(F.col("text"))).alias("word"))
    found = extract.exclude_city(words, "word", extract.city_table(spark), "company")
    return found.select("c_custkey", "word", "company")


_ENTITY_SQL = {
    "First_Name": sql_first("text", 1), "Last_Name": sql_first("text", 2),
    "Address": sql_address("text"), "Email": sql_email("text"),
    "Phone_1": f"{sql_phones('text')}[1]", "Phone_2": f"{sql_phones('text')}[2]",
    "City": SQL_CITY, "County": sql_county("text"), "State": sql_state("text"),
    "Company name": SQL_COMPANY,
}


@query(
    "extract_entities",
    "SELECT c_custkey, " + ", ".join(f'{v} AS "{k}"' for k, v in _ENTITY_SQL.items())
    + f" FROM ({SQL_CANDIDATES})",
)
def extract_entities(spark, sf):
    return extract.extract_entities(people(spark, sf), "c_custkey", "text")


# The 25 conditions do not occur in the documents; these terms do, two of them
# counted by other literals than their names.
TERMS = ["the", "tion and ment", "ing", "ques/ersten/x", "de"]
LITERALS = {**dims.CONDITION_LITERALS, "tion and ment": ["tion", "ment"], "ques/ersten/x": ["ques", "ersten"]}


def _sql_count(term):
    n = len(term)
    return (
        f"(length(lower(text)) - length(replace(lower(text), {lit(term.lower())}, ''))) // {n}"
    )


def _sql_condition(condition):
    return "(" + " + ".join(_sql_count(p) for p in E.condition_literals(condition, LITERALS)) + ")"


ALL_TERMS = [*dims.CONDITIONS, *TERMS]


@query(
    "condition_counts",
    " UNION ALL ".join(
        f"SELECT source AS volume, {lit(c)} AS condition, CAST(sum({_sql_condition(c)}) AS BIGINT) AS n "
        "FROM documents GROUP BY source"
        for c in ALL_TERMS
    ),
)
def condition_counts(spark, sf):
    rows = documents(spark, sf).withColumnRenamed("source", "volume")
    return extract.condition_counts(rows, "volume", "text", ALL_TERMS, LITERALS)


@query(
    "condition_pivot",
    "SELECT source AS volume, "
    + ", ".join(f'CAST(sum({_sql_condition(c)}) AS BIGINT) AS "{c}"' for c in ALL_TERMS)
    + " FROM documents GROUP BY source",
)
def condition_pivot(spark, sf):
    rows = documents(spark, sf).withColumnRenamed("source", "volume")
    return extract.condition_pivot(rows, "volume", "text", ALL_TERMS, LITERALS)


_PARTS = sorted({p for c in ALL_TERMS for p in E.condition_literals(c, LITERALS)})
# how the names become literals, by rule: the SQL does not use the table above
_SQL_PARTS = """SELECT c AS condition, unnest(CASE
    WHEN c = 'HIV/AIDS' THEN [c]
    WHEN contains(c, '/') THEN string_split(c, '/')[1:2]
    WHEN contains(c, ' and ') THEN string_split(c, ' and ')
    ELSE [replace(replace(c, 'diseases', 'disease'), 'Dengue fever', 'Dengue')] END) AS part
  FROM (SELECT unnest([""" + ", ".join(lit(c) for c in ALL_TERMS) + "]) AS c)"


@query(
    "parse_condition",
    f"SELECT condition, part, n FROM ({_SQL_PARTS}) JOIN ("
    + " UNION ALL ".join(
        f"SELECT {lit(p)} AS part, CAST(sum({_sql_count(p)}) AS BIGINT) AS n FROM documents" for p in _PARTS
    )
    + ") USING (part)",
)
def parse_condition(spark, sf):
    # each literal's uses in the documents, beside the conditions that count it
    folded = documents(spark, sf).select(E.fold_case(F.col("text")).alias("t"))
    sums = folded.agg(
        *[F.sum(E.count_literal(F.col("t"), p, folded=True)).alias(f"p{i}") for i, p in enumerate(_PARTS)]
    )
    found = sums.select(
        F.inline(F.array(*[F.struct(F.lit(p).alias("part"), F.col(f"p{i}").alias("n")) for i, p in enumerate(_PARTS)]))
    )
    return extract.parse_condition(spark, ALL_TERMS, LITERALS).join(found, "part").select("condition", "part", "n")
