"""Entity tables and condition counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill import dims
from prosemill.functions import entities as E
from prosemill.operators.scaling import lookup_join


def city_table(spark: SparkSession, cities: Sequence[str] = tuple(dims.CITIES)) -> DataFrame:
    """The built-in gazetteer as a table; pass your own `name` table for full coverage."""
    return spark.createDataFrame([(c,) for c in sorted(set(cities))], "name string")


def _with_city_flag(df: DataFrame, word: str, cities: DataFrame, flag: str) -> DataFrame:
    dim = cities.select(F.col("name").alias(word)).distinct().withColumn(flag, F.lit(True))
    return lookup_join(df, dim, word, "left")


def gazetteer_city(df: DataFrame, word: str, cities: DataFrame, out: str = "City") -> DataFrame:
    """`out` = the word where it is a known city, else null."""
    flagged = _with_city_flag(df, word, cities, "_known")
    return flagged.withColumn(out, F.when(F.col("_known"), F.col(word))).drop("_known")


def exclude_city(df: DataFrame, word: str, cities: DataFrame, out: str) -> DataFrame:
    """`out` = the word where it is not a known city, else null."""
    flagged = _with_city_flag(df, word, cities, "_known")
    return flagged.withColumn(out, F.when(F.col("_known").isNull(), F.col(word))).drop("_known")


def extract_city(df: DataFrame, text: str, cities: DataFrame) -> DataFrame:
    """`df` with `City`."""
    candidates = df.withColumn("_city", E.city_candidate(F.col(text)))
    return gazetteer_city(candidates, "_city", cities, "City").select(*df.columns, "City")


def extract_company(df: DataFrame, text: str, cities: DataFrame) -> DataFrame:
    """`df` with `Company name`."""
    candidates = df.withColumn("_company", E.company_candidate(F.col(text)))
    return exclude_city(candidates, "_company", cities, "Company name").select(
        *df.columns, "Company name"
    )


def extract_entities(
    df: DataFrame,
    id_col: str,
    text: str,
    cities: DataFrame | None = None,
    states: Mapping[str, str] = dims.STATES,
) -> DataFrame:
    """(id, ten entity columns) for every row."""
    cities = city_table(df.sparkSession) if cities is None else cities
    t = F.col(text)
    name, phones = E.extract_name(t), E.extract_phones(t)
    found = df.select(
        id_col,
        name["first"].alias("First_Name"),
        name["last"].alias("Last_Name"),
        E.extract_address(t).alias("Address"),
        E.extract_email(t).alias("Email"),
        F.get(phones, 0).alias("Phone_1"),
        F.get(phones, 1).alias("Phone_2"),
        E.extract_county(t).alias("County"),
        E.extract_state(t, states).alias("State"),
        E.city_candidate(t).alias("_city"),
        E.company_candidate(t).alias("_company"),
    )
    found = gazetteer_city(found, "_city", cities, "City")
    found = exclude_city(found, "_company", cities, "Company name")
    return found.select(id_col, *[f"`{c}`" for c in dims.ENTITY_COLUMNS])


Literals = Mapping[str, Sequence[str]]


def parse_condition(
    spark: SparkSession, conditions: Sequence[str] = tuple(dims.CONDITIONS),
    literals: Literals = dims.CONDITION_LITERALS,
) -> DataFrame:
    """(condition, part): one row per literal that is counted for a condition."""
    rows = [(c, p) for c in conditions for p in E.condition_literals(c, literals)]
    return spark.createDataFrame(rows, "condition string, part string")


def _count_columns(text: str, conditions: Sequence[str], literals: Literals):
    """Per row, one count per condition, over text folded once."""
    counts = []
    for condition in conditions:
        parts = [
            E.count_literal(F.col(text), p, folded=True)
            for p in E.condition_literals(condition, literals)
        ]
        total = parts[0]
        for p in parts[1:]:
            total = total + p
        counts.append(total.cast("long"))
    return counts


def condition_pivot(
    df: DataFrame, volume: str, text: str, conditions: Sequence[str] = tuple(dims.CONDITIONS),
    literals: Literals = dims.CONDITION_LITERALS,
) -> DataFrame:
    """(volume, one count column per condition).

    One scan counts every condition in the row; partial sums leave each task as
    one row per volume, so a volume of any size costs the shuffle nothing.
    """
    folded = df.select(volume, E.fold_case(F.col(text)).alias("_folded"))
    sums = [
        F.sum(c).alias(condition)
        for c, condition in zip(_count_columns("_folded", conditions, literals), conditions)
    ]
    return folded.groupBy(volume).agg(*sums)


def condition_counts(
    df: DataFrame, volume: str, text: str, conditions: Sequence[str] = tuple(dims.CONDITIONS),
    literals: Literals = dims.CONDITION_LITERALS,
) -> DataFrame:
    """(volume, condition, n): the long form of `condition_pivot`."""
    wide = condition_pivot(df, volume, text, conditions, literals)
    entries = [
        F.struct(F.lit(c).alias("condition"), F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias("n"))
        for c in conditions
    ]
    return wide.select(volume, F.inline(F.array(*entries)))
