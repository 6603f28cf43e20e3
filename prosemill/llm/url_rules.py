"""URL filter: host-suffix and path-prefix expressions looked up by hash prefix.

Every URL is expanded into the expressions `suffix of the host + prefix of the path` that a rule
could hold: as many labels, and as many path characters, as some rule has.  Expressions meet the
rules in an equi-join on the first 32 bits of their SHA-256; a match counts once the full digests
agree.  Of the matching rules of a URL the longest (host and path together) wins, then the longer
host, then block before allow.

All of it is DataFrame functions.  The expressions of one URL are at most (host labels of rules) x
(path lengths of rules), a number that depends on the rules only.  URLs are reduced to distinct
(host, path cut to the longest rule path) pairs before they are expanded, so a host that holds a
third of all rows costs its distinct paths only; Spark broadcasts the rules when its size
statistics allow and otherwise shuffles both sides by prefix.

Defined results: a null URL or one without `://` has empty host and path, fits no rule and gets the
default verdict.  Repeated rows are judged each.  Other columns travel along; columns of the input
named host, path, rule or verdict give way to the results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESULTS = ("host", "path", "rule", "verdict")
PREFIX_DIGITS = 8  # hex digits of the digest that the join uses


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first `://`, and the path up to `?` or `#`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, upper, lower), path


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A rules table from (host, path, allow or block)."""
    return spark.createDataFrame(rules, "rule_host string, rule_path string, action string")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """`pages` with host, path, rule (host + path, null if none fits) and verdict.

    rules: rule_host, rule_path, action.  Rules of equal host and path: block wins.
    """
    known = (
        rules.where("rule_host is not null and rule_path is not null and action is not null")
        .groupBy("rule_host", "rule_path")
        .agg(F.max("action").alias("action"))
        .withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path")))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    )
    # what shapes of expressions the rules ask for: bounded by the labels and characters of a URL
    shapes = known.select(
        F.size(F.split("rule_host", r"\.")).alias("labels"), F.length("rule_path").alias("chars")
    ).agg(
        F.sort_array(F.collect_set("labels")).alias("labels"),
        F.sort_array(F.collect_set("chars")).alias("chars"),
    ).first()
    labels, chars = list(shapes.labels), list(shapes.chars)

    # the input's columns may have any names: what is made here is named apart from them
    mark = "_"
    while any(c.startswith(mark) for c in pages.columns):
        mark += "_"
    own_host, own_path, cut, best = (f"{mark}{c}" for c in ("host", "path", "cut", "best"))
    host, path = host_and_path(F.col(f"`{url}`"))
    urls = pages.withColumn(own_host, host).withColumn(own_path, path)
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in RESULTS]
    results = [F.col(own_host).alias("host"), F.col(own_path).alias("path")]
    if not labels:
        return urls.select(*kept, *results, F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    urls = urls.withColumn(cut, F.substring(own_path, 1, max(chars)))
    parts = F.split("host", r"\.")
    suffixes = F.array_compact(
        F.array(*[F.when(F.size(parts) >= n, F.substring_index("host", ".", -n)) for n in labels])
    )
    heads = F.array_compact(
        F.array(*[F.when(F.length("cut") >= n, F.substring("cut", 1, n)) for n in chars])
    )
    expressions = (
        urls.select(F.col(own_host).alias("host"), F.col(cut).alias("cut"))
        .where("host <> ''")
        .distinct()
        .withColumn("rule_host", F.explode(suffixes))
        .withColumn("rule_path", F.explode(heads))
        .withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path")))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    )
    found = (
        expressions.alias("e")
        .join(known.alias("k"), "prefix")
        .where(
            "e.digest = k.digest and e.rule_host = k.rule_host and e.rule_path = k.rule_path"
        )
        .groupBy(F.col("e.host").alias(own_host), F.col("e.cut").alias(cut))
        .agg(
            F.max(
                F.struct(
                    (F.length("k.rule_host") + F.length("k.rule_path")).alias("size"),
                    F.length("k.rule_host").alias("host_size"),
                    F.col("k.action").alias("action"),
                    F.concat("k.rule_host", "k.rule_path").alias("rule"),
                )
            ).alias(best)
        )
    )
    return urls.join(found, [own_host, cut], "left").select(
        *kept, *results, F.col(best)["rule"].alias("rule"), F.coalesce(F.col(best)["action"], F.lit(default)).alias("verdict")
    )
