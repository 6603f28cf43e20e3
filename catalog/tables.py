"""Sources and sinks, labels, sampling, grouping and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import documents, in_list, lit, query, r6, sql_hash, table
from prosemill import dims
from prosemill.functions import text as T
from prosemill.operators import sampling
from prosemill.operators import tables as O
from prosemill.operators.vectors import expand_vector, select_features as gather_features
from prosemill.session import scratch_path
from prosemill.sources import files

# --- sources and sinks ----------------------------------------------------------

_DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
_SQL_DOCUMENTS = "SELECT doc_id, text, lang, source, n_chars FROM documents"


@query("read_csv", _SQL_DOCUMENTS)
def read_csv(spark, sf):
    path = scratch_path(spark, "documents-csv")
    files.write_csv(documents(spark, sf), path)
    return files.read_csv(spark, path, _DOC_SCHEMA).select(
        "doc_id", T.text_or_empty(F.col("text")).alias("text"), "lang", "source", "n_chars"
    )


@query(
    "write_csv",
    "SELECT vec_id, label, round(embedding[1], 6) AS e0, round(embedding[64], 6) AS e63 FROM embeddings",
)
def write_csv(spark, sf):
    path = scratch_path(spark, "vectors-csv")
    files.write_csv(
        table(spark, sf, "embeddings", True).select("vec_id", "label", "embedding"), path, "embedding", 64
    )
    names = ", ".join(f"w2v_emb_{i} float" for i in range(64))
    back = files.read_csv(spark, path, f"vec_id long, label int, {names}")
    return back.select(
        "vec_id", "label", F.round(F.col("w2v_emb_0"), 6).alias("e0"),
        F.round(F.col("w2v_emb_63"), 6).alias("e63"),
    )


@query("read_csv_indexed", "SELECT 'Customer ' || c_custkey AS row_label, c_mktsegment AS segment FROM customer")
def read_csv_indexed(spark, sf):
    path = scratch_path(spark, "indexed-csv")
    files.write_csv(
        table(spark, sf, "customer").select(
            F.concat(F.lit("Customer "), F.col("c_custkey")).alias("Unnamed: 0"),
            F.col("c_mktsegment").alias("segment"),
        ),
        path,
    )
    return files.read_csv_indexed(spark, path, "row_label", "segment string")


@query(
    "read_jsonl_many",
    """SELECT text AS "reviewText", lang AS summary, CAST(n_chars % 5 + 1 AS DOUBLE) AS overall,
       lang AS category FROM documents""",
)
def read_jsonl_many(spark, sf):
    path = scratch_path(spark, "reviews-json")
    rows = documents(spark, sf).select(
        F.col("text").alias("reviewText"),
        F.col("lang").alias("summary"),
        (F.col("n_chars") % 5 + 1).cast("double").alias("overall"),
        F.lit("not read").alias("asin"),
        F.col("lang").alias("part"),
    )
    rows.write.partitionBy("part").json(path)
    read = files.read_jsonl_many(spark, [f"{path}/part=*"])
    # Spark names its own part files, so here the folder carries the category
    folder = F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), "part=([^/]+)/", 1))
    return read.withColumn("category", F.nullif(folder, F.lit("__HIVE_DEFAULT_PARTITION__")))


@query(
    "read_volumes",
    "SELECT CAST(doc_id AS INTEGER) AS volume, coalesce(text, '') AS text FROM documents",
)
def read_volumes(spark, sf):
    path = scratch_path(spark, "volumes")
    docs = documents(spark, sf).withColumn("text", F.coalesce("text", F.lit("")))
    # one text file per document, many in an archive, French and Spanish ones as ISO-8859-1 where possible
    latin = F.col("text").rlike(r"^[\x{0}-\x{ff}]*$") & F.col("lang").isin("fr", "es")
    content = F.when(latin, F.encode("text", "ISO-8859-1")).otherwise(F.col("text").cast("binary"))
    name = F.concat(F.lit("v"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(".txt"))
    files.write_text_archives(docs.select(name.alias("name"), content.alias("content")), path)
    return files.read_volumes(spark, path, archives=True)


@query(
    "write_counts_csv",
    "SELECT source AS volume, lang AS condition, count(*) AS n FROM documents GROUP BY ALL",
)
def write_counts_csv(spark, sf):
    path = scratch_path(spark, "counts-csv")
    counts = (
        table(spark, sf, "documents")
        .groupBy(F.col("source").alias("volume"), F.col("lang").alias("condition"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    files.write_counts_csv(counts, path)
    return spark.read.schema("condition string, n long, volume string").option("header", True).csv(path).select(
        "volume", "condition", "n"
    )


# --- rules that stand in for trained models: a prediction per document and rule ---
_RULES = [("short", "low", 1500), ("short", "high", 2000), ("long", "low", 2500), ("long", "high", 3000)]
SQL_PREDICTIONS = " UNION ALL ".join(
    f"SELECT d.doc_id, l.quality AS rating, '{m}' AS model, '{e}' AS embedding, "
    f"CAST(d.n_chars > {cut} AS INTEGER) AS prediction "
    "FROM documents d JOIN labels l USING (doc_id)"
    for m, e, cut in _RULES
)


def predictions(spark, sf):
    rated = table(spark, sf, "documents").join(
        table(spark, sf, "labels").select("doc_id", F.col("quality").alias("rating")), "doc_id"
    )
    rules = F.array(
        *[
            F.struct(
                F.lit(m).alias("model"), F.lit(e).alias("embedding"),
                (F.col("n_chars") > c).cast("int").alias("prediction"),
            )
            for m, e, c in _RULES
        ]
    )
    return rated.select("doc_id", "rating", F.inline(rules))


@query(
    "write_errors_csv",
    f"""SELECT doc_id, rating, prediction, model, embedding,
    CASE WHEN prediction = 1 THEN 'false_positive' ELSE 'false_negative' END AS kind
    FROM ({SQL_PREDICTIONS}) WHERE prediction <> rating""",
)
def write_errors_csv(spark, sf):
    path = scratch_path(spark, "errors-csv")
    files.write_errors_csv(predictions(spark, sf), path)
    schema = "doc_id long, rating int, prediction int, model string, embedding string, kind string"
    return spark.read.schema(schema).option("header", True).csv(path)


_PROFILE = ["doc_id", "lang", "source", "n_chars"]


@query(
    "inspect",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count({c}) AS non_null,
        count(DISTINCT {c}) AS "distinct" FROM documents"""
        for c in _PROFILE
    ),
)
def inspect(spark, sf):
    return O.profile(table(spark, sf, "documents"), _PROFILE)


# --- projections, filters, labels ------------------------------------------------

_OVERALL = "CAST(substr(o_orderpriority, 1, 1) AS DOUBLE)"
SQL_REVIEWS = f"SELECT o_orderkey, {_OVERALL} AS overall, o_totalprice FROM orders"


def reviews(spark, sf):
    return table(spark, sf, "orders", True).select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("double").alias("overall"), "o_totalprice"
    )


def rated(spark, sf):
    kept = O.drop_neutral(reviews(spark, sf))
    return kept.withColumn("rating", O.binary_label(F.col("overall")))


SQL_RATED = f"""SELECT o_orderkey, overall, o_totalprice, CAST(overall > 3 AS INTEGER) AS rating
  FROM ({SQL_REVIEWS}) WHERE CAST(overall AS INTEGER) <> 3"""


@query("with_column", "SELECT doc_id, n_chars, n_chars + 1 AS n_next, upper(lang) AS lang FROM documents")
def with_column(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "n_chars", "lang").withColumns(
        {"n_next": F.col("n_chars") + 1, "lang": F.upper("lang")}
    )


@query("drop_neutral", f"SELECT * FROM ({SQL_REVIEWS}) WHERE CAST(overall AS INTEGER) <> 3")
def drop_neutral(spark, sf):
    return O.drop_neutral(reviews(spark, sf))


@query("binary_label", SQL_RATED)
def binary_label(spark, sf):
    return rated(spark, sf)


@query(
    "split_by_label",
    f"""SELECT 'negative' AS side, o_orderkey FROM ({SQL_RATED}) WHERE rating = 0
    UNION ALL SELECT 'positive', o_orderkey FROM ({SQL_RATED}) WHERE rating = 1""",
)
def split_by_label(spark, sf):
    negative, positive = O.split_by_label(rated(spark, sf))
    return negative.select(F.lit("negative").alias("side"), "o_orderkey").unionByName(
        positive.select(F.lit("positive").alias("side"), "o_orderkey")
    )


@query("false_positives", f"SELECT * FROM ({SQL_PREDICTIONS}) WHERE prediction = 1 AND rating = 0")
def false_positives(spark, sf):
    return O.false_positives(predictions(spark, sf))


@query("false_negatives", f"SELECT * FROM ({SQL_PREDICTIONS}) WHERE prediction = 0 AND rating = 1")
def false_negatives(spark, sf):
    return O.false_negatives(predictions(spark, sf))


@query("threshold_label", "SELECT event_id, CAST(value / 100 > 0.5 AS INTEGER) AS label FROM events")
def threshold_label(spark, sf):
    from prosemill.functions.vectors import threshold_label as cut

    return table(spark, sf, "events").select("event_id", cut(F.col("value") / 100).alias("label"))


@query(
    "select_features",
    "SELECT vec_id, label, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS total FROM embeddings",
)
def select_features(spark, sf):
    wide = expand_vector(table(spark, sf, "embeddings"), "embedding", 64)
    gathered = gather_features(wide, ["vec_id", "label"], 64)
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return gathered.select("vec_id", "label", F.round(total, 6).alias("total"))


@query("select_label", "SELECT doc_id, text, quality AS label FROM documents JOIN labels USING (doc_id)")
def select_label(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "text", F.col("quality").alias("label")
    )


@query("rows_by_id", "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def rows_by_id(spark, sf):
    ids = table(spark, sf, "labels").where("toxic = 1")
    return O.rows_by_id(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), ids, "doc_id")


@query("cluster_members", "SELECT vec_id, label FROM embeddings WHERE label = 3")
def cluster_members(spark, sf):
    return O.cluster_members(table(spark, sf, "embeddings").select("vec_id", "label"), 3, "label")


@query("attach_predictions", SQL_PREDICTIONS)
def attach_predictions(spark, sf):
    return predictions(spark, sf)


_TYPES = {"STANDARD": "PLAIN", "ECONOMY": "PLAIN", "SMALL": "SIZED", "MEDIUM": "SIZED", "LARGE": "SIZED"}


@query(
    "group_categories",
    "SELECT p_partkey, CASE "
    + " ".join(f"WHEN p_type = {lit(k)} THEN {lit(v)}" for k, v in _TYPES.items())
    + " ELSE p_type END AS p_type FROM part",
)
def group_categories(spark, sf):
    groups = spark.createDataFrame(list(_TYPES.items()), "category string, grp string")
    return O.group_categories(table(spark, sf, "part").select("p_partkey", "p_type"), "p_type", groups)


# --- unions -----------------------------------------------------------------------


@query(
    "union_rows",
    "SELECT doc_id AS id, text FROM documents UNION ALL SELECT item_id, text FROM benchmark",
)
def union_rows(spark, sf):
    return O.union_rows(
        table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"),
        table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text"),
    )


@query(
    "union_distinct",
    "SELECT text FROM documents UNION SELECT text FROM benchmark UNION SELECT text FROM conversations",
)
def union_distinct(spark, sf):
    return O.union_distinct(
        *[table(spark, sf, t).select("text") for t in ("documents", "benchmark", "conversations")]
    )


@query("except_rows", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def except_rows(spark, sf):
    return table(spark, sf, "documents").select("doc_id").join(
        table(spark, sf, "labels").select("doc_id"), "doc_id", "left_anti"
    )


# --- aggregations -----------------------------------------------------------------


@query("value_counts", "SELECT lang, count(*) AS n FROM documents GROUP BY lang ORDER BY n DESC, lang")
def value_counts(spark, sf):
    return O.value_counts(table(spark, sf, "documents"), "lang")


@query("count_distinct", "SELECT count(DISTINCT p_type) AS n_types, count(DISTINCT p_brand) AS n_brands FROM part")
def count_distinct(spark, sf):
    return table(spark, sf, "part").agg(
        F.count_distinct("p_type").alias("n_types"), F.count_distinct("p_brand").alias("n_brands")
    )


@query(
    "avg_length",
    """SELECT CAST(round_even(avg(n), 0) AS INTEGER) AS avg_length
    FROM (SELECT len(regexp_extract_all(text, '[^\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+')) AS n
    FROM documents)""",
)
def avg_length(spark, sf):
    counted = documents(spark, sf).select(T.word_count(F.col("text")).alias("n"))
    return O.avg_length(counted, "n")


@query(
    "length_histogram",
    """WITH s AS (SELECT min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi FROM documents),
    e AS (SELECT CAST(b AS INTEGER) AS bin, lo + (b - 1) * ((hi - lo) / 50) AS lo, lo + b * ((hi - lo) / 50) AS hi
          FROM s, range(1, 51) r(b)),
    c AS (SELECT least(CAST(floor((n_chars - lo) / ((hi - lo) / 50)) AS INTEGER) + 1, 50) AS bin, count(*) AS n
          FROM documents, s GROUP BY 1)
    SELECT bin, round(lo, 6) AS lo, round(hi, 6) AS hi, coalesce(n, 0) AS n FROM e LEFT JOIN c USING (bin)""",
)
def length_histogram(spark, sf):
    bins = O.length_histogram(table(spark, sf, "documents").select("n_chars"), "n_chars")
    return bins.select("bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "n")


@query(
    "describe_by",
    " UNION ALL ".join(
        f"""SELECT overall, '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean,
        round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min,
        round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
        round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max
        FROM (SELECT {_OVERALL} AS overall, o_totalprice, CAST(o_custkey AS DOUBLE) AS o_custkey FROM orders)
        GROUP BY overall"""
        for c in ("o_totalprice", "o_custkey")
    ),
)
def describe_by(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.substring("o_orderpriority", 1, 1).cast("double").alias("overall"), "o_totalprice", "o_custkey"
    )
    d = O.describe_by(rows, "overall", ["o_totalprice", "o_custkey"])
    return d.select(
        "overall", "column", "count",
        *[F.round(c, 4).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")],
    )


_CORR = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
        for a in _CORR for b in _CORR
    ),
)
def corr_matrix(spark, sf):
    return O.corr_matrix(table(spark, sf, "lineitem"), _CORR).select("a", "b", r6("r").alias("r"))


# --- order, sampling, splitting -----------------------------------------------------

_H = sql_hash("doc_id")


@query("shuffle", f"SELECT doc_id, lang FROM documents ORDER BY {_H}, doc_id")
def shuffle(spark, sf):
    return sampling.shuffle(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")


@query("first_n", "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 5")
def first_n(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "n_chars").orderBy("doc_id").limit(5)


@query("sample_n", f"SELECT doc_id, lang FROM documents ORDER BY {_H}, doc_id LIMIT 100")
def sample_n(spark, sf):
    return sampling.sample_n(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 100)


@query(
    "sample_fraction",
    f"""SELECT o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (ORDER BY {sql_hash('o_orderkey')}, o_orderkey)
      <= round_even(0.5 * (SELECT count(*) FROM orders), 0)""",
)
def sample_fraction(spark, sf):
    return sampling.sample_fraction(
        table(spark, sf, "orders", True).select("o_orderkey", "o_totalprice"), "o_orderkey", 0.5
    )


@query(
    "balance_classes",
    f"""SELECT o_orderkey, overall, o_totalprice, rating FROM (
      SELECT *, row_number() OVER (PARTITION BY rating ORDER BY {sql_hash('o_orderkey')}, o_orderkey) AS rn,
             count(*) OVER (PARTITION BY rating) AS n FROM ({SQL_RATED}))
    WHERE (rating = 0 AND rn <= 500) OR (rating = 1 AND rn <= round_even(0.1 * n, 0))""",
)
def balance_classes(spark, sf):
    return sampling.balance_classes(rated(spark, sf), "o_orderkey", "rating", 500, 0.1)


@query(
    "train_test_split",
    f"""SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {sql_hash('o_orderkey')}, o_orderkey)
      <= ceil(0.25 * (SELECT count(*) FROM orders)) THEN 'test' ELSE 'train' END AS split FROM orders""",
)
def train_test_split(spark, sf):
    return sampling.train_test_split(table(spark, sf, "orders", True).select("o_orderkey"), "o_orderkey", 0.25)


@query(
    "holdout_tail",
    f"SELECT o_orderkey, {sql_hash('o_orderkey', 43)} % 10000 >= 8000 AS holdout FROM orders",
)
def holdout_tail(spark, sf):
    return sampling.holdout_tail(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")
