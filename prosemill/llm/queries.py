"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill.llm import centroids, decontam, hard_negatives, langid, mixing, packing, pii, quality
from prosemill.llm import simhash, substrings, topk, url_rules, warc
from prosemill.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_substrings")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    found = substrings.repeated_passages(table(spark, sf, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def _held_out(doc_id="doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1, F.lit(False))


@query("op2_language_id")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text", "lang")
    model = langid.train(docs.where(~_held_out()))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


@query(
    "op3_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
    f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to
    FROM d LEFT JOIN f USING (payload_digest)
    """,
)
def op3(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages", "page_id", "url", "html")
    back = warc.round_trip(pages)
    response = F.col("record_type") == "response"
    return back.select(
        "page_id",
        F.when(response, F.length("payload").cast("long")).otherwise(F.col("header_bytes")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.col("header_digest")).alias("payload_digest"),
        "record_type", "refers_to",
    )


@query("op4_simhash")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents", "doc_id", "text"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op5_quality")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text")
    trusted = quality.trusted_ids(table(spark, sf, "labels", "doc_id", "quality"))
    return quality.assess(docs, trusted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score",
    )


@query("op6_mixing")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", "doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op7_packing")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf, "documents", "doc_id", "text")
    pieces = packing.token_pieces(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return packing.pack(pieces)


@query("op8_pii")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find(table(spark, sf, "documents", "doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in pii.BASE_KINDS],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"),
    )


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query(
    "op9_url_rules",
    r"""
    WITH r(h, p, action) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
           ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
    rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0
                             THEN substr(url, instr(url, '://') + 3) ELSE '' END AS s FROM pages),
    u AS (SELECT page_id,
                 translate(regexp_extract(s, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(s, '^[^/?#]*([^?#]*)', 1) AS path FROM rest)
    SELECT page_id, host, path,
           (SELECT arg_max(h || p, length(h || p)) FROM r WHERE (host = h OR ends_with(host, '.' || h))
              AND starts_with(path, p)) AS rule,
           coalesce((SELECT arg_max(action, length(h || p)) FROM r
              WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)), 'allow') AS verdict
    FROM u
    """,
)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages", "page_id", "url")
    judged = url_rules.judge(pages, url_rules.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query(
    "op10_top_k",
    """
    WITH v AS MATERIALIZED (
               SELECT row_number() OVER () AS r, vec_id,
                      list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
               FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.r AS q, q.vec_id AS query_id, c.r AS c, c.vec_id,
                 CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0)
    SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM
      (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id, c) AS rank FROM s)
    WHERE rank <= 5
    """,
)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    vectors = topk.integer_vectors(
        table(spark, sf, "embeddings", "vec_id", "embedding"), "vec_id", "embedding", 256
    )
    return topk.top_k(vectors, F.pmod("vec_id", F.lit(50)) == 0, k=5)


NEGATIVES_SQL = """
    WITH v AS MATERIALIZED (
      SELECT row_number() OVER () AS r, vec_id,
             CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
       AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS MATERIALIZED (
      SELECT a.r AS a, a.vec_id AS anchor_id, c.r AS c, c.vec_id, a.label = c.label AS same,
             CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v a JOIN v c ON a.r <> c.r WHERE a.vec_id % 50 = 0),
    p AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, c) AS place FROM s WHERE same),
    n AS (SELECT p.a, p.place, p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id,
                 p.score AS positive_score, s.score AS negative_score,
                 row_number() OVER (PARTITION BY p.a, p.place ORDER BY s.score DESC, s.vec_id, s.c) AS rank
          FROM p JOIN s ON p.a = s.a AND NOT s.same AND p.place <= 5
           AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
    SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score
    FROM n WHERE rank <= 3
"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings", "vec_id", "embedding", "label")
    label = F.col("label").cast("long")
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, (label + 1) % 10).otherwise(label)
    vectors = hard_negatives.labelled_vectors(rows, "vec_id", "embedding", moved, 256)
    return hard_negatives.mine(vectors, F.pmod("vec_id", F.lit(50)) == 0, positives=5, negatives=3, low=50, high=95)


def _windows_sql() -> str:
    """Words of both tables in order, and the texts' windows of every length that an item's windows have."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def words(of: str, key: str) -> str:
        return f"""
      SELECT r, {key}, unnest(w) AS w, generate_subscripts(w, 1) AS pos, len(w) AS n FROM
        (SELECT row_number() OVER () AS r, {key},
                regexp_extract_all(translate(text, '{upper}', '{lower}'), '{word}') AS w FROM {of})"""

    lead = ", ".join(f"lead(w, {i}) OVER o" for i in range(1, 10))

    return f"""
    WITH b AS ({words("benchmark", "item_id")}),
    d AS MATERIALIZED ({words("documents", "doc_id")}),
    bw AS (SELECT r, item_id, pos, n, [w, {lead}] AS ten FROM b WINDOW o AS (PARTITION BY r ORDER BY pos)),
    pat AS MATERIALIZED (
      SELECT DISTINCT item_id, CAST(least(n, 10) AS INT) AS k, array_to_string(ten[1:least(n, 10)], ' ') AS win
      FROM bw WHERE pos <= n - least(n, 10) + 1),
    dw AS (SELECT r, pos, n, [w, {lead}] AS ten FROM d WINDOW o AS (PARTITION BY r ORDER BY pos)),
    hit AS MATERIALIZED (
      SELECT DISTINCT dw.r, dw.pos, pat.k, pat.item_id
      FROM dw JOIN (SELECT DISTINCT k FROM pat) ks ON dw.pos <= dw.n - ks.k + 1
      JOIN pat ON pat.k = ks.k AND pat.win = array_to_string(dw.ten[1:ks.k], ' ')),
    covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM
                (SELECT r, unnest(generate_series(pos, pos + k - 1)) AS p FROM hit) GROUP BY r),
    items AS (SELECT r, count(DISTINCT item_id) AS n_items,
                     string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY r),
    docs AS (SELECT row_number() OVER () AS r, doc_id,
                    coalesce(len(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{word}')), 0) AS n_words
             FROM documents)
    SELECT doc_id, n_words::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
           coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
    """


@query("op12_decontamination", _windows_sql())
def op12(spark: SparkSession, sf: str) -> DataFrame:
    patterns = decontam.patterns_of(table(spark, sf, "benchmark", "item_id", "text"))
    found = decontam.search(table(spark, sf, "documents", "doc_id", "text"), patterns)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    ids = F.array_join(F.sort_array(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def _rounds_sql(rounds: int = 10, k: int = 8) -> str:
    """The rounds one after the other, centroids as lists."""
    assign = """
      SELECT r, vec_id, e, cluster, c, distance FROM (
        SELECT v.r, v.vec_id, v.e, c.cluster, c.c, d.distance,
               row_number() OVER (PARTITION BY v.r ORDER BY d.distance, c.cluster) AS nearest
        FROM v, {of} c, LATERAL (SELECT CAST(list_sum(list_transform(list_zip(v.e, c.c),
               lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS distance) d) WHERE nearest = 1"""
    move = """
      SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
        SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n FROM
          (SELECT cluster, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM {of}) GROUP BY cluster, i) GROUP BY cluster
      UNION ALL SELECT cluster, c FROM {old} o WHERE cluster NOT IN (SELECT cluster FROM {of})"""
    steps = []
    for i in range(rounds):
        steps.append(f"a{i} AS MATERIALIZED ({assign.format(of=f'c{i}')})")
        steps.append(f"c{i + 1} AS MATERIALIZED ({move.format(of=f'a{i}', old=f'c{i}')})")
    return f"""
    WITH v AS MATERIALIZED (
      SELECT row_number() OVER () AS r, vec_id,
             list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
      FROM embeddings WHERE len(embedding) = 64
       AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    c0 AS MATERIALIZED (
      SELECT CAST(row_number() OVER (ORDER BY h, e) - 1 AS INT) AS cluster, e AS c
      FROM (SELECT sha256('3:' || vec_id) AS h, e FROM v WHERE vec_id IS NOT NULL ORDER BY h, e LIMIT {k})),
    {", ".join(steps)},
    z AS MATERIALIZED ({assign.format(of=f'c{rounds}')})
    SELECT vec_id, cluster, distance,
           CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
           CAST(sum(distance) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM z
    """


@query("op13_centroids", _rounds_sql())
def op13(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings", "vec_id", "embedding")
    vectors = centroids.integer_vectors(rows, "vec_id", "embedding", scale=1024, size=64)
    return centroids.cluster(vectors, k=8, rounds=10, seed=3)
