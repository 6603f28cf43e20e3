"""The pipeline's stages in their order, and the registered queries next to their SQL."""

import pytest

import corpus_pipeline
from prosemill.llm.queries import ORACLES, QUERIES
from tools.check_oracle import compare, connect

SMALL = "/root/testdata/sf0.001"


def test_stages(shared):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "personal_data", "source_mix", "sequences"
    ]
    docs = shared.read.parquet(f"{SMALL}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        from prosemill.llm.common import stored

        docs = stored(stage(shared, docs, SMALL), f"test-{name}")
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids and now
        ids = now
        if name != "sequences":
            assert docs.columns == columns
    assert {"sequence_id", "offset", "length"} <= set(docs.columns)


def test_stages_take_odd_rows(documents):
    rows = [(1, None, None, None), (2, "", None, None), (3, "the thing and the other thing of them", "en", None),
            (3, "the thing and the other thing of them", "en", None), (None, "der die das und nicht", "de", "a"),
            (4, "call +1 (017) 555-7713 or the man", "en", "a"), (5, "12 34", "en", "b")]
    docs = documents(rows)
    spark = docs.sparkSession
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = docs.collect()
    assert all("555" not in r.text for r in got)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == len(got)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(shared, name):
    got = QUERIES[name](shared, SMALL).toPandas()
    assert compare(got, connect(SMALL).execute(ORACLES[name]).df()).startswith("ok")


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
