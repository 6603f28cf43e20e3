"""Language models: probabilities, held-out accuracy and odd rows."""

import numpy as np
import pandas as pd
import pyarrow as pa

from prosemill.llm.common import slices
from prosemill.llm.langid import Model, _counter, _FOLD, identified, identify, train, training_sample
from prosemill.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def model_of(texts, order=2):
    batch = pa.RecordBatch.from_arrays(
        [pa.array([x for x, _ in texts]), pa.array([t for _, t in texts])], names=["lang", "text"]
    )
    counts = pa.Table.from_batches(list(_counter(order)(iter([batch])))).to_pandas()
    return Model(counts.groupby(["lang", "n", "gram"], as_index=False)["count"].sum(), order), counts


def direct_bits(text, counts, lang, order):
    """Code length by walking from the longest context down, byte by byte."""
    rows = counts[counts["lang"] == lang]
    table = {(n, g): c for n, g, c in zip(rows["n"], rows["gram"], rows["count"])}
    data = _FOLD[np.frombuffer(text.encode(), np.uint8)].tolist()
    total = 0.0
    for i, byte in enumerate(data):
        for k in range(min(order, i), -1, -1):
            context = int.from_bytes(bytes(data[i - k : i]), "big")
            after = {g & 255: c for (n, g), c in table.items() if n == k + 1 and g >> 8 == context}
            if not after:
                continue
            weight = sum(after.values()) + len(after)
            if byte in after:
                total -= np.log2(after[byte] / weight)
                break
            total -= np.log2(len(after) / weight)
        else:
            total += 8.0
    return total


def test_code_lengths_are_those_of_the_context_tree():
    model, counts = model_of([("xx", "abab abc 12"), ("xx", "abba"), ("yy", "cacao éé")])
    texts = ["abab", "cab a", "", "zz é 3", "ABBA cacao"]
    got = np.concatenate([model.code_lengths(d, c) for _, _, d, c in slices(pa.array(texts), 7)])
    want = [[direct_bits(t, counts, x, 2) for x in model.languages] for t in texts]
    assert np.allclose(got, want, atol=1e-3)


def test_probabilities_of_a_context_leave_room_for_escape():
    model, counts = model_of([("xx", "the theory of the thing")], order=3)
    for n in range(4):
        known = counts[counts["n"] == n + 1]
        sums = known.groupby(known["gram"] // 256)["count"].agg(["sum", "count"])
        assert ((sums["sum"] / (sums["sum"] + sums["count"])) < 1).all()


def test_held_out_accuracy(shared):
    got = QUERIES["op2_language_id"](shared, SMALL).toPandas()
    truth = pd.read_parquet(f"{SMALL}/documents.parquet")[["doc_id", "lang"]]
    both = got.merge(truth, on="doc_id")
    held = both[both.held_out]
    assert len(both) == len(truth) and len(held) > 20
    assert (held.lang_pred == held.lang).mean() >= 0.97
    assert both.score.between(0, 1).all()


def test_odd_rows(documents):
    rows = [(1, "the thing of the then and there", "en"), (2, "le la les des une dans pour", "fr"),
            (3, None, "en"), (4, "", "fr"), (5, "12 345 --", None), (6, "the then", None),
            (6, "the then", None), (None, "les unes dans la", None), (7, "the " * 50_000, None)]
    docs = documents(rows, clash=("score", "letter", "lang_pred"))
    model = train(docs)
    got = {}
    for r in identify(docs, model).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, round(r.score, 3)))
    assert got[3] == got[4] == got[5] == [("und", 0.0)]
    assert len(got[6]) == 2 and got[6][0][0] == "en" and got[7][0][0] == "en"
    assert got[None][0][0] == "fr"
    kept = identified(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "6", "6", "7", "None"]


def test_one_long_text_does_not_fill_the_sample(documents):
    # 200 short texts and as many long ones in "en", long ones only in "fr"
    rows = [(d, f"short {d} " * 20, "en") for d in range(200)]
    rows += [(d, f"long {d} " * 20_000, "en") for d in range(200, 400)]
    rows += [(d, f"longue {d} é" * 20_000, "fr") for d in range(2)]
    sample = training_sample(documents(rows), "lang", "text", "doc_id", 16_000).collect()
    for lang, share in (("en", 1_000), ("fr", 8_000)):
        sizes = [len(r.text) for r in sample if r.lang == lang]
        assert max(sizes) <= share and 16_000 <= sum(sizes) < 16_000 + share


def test_ties_go_to_the_first_language(documents):
    docs = documents([(1, "same text", "bb"), (2, "same text", "aa"), (3, "same", None)])
    got = {r.doc_id: r for r in identify(docs, train(docs)).collect()}
    assert got[3].lang_pred == "aa" and abs(got[3].score - 0.5) < 1e-6


def test_no_labels_and_no_rows(documents):
    docs = documents([(1, "some text", None)])
    assert train(docs) is None
    assert identify(docs, None).collect()[0].lang_pred == "und" and identified(docs, None).count() == 0
    assert identify(docs.limit(0), None).count() == 0


def test_sample_of_very_many_short_texts(shared):
    """The window sees the sample and no whole bucket beside it; it is the same as a cut of all texts by hash."""
    from pyspark.sql import functions as F

    docs = shared.range(1_000_000).select(
        F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.concat(F.lit("some text "), F.col("id")).alias("text"))
    sample = training_sample(docs, "lang", "text", "doc_id", 2_000)
    got = sample.agg(F.sum(F.length("text")).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    assert 2_000 <= got.bytes < 2_000 + 500
    assert sample.select("text").distinct().count() == got.n
