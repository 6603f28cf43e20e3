import json
import random

import pytest
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from prosemill import dims
from prosemill.operators import evaluate
from prosemill.operators.sentiment import lexicon_table
from prosemill.plans import descriptions, news, notes, reviews
from prosemill.sources import files
from prosemill.streaming.files import stream_reviews, write_reviews

GOOD, BAD = "great love perfect nice excellent".split(), "bad broken waste terrible poor".split()


def review_rows(n=240, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        good = i % 2 == 0
        words = [rng.choice(GOOD if good else BAD) for _ in range(6)] + [rng.choice(["tool", "box", "dog"])]
        rows.append({"reviewText": " ".join(words) + "!", "summary": "It is " + words[0],
                     "overall": (5.0 if good else 1.0) if i % 10 else 3.0, "asin": "x"})
    return rows


@pytest.fixture()
def review_files(tmp_path):
    folder = tmp_path / "reviews"
    folder.mkdir()
    rows = review_rows()
    for name, part in (("Pets_5", rows[:120]), ("Tools_5", rows[120:])):
        (folder / f"{name}.json").write_text("\n".join(json.dumps(r) for r in part))
    return folder


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('say "hi",\nthen', [1.5, 2.5]), ("b", [0.0, 1.0])], "t string, v array<double>")
    files.write_csv(df, str(tmp_path / "a"), "v", 2)
    back = files.read_csv(spark, str(tmp_path / "a"), "t string, w2v_emb_0 double, w2v_emb_1 double")
    assert sorted(map(tuple, back.collect())) == [("b", 0.0, 1.0), ('say "hi",\nthen', 1.5, 2.5)]


def test_indexed_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_text(',Cancer,Stroke\nVolume 1,3,4\n')
    row = files.read_csv_indexed(spark, str(tmp_path / "c.csv"), "volume", "Cancer int, Stroke int").first()
    assert tuple(row) == ("Volume 1", 3, 4)


def test_volumes_in_two_encodings(spark, tmp_path):
    (tmp_path / "A book_v1.txt").write_bytes("Stroke café\r\nstroke".encode())
    (tmp_path / "A book_v2.txt").write_bytes("Influenza and pneumonia, é".encode("latin-1"))
    got = {r.volume: r.text for r in files.read_volumes(spark, f"{tmp_path}/*.txt").collect()}
    assert got == {1: "Stroke café\nstroke", 2: "Influenza and pneumonia, é"}
    wide = descriptions.volume_counts(spark, f"{tmp_path}/*.txt").collect()
    assert [r["Stroke"] for r in wide] == [2, 0] and wide[1]["Influenza and Pneumonia"] == 2
    long = spark.createDataFrame([(1, "Cancer", 2)], "volume int, condition string, n int")
    files.write_counts_csv(long, str(tmp_path / "counts"))
    assert (tmp_path / "counts" / "volume=1").is_dir()


def test_volumes_in_archives(spark, tmp_path):
    texts = {1: "Stroke café\nstroke".encode(), 2: "é".encode("latin-1"), 3: b"", 4: b"x" * 512, 5: b"a\0\r\nb\0", 6: b"y" * 1023}
    df = spark.createDataFrame([(f"v{i}.txt", t) for i, t in texts.items()], "name string, content binary")
    files.write_text_archives(df.coalesce(1), str(tmp_path / "a"), 4)
    assert len(list((tmp_path / "a").glob("*.txt"))) == 2
    got = {r.volume: r.text for r in files.read_volumes(spark, str(tmp_path / "a"), archives=True).collect()}
    assert got == {1: "Stroke café\nstroke", 2: "é", 3: "", 4: "x" * 512, 5: "a\0\nb\0", 6: "y" * 1023}


def test_volumes_of_a_query_share_files(spark, tmp_path, monkeypatch):
    from catalog import tables

    rows = [(i, None if i == 7 else f"text {i} é", "fr" if i % 2 else "zh", "s", 9) for i in range(60)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(tables, "scratch_path", lambda _, name: str(tmp_path / name))
    got = {r.volume: r.text for r in tables.read_volumes(spark, str(tmp_path)).collect()}
    assert got == {r[0]: r[1] or "" for r in rows}
    assert len([p for p in (tmp_path / "volumes").rglob("*.txt")]) < 20


def test_descriptions(spark, tmp_path):
    (tmp_path / "d.csv").write_text('Description\n"Jane Doe: a nurse from Boston, CA"\n"Solo"\n')
    rows = descriptions.entity_table(spark, str(tmp_path / "d.csv")).orderBy("row").collect()
    assert [r["City"] for r in rows] == ["Boston", None]
    assert rows[0].asDict().keys() == {"row", *dims.ENTITY_COLUMNS}


def test_reviews_end_to_end(spark, review_files, tmp_path):
    paths = [str(review_files / f"{n}.json") for n in ("Pets_5", "Tools_5")]
    raw = files.read_jsonl_many(spark, paths).withColumn("id", F.xxhash64("*", F.monotonically_increasing_id()))
    assert {r.category for r in raw.select("category").distinct().collect()} == {"Pets", "Tools"}
    data = reviews.prepare_reviews(raw, "id", n_negative=100, positive_share=0.9).persist()
    counts = {r.rating: r["count"] for r in data.groupBy("rating").count().collect()}
    assert counts[0] == 100 and counts[1] == round(0.9 * 96)
    assert data.where("overall = 3 or length_review <> 7").count() == 0
    vectors = reviews.train_vectors(data, dim=8, epochs=2, steps=1)
    assert set(vectors) == {"cbow", "skipgram", "fasttext"}
    got = reviews.classify_reviews(
        data, "id", {k: vectors[k] for k in ("cbow", "skipgram")}, dim=8, components=4, rounds=3, depth=3
    ).persist()
    accuracy = {r.embedding: r.accuracy for r in evaluate.compare_models(got).collect()}
    assert set(accuracy) == {"cbow", "skipgram"} and max(accuracy.values()) > 0.7
    flipped = got.withColumn("prediction", 1 - F.col("prediction"))
    files.write_errors_csv(flipped, str(tmp_path / "errors"))
    assert (tmp_path / "errors" / "model=boosted_trees" / "embedding=cbow").is_dir()
    scores = reviews.score_sentiment(data, "id", lexicon_table(spark))
    by = {r.overall: r.m for r in scores.groupBy("overall").agg(F.avg("vader_polarity").alias("m")).collect()}
    assert by[5.0] > 0.5 and by[1.0] < -0.5


def test_news_end_to_end(spark):
    rng = random.Random(2)
    words = {"TECH": "phone chip robot", "SCIENCE": "atom robot chip", "SPORTS": "goal match team", "COLLEGE": "exam class campus"}
    rows = [(i, " ".join(rng.choices(words[c].split(), k=4)), "The " + rng.choice(words[c].split()), c)
            for i, c in enumerate(rng.choices(list(words), k=400))]
    rows[0] = (0, None, "robot", "TECH")
    df = spark.createDataFrame(rows, "id long, headline string, short_description string, category string")
    data = news.prepare_news(df, "id").persist()
    assert data.count() == 200
    assert {r.category for r in data.select("category").distinct().collect()} == {"TECHNOLOGY", "ENTERTAINMENT", "EDUCATION"}
    train, test, indexer = news.news_split(data, "id")
    which = ("logistic_regression", "random_forest")
    got = news.classify_news(train, test, "id", indexer, which, {"random_forest": {"trees": 10}})
    assert got.count() == 100
    report = {(r.model, r["class"]): r for r in news.news_reports(got, which).collect()}
    assert report["logistic_regression", "accuracy"].f1 > 0.9
    assert report["random_forest", "EDUCATION"].support > 0


def test_notes_end_to_end(spark):
    rng = random.Random(3)
    topics = ["fever cough throat cold", "chest pain heart arm", "knee ankle bone fall"]
    rows = [(i, " ".join(rng.choices(topics[i % 3].split(), k=12)) + f", can't wait {1000 + i}") for i in range(150)]
    df = spark.createDataFrame(rows, "id long, pn_history string")
    got = notes.cluster_notes(df, "id", "pn_history", components=3, k=3).persist()
    assert got.count() == 150 and got.where("outlier").count() == round(0.025 * 150)
    pure = got.groupBy("cluster").agg(F.count_distinct(F.col("id") % 3).alias("n")).collect()
    assert [r.n for r in pure] == [1, 1, 1]
    assert "cannot" in got.select("note").first().note


def test_models_are_saved(spark, tmp_path):
    df = spark.createDataFrame([(Vectors.dense([0.0]),), (Vectors.dense([9.0]),)], ["features"])
    model = KMeans(k=2, seed=1).fit(df)
    files.save_model(model, str(tmp_path / "km"))
    again = files.load_model(KMeansModel, str(tmp_path / "km"))
    assert [list(c) for c in again.clusterCenters()] == [list(c) for c in model.clusterCenters()]
    vectors = spark.createDataFrame([("a", [1.0])], "word string, vector array<double>")
    files.save_vectors(vectors, str(tmp_path / "v"))
    assert files.load_vectors(spark, str(tmp_path / "v")).collect() == vectors.collect()


def test_stream_equals_batch(spark, review_files, tmp_path):
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for _ in range(2):  # the second run finds nothing new
        write_reviews(stream_reviews(spark, str(review_files), 1), out, progress).awaitTermination(120)
    batch = reviews.label_reviews(spark.read.schema(files.REVIEWS).json(str(review_files)))
    streamed = spark.read.parquet(out)
    assert streamed.count() == batch.count()
    assert streamed.select(batch.columns).exceptAll(batch).count() == 0
