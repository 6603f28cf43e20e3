import pytest
from pyspark.sql import functions as F

from prosemill.functions.text import tokenize_ws
from prosemill.operators import evaluate as E
from prosemill.operators import sentiment as S
from prosemill.operators import spelling, terms


@pytest.fixture(scope="module")
def preds(spark):
    return spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1)], "rating int, prediction int")


def test_report(preds):
    r = {x["class"]: x for x in E.classification_report(preds, "rating", "prediction").collect()}
    assert (r["0"].precision, r["0"].recall, r["0"].support) == (1, 0.5, 2)
    assert r["0"].f1 == pytest.approx(2 / 3)
    assert (r["1"].recall, r["1"].f1) == (1, pytest.approx(0.8))
    assert r["1"].precision == pytest.approx(2 / 3)
    assert r["accuracy"].f1 == 0.75 and r["macro avg"].recall == 0.75
    assert E.accuracy(preds, "rating", "prediction").first().accuracy == 0.75
    m = preds.withColumn("model", F.lit("m")).withColumn("embedding", F.lit("e"))
    e = E.error_counts(m).first()
    assert (e.false_positives, e.false_negatives) == (1, 0)
    assert E.compare_models(m).first().best


def test_confusion_is_zero_filled(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "a")], "l string, p string")
    m = {(r.label, r.pred): r.n for r in E.confusion_matrix(df, "l", "p").collect()}
    assert len(m) == 9 and sum(m.values()) == 3 and m["c", "a"] == 1 and m["b", "b"] == 0


def test_elbow(spark):
    s = spark.createDataFrame([(4, 0.2), (5, 0.5), (6, 0.4)], "k int, silhouette double")
    r = {x.k: x for x in E.pick_elbow(s).collect()}
    assert r[5].rank == 1 and r[5].gain == pytest.approx(0.3) and r[4].gain is None


def test_sentiment(spark):
    lex = S.lexicon_table(spark)
    df = spark.createDataFrame([(1, "good good tool"), (2, "terrible"), (3, "tool"), (4, "")], "id int, t string")
    t = tokenize_ws(F.col("t"))
    v = {r.id: r for r in S.lexicon_valence(df, "id", t, lex).collect()}
    assert v[1].compound == pytest.approx(3.8 / (3.8**2 + 15) ** 0.5)
    assert v[1].pos == pytest.approx(5.8 / 6.8) and v[1].neg == 0
    assert v[1].pos + v[1].neu + v[1].neg == pytest.approx(1)
    assert v[2].compound < 0 and (v[3].compound, v[3].neu) == (0, 1) and v[4].neu == 0
    p = {r.id: r for r in S.lexicon_polarity(df, "id", t, lex).collect()}
    assert (p[1].polarity, p[1].subjectivity, p[3].polarity) == (0.7, 0.6, 0)
    rep = {r.id: r for r in S.valence_report(S.lexicon_valence(df, "id", t, lex), "id").collect()}
    assert rep[1].overall == "Positive" and rep[2].overall == "Negative" and rep[4].overall == "Neutral"


def test_valence_cuts(one):
    for x, want in ((0.05, "Positive"), (-0.05, "Negative"), (0.049, "Neutral")):
        assert one(S.valence_class(F.lit(x))) == want


def test_spelling(spark):
    words = ["the"] * 9 + ["cat"] * 6 + ["cart"] * 7 + ["teh", "caat", "cta", "xylophone", "ca", "th"]
    df = spark.createDataFrame([(1, " ".join(words)), (2, ""), (3, "teh cat")], "id int, t string")
    got = {r.id: r.tokens for r in spelling.correct_spelling(df, "id", tokenize_ws(F.col("t"))).collect()}
    assert got[1][-6:] == ["the", "cart", "cat", "xylophone", "cat", "the"]
    assert got[2] == [] and got[3] == ["the", "cat"]
    known = spark.createDataFrame([("teh", 1), ("cat", 5)], "word string, n long")
    own = {r.id: r.tokens for r in spelling.correct_spelling(df, "id", tokenize_ws(F.col("t")), dictionary=known).collect()}
    assert own[3] == ["teh", "cat"] and own[1][-6] == "teh"


def test_tfidf_by_hand(spark):
    df = spark.createDataFrame([(1, "aa bb"), (2, "aa aa"), (3, "x")], "id int, t string")
    two = df.where("id < 3")
    w = {(r.id, r.term): r.tfidf for r in terms.tfidf(two, "id", F.col("t"), [], 1, 1.0).collect()}
    assert w == {(1, "aa"): pytest.approx(0.579739, abs=1e-6), (1, "bb"): pytest.approx(0.814802, abs=1e-6),
                 (2, "aa"): 1.0}


def test_term_counts_and_sequences(spark):
    df = spark.createDataFrame([(1, "b a b"), (2, ""), (3, None)], "id int, t string")
    t = tokenize_ws(F.col("t"))
    tf = {(r.id, r.term): r.tf for r in terms.term_frequency(df, "id", t, keep_empty=True).collect()}
    assert tf == {(1, "a"): 1, (1, "b"): 2, (2, None): None, (3, None): None}
    index = spark.createDataFrame([("b", 7)], "word string, token_id int")
    seq = {r.id: r.seq for r in terms.to_sequence(df, "id", t, index).collect()}
    assert seq == {1: [7, 7], 2: [], 3: []}
    assert terms.sequence_length(spark.createDataFrame([(2,), (3,)], "n int"), F.col("n")) == 2


def test_long_words_meet_on_halves(spark):
    long = "abcdefghijklmnopqrstuvwxyzabcdef"
    swapped = long[:15] + long[16] + long[15] + long[17:]
    near = [long[1:], long[:-1], "x" + long, long[:16] + "_" + long[16:], long[:15] + long[16:], swapped, "y" + long[1:]]
    words = [*near, long[:24], long[:23] + "!", "z" * 20_000]
    rare = spark.createDataFrame([(w,) for w in words], "word string")
    known = spark.createDataFrame([(long, 9), (long[:25], 9), ("z" * 19_999, 9)], "word string, n long")
    got = {r.word: r.corrected for r in spelling.spelling_map(rare, known).collect()}
    assert got == {**{w: long for w in near}, long[:24]: long[:25], "z" * 20_000: "z" * 19_999}
