"""Surface counts against plain Python, and the likelihood ratio against a direct sum."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from prosemill.llm import quality
from prosemill.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
ROWS = [
    (1, "a b c a b c a b c d"), (2, "x\n\nx\n x\nx y\n\n"), (3, None), (4, ""), (5, " \t\n"),
    (6, "# * $ % & | < > #é##"), (7, "the cat " * 60), (8, " ".join(f"w{i}" for i in range(49))),
    (9, " ".join(f"w{i}" for i in range(50))), (9, " ".join(f"w{i}" for i in range(50))), (None, "a b"),
    (10, "äöü ß\x0bnaïve\x0cx"), (11, "one two"), (12, " ".join(f"v{i % 700}" for i in range(40_000))),
]


def surface(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, lines = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), lines, len(covered)


def test_counts(shared, documents):
    trusted = shared.createDataFrame([(9,)], "trusted_id long")
    docs = documents(ROWS, clash=("__yes", "trusted_id", "trusted", "score", "bucket"))
    got = sorted(
        ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
         for r in quality.assess(docs, trusted).collect()), key=str)
    want = []
    for d, t in ROWS:
        n, chars, symbols, lines, repeats = surface(t)
        want.append((d, n, chars, symbols, lines, repeats, n < 50 or 100 * repeats > 50 * n))
    assert got == sorted(want, key=str)


def test_score_is_the_mean_log_ratio(shared, documents):
    rng = random.Random(2)
    rows = [(d, " ".join(rng.choice("abcdefgh" if d % 2 else "efghijkl") for _ in range(60))) for d in range(20)]
    good = {1, 3, 5}
    buckets = 1 << 20
    docs = documents(rows)
    got = {r.doc_id: r.score for r in quality.assess(docs, shared.createDataFrame([(g,) for g in good], "trusted_id long"), buckets=buckets).collect()}

    def grams(t):
        w = t.split()
        return [(x,) for x in w] + list(zip(w, w[1:]))

    def counted(use):
        return collections.Counter(g for d, t in rows if use(d) for g in grams(t))

    for d, t in rows:  # some 150 n-grams share no bucket here
        raw, target = counted(lambda x: x != d), counted(lambda x: x != d and x in good)
        total, aim = sum(raw.values()), sum(target.values())
        want = sum(math.log((target[g] + 20) / (aim * raw[g] / total + 20)) for g in grams(t))
        assert abs(got[d] - want / len(grams(t))) < 1e-5


def test_no_trusted_texts_and_no_rows(shared, documents):
    none = shared.createDataFrame([], "trusted_id long")
    docs = documents([(1, "w " * 5 + " ".join(f"x{i}" for i in range(60)))])
    row = quality.assess(docs, none).collect()[0]
    assert row.score == 0 and row.kept
    assert quality.assess(docs.limit(0), none).count() == 0


def test_trusted_ids_are_bounded_and_fixed(shared):
    labels = shared.createDataFrame([(i, int(i % 3 > 0)) for i in range(100)] + [(None, 1), (4, 1)], "doc_id long, quality int")
    a = [r[0] for r in quality.trusted_ids(labels, 10).collect()]
    b = [r[0] for r in quality.trusted_ids(labels.repartition(5), 10).collect()]
    assert sorted(a) == sorted(b) and len(set(a)) == 10 and all(x % 3 for x in a)


def test_verdicts_agree_with_labels(shared):
    got = {r.doc_id: r for r in QUERIES["op5_quality"](shared, SMALL).collect()}
    labels = shared.read.parquet(f"{SMALL}/labels.parquet").collect()
    judged = [(r.quality, got[r.doc_id].kept) for r in labels if not got[r.doc_id].base_failed]
    assert np.mean([bool(q) == k for q, k in judged]) >= 0.95


def test_threshold_follows_the_trusted_scores(shared, documents):
    rows = [(d, "x", 0.0 if d < 5 else 0.1 * d, False) for d in range(101)] + [(200, "x", -9.0, True), (None, "x", -9.0, False)]
    measured = shared.createDataFrame([(r[0], r[2], r[3]) for r in rows], "doc_id long, score double, base_failed boolean")
    ids = lambda found: shared.createDataFrame([(i,) for i in found], "trusted_id long")
    assert quality.threshold_of(measured, ids([*range(101), 200])) == pytest.approx(2 * 0.5 - 5.0)
    assert quality.threshold_of(measured, ids([200, 999])) == float("-inf")
    half = quality.threshold_of(measured, ids(range(0, 101, 2)))
    assert half == pytest.approx(2 * 0.5 - 5.0, abs=0.5)  # half the trusted texts, nearly the same


def test_every_trusted_row_is_used(shared):
    labels = shared.range(25_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    assert quality.trusted_ids(labels).count() == 25_000


@pytest.mark.parametrize("n", [1, 2, 20, 21, 1000])
def test_quantiles_are_those_of_percentile(shared, n):
    scores = shared.range(n).select(F.round(F.pmod(F.xxhash64("id"), F.lit(997)) / 100 - 4, 9).alias("score"))
    want = scores.agg(F.percentile("score", F.array(F.lit(0.05), F.lit(0.5))).alias("p")).first().p
    assert [quality._quantile(scores, n, q) for q in (0.05, 0.5)] == pytest.approx(want, abs=1e-9)
