"""Word tables against the contract's regular expression."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prosemill.llm.common import Rolling, slices, word_count, word_hashes, word_spans

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXT = st.lists(
    st.one_of(st.none(), st.text(alphabet="ab é\x0b\x1c \U0001f600\t\n\r -", max_size=40)), max_size=12
)


@given(TEXT, st.integers(1, 60))
@settings(max_examples=150, deadline=None)
def test_spans_are_the_words(texts, most):
    got = []
    for lo, hi, data, cuts in slices(pa.array(texts, pa.string()), most):
        starts, ends, first = word_spans(data, cuts)
        whole = data.tobytes()
        for i in range(hi - lo):
            a, b = first[i], first[i + 1]
            got.append([whole[s:e].decode() for s, e in zip(starts[a:b], ends[a:b])])
    assert got == [WORD.findall(t or "") for t in texts]


@given(st.lists(st.text(alphabet="abé", min_size=1, max_size=400), min_size=1, max_size=30))
@settings(max_examples=100, deadline=None)
def test_equal_hashes_are_equal_words(words):
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    hashes = word_hashes(data, starts, ends).tolist()
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert (hashes[i] == hashes[j]) == (a == b)
    runs = Rolling(np.array(hashes, np.uint64))
    at = np.arange(len(words) - 1)
    pairs = runs.runs(at, at + 2).tolist()
    for i in at:
        for j in at:
            assert (pairs[i] == pairs[j]) == (words[i : i + 2] == words[j : j + 2])


def test_word_count(shared):
    texts = ["", None, " \t\n", "a", " a  b\r\nc ", "x y z", "é\x0bß"]
    df = shared.createDataFrame([(t,) for t in texts], "t string")
    got = [r.n for r in df.select(word_count(F.col("t")).alias("n")).collect()]
    assert got == [len(WORD.findall(t or "")) for t in texts]
