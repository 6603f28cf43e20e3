"""Token pieces against the JSON tokenizer, packing against a plain first fit."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from prosemill.llm import packing

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def json_ids():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


ENCODER = packing.Encoder(RANKS, PATTERN, known=50)


@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r\x1c\x85 　'sd.,1aé"), st.characters(codec="utf-8")), max_size=60))
@settings(max_examples=400, deadline=None)
def test_cut_text_has_the_ids_of_whole_text(text):
    ids = np.frombuffer(ENCODER(text), "<u4").tolist()
    assert ids == ENCODER.coder.encode_ordinary(text)


def test_ids_are_those_of_the_json_tokenizer(shared, json_ids):
    texts = [r[0] for r in shared.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for text in [*texts, "", " ", "a  b\n c's <|endoftext|> x", "  \n\n x"]:
        assert np.frombuffer(ENCODER(text), "<u4").tolist() == json_ids(text)


def plain_first_fit(sizes, room):
    left, out = [], [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        for b, r in enumerate(left):
            if r >= sizes[i]:
                break
        else:
            b = len(left)
            left.append(room)
        out[i] = (b, room - left[b])
        left[b] -= sizes[i]
    return out


@given(st.lists(st.integers(1, 64), max_size=80))
@settings(max_examples=200, deadline=None)
def test_tournament_tree_is_first_fit(sizes):
    bins, offsets = packing.first_fit_decreasing(np.array(sizes, np.int64), 64)
    assert list(zip(bins.tolist(), offsets.tolist())) == plain_first_fit(sizes, 64)


def test_pieces_and_sequences(documents, json_ids):
    rng = random.Random(1)
    rows = [(d, " ".join(rng.choice(["one", "zwei", "três", "12", "\n"]) for _ in range(rng.randint(0, 300)))) for d in range(80)]
    rows += [(100, None), (101, ""), (102, "word " * 20_000), (103, "same"), (103, "same"), (None, "no id"), (104, "x" * 9000)]
    docs = documents(rows, clash=("start", "row", "grp"))
    length = 256
    out = packing.pack(packing.token_pieces(docs, RANKS, PATTERN, length), length, group_size=40).collect()
    want = []
    for d, t in rows:
        ids = json_ids(t or "") + [1]
        for at in range(0, len(ids), length):
            cut = ids[at : at + length]
            want.append((d, at, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes()), len(ids)))
    got = [(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    filled = sum(r.length for r in out) / (length * len(sequences))
    assert filled > 0.9 and len(sequences) > len({r.sequence_id >> 32 for r in out}) > 1


def test_empty_table(documents):
    none = documents([(1, "a")]).limit(0)
    assert packing.pack(packing.token_pieces(none, RANKS, PATTERN)).count() == 0
