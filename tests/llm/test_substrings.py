"""Repeated passages against a direct search of every window."""

import hashlib
import random
import re

import numpy as np
import pytest

from prosemill.llm.substrings import DIFFERENCE_SETS, cover, repeated_passages


def direct(rows, length):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in words:
        if d is not None:
            for i in range(len(w) - length + 1):
                key = tuple(w[i : i + length])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if d is not None and first[tuple(w[i : i + length])] < d:
                gone[i : i + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("period", DIFFERENCE_SETS)
def test_every_shift_has_a_common_cover_position(period):
    places = DIFFERENCE_SETS[period]
    assert {(a - b) % period for a in places for b in places} == set(range(period))


@pytest.mark.parametrize("length", [1, 2, 5, 13, 50, 200])
def test_anchors_fit_into_windows(length):
    period, flags = cover(length)
    assert len(flags) == period and length - period + 1 >= 1


def test_against_direct_search(documents):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(48, 130))] for _ in range(6)]
    rows = []
    for d in range(60):
        words = []
        for _ in range(rng.randint(0, 4)):
            if rng.random() < 0.5:
                p = rng.choice(passages)
                a = rng.randint(0, 12)
                words += p[a : len(p) - rng.randint(0, 12)]
            else:
                words += [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        rows.append((d * 3 % 61, rng.choice([" ", "\n", "  "]).join(words)))
    rows += [(100, rows[5][1]), (101, rows[5][1]), (7, rows[9][1]), (7, rows[9][1])]  # copies, a repeated id
    rows += [(102, None), (103, ""), (104, " \t"), (None, rows[5][1]), (105, "x " * 3000), (106, "x " * 120)]
    assert got(repeated_passages(documents(rows, clash=("cid", "sha", "h")))) == direct(rows, 50)


def test_short_windows(documents):
    rng = random.Random(5)
    rows = [(d, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 40)))) for d in range(40)]
    assert got(repeated_passages(documents(rows), length=8)) == direct(rows, 8)


def test_spans_tell_what_is_removed(documents):
    text = " ".join(f"a{i}" for i in range(80))
    rows = [(1, text), (2, "x y " + text + " z"), (3, "q " * 60)]
    df = {r.doc_id: r for r in repeated_passages(documents(rows)).collect()}
    assert [(s.first, s.words) for s in df[2].removed] == [(2, 80)] and df[3].removed == []


def test_empty_table(documents):
    assert repeated_passages(documents([(1, "a")]).limit(0)).count() == 0


def test_one_passage_in_most_documents(documents):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(d, f"u{d} " + passage + f" v{d}") for d in range(300)]
    df = got(repeated_passages(documents(rows)))
    assert df == direct(rows, 50) and np.sum([r[2] for r in df]) == 60 * 299
