"""Decontamination against comparing every window with every place."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from prosemill.llm import decontam as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def direct(docs, items):
    windows = []
    for i, text in items:
        w = words(text)
        k = min(len(w), 10)
        windows += [(i, tuple(w[a : a + k])) for a in range(len(w) - k + 1) if k]
    out = []
    for d, text in docs:
        w = words(text)
        hit, found = set(), set()
        for i, win in set(windows):
            for a in range(len(w) - len(win) + 1):
                if tuple(w[a : a + len(win)]) == win:
                    hit |= set(range(a, a + len(win)))
                    found |= {i} - {None}
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def searched(spark, docs, items, **kind):
    bench = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, window string")
    rows = spark.createDataFrame(
        [(d, t, "c", "c", "c") for d, t in docs], "doc_id long, text string, spans string, items string, row string"
    ).repartition(3)
    got = dc.search(rows, dc.patterns_of(bench), **kind).collect()
    out = []
    for r in got:
        spans = [(s.start, s.end) for s in r.spans]
        assert spans == sorted(spans) and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
        out.append((r.doc_id, r.n_words, sum(b - a for a, b in spans), list(r["items"])))
    return sorted(out, key=str)


def corpus(seed, vocabulary=("a", "of", "Der", "straße", "x1", "the", "año", "token", "日本", "wort")):
    rng = random.Random(seed)
    say = lambda n: rng.choice([" ", ", ", "--", " \x00 "]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, say(rng.choice([3, 9, 10, 11, 25]))) for i in range(12)]
    docs = []
    for d in range(60):
        parts = [say(rng.randrange(30))]
        for _ in range(rng.randrange(3)):
            w = words(rng.choice(items)[1])
            a = rng.randrange(len(w))
            parts += [rng.choice([" ", "!\n"]).join(w[a:]).upper(), say(rng.randrange(8))]
        docs.append((d, " ".join(parts)))
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 700])
def test_against_every_place(shared, block_bytes):
    docs, items = corpus(1)
    docs += [(100, None), (101, ""), (102, "., !"), (7, docs[7][1]), (None, items[0][1]), (103, items[1][1]),
             (104, (items[2][1] + " ") * 50)]
    items += [(20, None), (21, ""), (22, ".."), (None, "null id here"), (3, "third item again"), (23, "One"),
              (24, items[4][1]), (25, " ".join(["again"] * 14))]
    docs += [(105, "so null ID-here is"), (106, "it is ONE or oneone"), (107, "again " * 30), (108, "third item again" * 2)]
    got = searched(shared, docs, items, block_bytes=block_bytes)
    assert got == direct(docs, items)


def test_no_benchmark_and_no_documents(shared):
    assert searched(shared, [(1, "a b c"), (2, None)], []) == [(1, 3, 0, []), (2, 0, 0, [])]
    assert searched(shared, [], [(1, "a b c")]) == []
    assert searched(shared, [(1, "a")], [(1, None), (2, "?")]) == [(1, 1, 0, [])]


def test_long_text_and_long_words(shared):
    rng = random.Random(2)
    long = " ".join(str(rng.randrange(500)) for _ in range(300_000))
    w = long.split()
    items = [(1, " ".join(w[-10:])), (2, " ".join(w[150_000:150_030])), (3, "x" * 70_000 + " y"), (4, " ".join(w[:10]))]
    docs = [(1, long), (2, "a " + "x" * 70_000 + "\ty b"), (3, "x" * 70_001 + " y")]
    got = searched(shared, docs, items)
    assert got == [(1, 300_000, 50, [1, 2, 4]), (2, 4, 2, [3]), (3, 2, 0, [])]


def test_jumps(rng=np.random.default_rng(3)):
    """Most positions of a text without hits are never looked at."""
    text = " " + " ".join("".join(map(chr, rng.integers(97, 123, 6))) for _ in range(20_000)) + " "
    own = [" " + " ".join(text.split()[i : i + 10]) + " " for i in (5, 17_000)]
    searcher = dc.Searcher([p.encode() for p in own], 10, np.arange(2))
    looks = []
    slot = searcher._slot
    searcher._slot = lambda b: looks.append(len(b)) or slot(b)
    data = np.frombuffer(text.encode() + b"\0" * 8, np.uint8)
    assert searcher.places(data).tolist() == [text.index(p) for p in own]
    assert sum(looks) < len(text) / 20


def test_template_of_many_items(shared):
    """A window of many items is spread over the blocks; the answer names them all."""
    head = "which of the following is the right answer to this question"
    items = [(i, f"{head} {i}") for i in range(300)]
    docs = [(1, head.upper() + "?"), (2, f"so {head} 7"), (3, "which of the")]
    got = searched(shared, docs, items, block_bytes=5000)
    assert got == direct(docs, items)
