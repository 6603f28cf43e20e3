"""Targets, tilted rates and copies."""

import random

import numpy as np
import pytest

from prosemill.llm import mixing


def water(sizes, weights=(5, 2, 1), most=3):
    """Targets by repeated sharing; sizes in the order of the sources."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    total, fixed = sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        if not free:
            break
        level = (total - sum(fixed.values())) / sum(w[i] for i in free)
        over = [i for i in free if w[i] * level > most * sizes[i]]
        if not over:
            return [fixed.get(i, w[i] * level) for i in range(len(sizes))]
        fixed |= {i: most * sizes[i] for i in over}
    return [fixed[i] for i in range(len(sizes))]


def rows_for(rng, spec):
    rows, d = [], 0
    for source, docs, most in spec:
        for _ in range(docs):
            rows.append((d, "w " * rng.randint(0, most), "en", source))
            d += 1
    rng.shuffle(rows)
    return rows


def totals(rows):
    size = {}
    for r in rows:
        size[r[3]] = size.get(r[3], 0) + len((r[1] or "").split())
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    return order, [size[s] for s in order]


def test_targets_and_copies(documents):
    rng = random.Random(1)
    rows = rows_for(rng, [("b", 200, 60), ("a", 9, 40), ("é", 120, 300), (None, 50, 80), ("Z", 150, 20), ("zz", 3, 0)])
    rows += [(1000, None, "en", "b"), (1001, "", "en", "b"), (1002, "long " * 5000, "en", "é"), (1003, "x y", "en", "a"),
             (1003, "x y", "en", "a"), (None, "x y z", "en", "a")]
    docs = documents(rows, clash=("size", "m", "target", "copies"))
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    order, sizes = totals(rows)
    want = dict(zip(order, water(sizes)))
    taken, longest = {}, {}
    for r in got:
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert r.source_size == sizes[order.index(r.source)]
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.taken
        longest[r.source] = max(longest.get(r.source, 0), r.size)
    for s in order:
        assert taken[s] <= want[s] + 1e-6
        may = [r.size for r in got if r.source == s and r.size and r.copies < 3 and r.doc_id != 1003]
        assert want[s] - taken[s] < min(may, default=longest[s] + 1)
        if len([r for r in got if r.source == s]) >= 100:
            assert abs(taken[s] - want[s]) <= 0.02 * want[s]
    again = {(r.doc_id, r.size): r.copies for r in mixing.mix(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.size): r.copies for r in got}


def test_rates_are_tilted_by_size(shared):
    rng = random.Random(2)
    sizes = [rng.randint(1, 100) for _ in range(400)]
    counts = shared.createDataFrame([("a", s, sizes.count(s)) for s in sorted(set(sizes))], "source string, size long, n long")
    for target in (0.3 * sum(sizes), 1.0 * sum(sizes), 2.5 * sum(sizes)):
        goal = shared.createDataFrame([("a", sum(sizes), target)], "source string, source_size long, target double")
        m = mixing.tilts(counts, goal).first().m
        rates = np.minimum(3, np.exp(m * np.array(sizes)))
        assert abs((rates * sizes).sum() - target) <= 1e-5 * target


def test_short_documents_beside_a_very_long_one(shared):
    sizes = np.repeat([200, 300_000], [5000, 1])
    sources = {"a": 0.4, "b": 2.4, "c": 2.8, "d": 0.0, "e": 1e-6, "f": 2.99999, "g": 3.0}
    whole = int(sizes.sum())
    counts = shared.createDataFrame(
        [(s, size, n) for s in sources for size, n in ((200, 5000), (300_000, 1))], "source string, size long, n long"
    )
    goal = shared.createDataFrame(
        [(s, whole, x * whole) for s, x in sources.items()], "source string, source_size long, target double"
    )
    for r in mixing.tilts(counts, goal).collect():
        met = (np.minimum(3, np.exp(np.minimum(r.m * sizes, 50))) * sizes).sum()
        assert abs(met - r.target) <= 1e-5 * r.target, (r.source, met / whole)


def test_copies_of_short_documents_beside_a_very_long_one(documents):
    asked = {"a": 2.4, "b": 2.8, "c": 0.4, "d": 1.0}  # weights; one unit is 13,000 words
    rows = [(d, "w w" if d else "w " * 3000, "en", s) for s in "abc" for d in range(5001)]
    rows += [(d, "w " * 100, "en", "d") for d in range(468)]
    got = mixing.mix(documents(rows), weights=tuple(asked.values())).collect()
    for s, weight in asked.items():
        target, taken = weight * 13_000, sum(r.taken for r in got if r.source == s)
        assert 0.99 * target <= taken <= target, (s, taken / target)


def test_a_source_that_does_not_settle_is_an_error(shared, monkeypatch):
    monkeypatch.setattr(mixing, "STEPS", 2)
    counts = shared.createDataFrame([("a", 200, 5000), ("a", 300_000, 1)], "source string, size long, n long")
    goal = shared.createDataFrame([("a", 1_300_000, 3_120_000.0)], "source string, source_size long, target double")
    with pytest.raises(RuntimeError, match="1 sources"):
        mixing.tilts(counts, goal)


def test_one_source_and_nothing(documents):
    rows = [(i, "a b c", "en", "s") for i in range(10)]
    got = mixing.mix(documents(rows)).collect()
    assert all(r.copies == 1 and r.target == 30 for r in got)
    assert mixing.mix(documents(rows).limit(0)).count() == 0
    empty = mixing.mix(documents([(1, None), (2, "")])).collect()
    assert [(r.size, r.target, r.taken) for r in empty] == [(0, 0.0, 0)] * 2


def test_mixed_rows(documents):
    rows = rows_for(random.Random(3), [("a", 40, 30), ("b", 60, 30), (None, 50, 40)])
    docs = documents(rows, clash=("cuts", "_size"))
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    seen = {}
    for r in out.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {d: c for d, c in copies.items() if c}


def test_small_sources_come_near_their_targets(documents):
    """What is left open is less than any document that may still be taken."""
    rng = random.Random(9)
    rows = rows_for(rng, [(f"s{i:02d}", rng.randint(1, 9), rng.choice([20, 400])) for i in range(30)] + [("t", 300, 40)])
    got = mixing.mix(documents(rows)).collect()
    per = {}
    for r in got:
        per.setdefault(r.source, []).append(r)
    for s, docs in per.items():
        left = docs[0].target - sum(r.taken for r in docs)
        may = [r.size for r in docs if r.size and r.copies < 3]
        assert -1e-6 <= left < min(may, default=1e9), s
        assert all(0 <= r.copies <= 3 for r in docs)


def test_one_size_held_by_many(documents, monkeypatch):
    """Copies go round documents of one size; ranks of a common size are found in parts."""
    monkeypatch.setattr(mixing, "TASK_ROWS", 50)
    rows = [(d, "w w w", "en", "a") for d in range(1000)] + [(2000, "w " * 500, "en", "a"), (2001, "v " * 900, "en", "b")]
    rows += [(3000 + d, "w " * 7, "en", "c") for d in range(500)]
    got = mixing.mix(documents(rows), weights=(2.4, 1.0, 1.6)).collect()
    for s in "abc":
        docs = [r for r in got if r.source == s]
        left = docs[0].target - sum(r.taken for r in docs)
        assert 0 <= left < min([r.size for r in docs if r.copies < 3], default=1e9)
        equal = [r.copies for r in docs if r.size in (3, 7)]
        assert not equal or max(equal) - min(equal) <= 1
