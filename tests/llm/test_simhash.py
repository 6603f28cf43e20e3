"""SimHash groups against all pairs, and the sorting of hot buckets."""

import random
import re

import numpy as np
import pytest
import xxhash

from prosemill.llm import simhash
from prosemill.llm.graph import components


def direct_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def direct_groups(prints, distance=4):
    """{position: positions' smallest} by comparing all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def near_rows(seed=1):
    rng = random.Random(seed)
    rows, d = [], 0
    for _ in range(12):
        words = [f"w{rng.randint(0, 500)}" for _ in range(rng.randint(3, 150))]
        for _ in range(rng.randint(1, 5)):
            copy = list(words)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = f"w{rng.randint(0, 500)}"
            rows.append((d * 7 % 101, " ".join(copy)))
            d += 1
    return rows


def check(rows, df):
    prints = [direct_print(t) for _, t in rows]
    groups = direct_groups(prints)
    smallest = {}
    for (d, _), g in zip(rows, groups):
        if d is not None:
            smallest[g] = min(smallest.get(g, d), d)
    want = sorted(((d, p, smallest.get(g)) for (d, _), p, g in zip(rows, prints, groups)), key=str)
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in df.collect()), key=str)
    assert got == want


def test_against_all_pairs(documents):
    rows = near_rows() + [(200, None), (201, ""), (202, " \n"), (203, "ONE two"), (204, "one TWO"),
                          (204, "one TWO"), (None, "one two"), (205, "É é " * 30), (206, "a " * 40_000)]
    check(rows, simhash.near_duplicates(documents(rows, clash=("fp", "rep", "label"))))


def test_distance_zero_has_its_row(documents):
    rows = [(3, None), (1, "a b c d e f")]
    check(rows, simhash.near_duplicates(documents(rows)))


@pytest.mark.parametrize("block", [4, 8192])
def test_links_connect_what_pairs_connect(shared, block):
    rng = random.Random(7)
    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = set(centres)
    for c in centres[:2]:
        for _ in range(60):  # a dense group: one bucket holds nearly all of it
            x = c
            for b in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << b
            prints.add(x)
    prints |= {rng.getrandbits(64) for _ in range(100)}
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    nodes = shared.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    found = simhash.links(nodes, block=block)
    pairs = [(r.a, r.b) for r in found.collect()]
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= 4 for a, b in pairs)
    label = {r.node: r.label for r in components(found, "a", "b").collect()}
    groups = direct_groups(prints)
    by_group, by_label = {}, {}
    for x, g in zip(signed, groups):
        by_group.setdefault(g, set()).add(x)
        by_label.setdefault(label.get(x, x), set()).add(x)
    assert sorted(map(sorted, by_group.values())) == sorted(map(sorted, by_label.values()))


def test_too_great_a_distance_is_refused(shared):
    with pytest.raises(ValueError):
        simhash.links(shared.createDataFrame([(1,)], "fp long"), distance=6)


def test_components_of_a_long_path(shared):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (101, 102), (7, 7)]
    df = shared.createDataFrame([(a, b) if a % 2 else (b, a) for a, b in edges], "u long, v long")
    got = {r.node: r.label for r in components(df, "u", "v").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_one_row_of_each_group_stays(documents):
    rows = near_rows(4) + [(300, "same words here now"), (300, "same words here now"), (None, "same words here now"),
                           (301, None), (302, "")]
    docs = documents(rows)
    kept = simhash.distinct_documents(docs)
    assert kept.columns == docs.columns
    prints = [direct_print(t) for _, t in rows]
    groups = direct_groups(prints)
    best = {}
    for (d, _), g in zip(rows, groups):
        if d is not None:
            best[g] = min(best.get(g, d), d)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(best.values())


def test_empty_table(documents):
    none = documents([(1, "a")]).limit(0)
    assert simhash.near_duplicates(none).count() == 0 and simhash.distinct_documents(none).count() == 0
