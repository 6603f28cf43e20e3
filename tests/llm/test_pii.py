"""Base spans against the contract's patterns, voting and masking."""

import random
import re

import numpy as np
import pytest

from prosemill.llm import pii

PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base(text):
    found = []
    for k, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                k == 0
                or (k == 1 and all(int(p) <= 255 for p in m.group().split(".")))
                or (k == 2 and 12 <= len(digits) <= 19 and luhn(digits))
                or (k == 3 and 9 <= len(digits) <= 15)
            ):
                found.append((m.start(), k, pii.KINDS[k], m.end()))
    return sorted(found)


FIXED = [
    None, "", " ", "a@b.cd.e@f.g a@b.c_d@e.f", "a@b@c.de x@y -@-.- .@a..b", "é\U0001f600ß a.b+c@mail.example.com, z",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112 4111  1111",
    "+1 (017) 555-7713 +1 5 ++49 30 1234567- +1(((", "+12345678901234567890 +49.30.123456", "12@x.y 1.2.3.4@h.io",
    "user(at)host(dot)org or u [at] h.com", "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" x",
    "9" * 5000, "a" * 20_000 + "@", "1." * 5000, "a@" + "b." * 5000 + "c", "+" * 3000, "+1 " + "(" * 5000, "1.2.3.4 " * 600,
]


def texts():
    rng = random.Random(1)
    out = list(FIXED)
    for alphabet in ("a1.@ -", "0123456789 -.+()", "ab@.é_%\U0001f600", "1.25 @a+"):
        out += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(60)]
    return out


def test_base_spans(documents):
    rows = [(i, t) for i, t in enumerate(texts())] + [(3, "a@b.cd"), (None, "a@b.cd")]
    docs = documents(rows, clash=("found", "kind", "start"))
    want = sorted(((d, base(t)) for d, t in rows), key=str)
    out = pii.find(docs).collect()
    got = sorted(((r.doc_id, [(s.start, s.order, s.kind, s.end) for s in r.base]) for r in out), key=str)
    assert got == want
    for r in out:
        assert set(r.base) <= set(r.spans) and list(r.spans) == sorted(r.spans)


def test_more_spans_are_found_and_plain_text_is_left_alone(documents):
    rows = [(i, f"word words a {i} and 2024 more text") for i in range(60)]
    rows += [(100 + i, f"my token = \"{i:02d}dbebab91ab85687d33eeaaf9ac699e1188f9\" ok, mail u{i}@host.com, call +1 (017) 555-77{i:02d}")
             for i in range(30)]
    got = {r.doc_id: r for r in pii.find(documents(rows)).collect()}
    assert all(not got[i].spans for i in range(60))
    assert all({s.kind for s in got[100 + i].spans} == {"secret", "email", "phone"} for i in range(30))


def test_em_finds_the_good_labelers():
    rng = np.random.default_rng(1)
    counts = {}
    truth = {}
    for _ in range(4000):
        true = rng.random() < 0.4
        votes = tuple(int(v) for v in np.where(rng.random(5) < (0.9, 0.85, 0.9, 0.8, 0.55), 1, -1) * (1 if true else -1))
        key = ("card", votes)
        counts[key] = counts.get(key, 0) + 1
        truth.setdefault(key, []).append(true)
    patterns = [(k, v, n) for (k, v), n in sorted(counts.items())]
    p, table = pii.aggregate_votes(patterns)
    right = sum(np.mean(truth[(k, v)]) * n if q > 0.5 else (1 - np.mean(truth[(k, v)])) * n for (k, v, n), q in zip(patterns, p))
    assert right / 4000 > 0.95
    weights = pii.train_classifier(patterns, p)[len(pii.KINDS):]
    assert min(weights[:4]) > weights[4]


def test_mask(documents):
    rows = [(1, "é a@b.cd, +1 (017) 555-7713!"), (2, None), (3, "plain"), (4, "12@1.2.3.4")]
    docs = documents(rows, clash=("__x",))
    out = pii.masked(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: "é <email>, <phone>!", 2: None, 3: "plain", 4: "<email>"}


def test_empty_table(documents):
    none = documents([(1, "a")]).limit(0)
    assert pii.find(none).count() == 0 and pii.masked(none).count() == 0


def test_no_python_in_the_plan(documents, capsys):
    pii.find(documents([(1, "a@b.cd")])).explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("kind", sorted(pii.LOOSE))
def test_every_kind_has_cues(kind):
    assert pii.CUES[kind]


def test_overlaps_and_masks_against_plain_loops(shared):
    """Spans dropped beside firm ones, and masks, for more spans than a group holds."""
    from pyspark.sql import functions as F

    rng = random.Random(7)
    rows = []
    for n in (0, 1, 3, 40, 700):
        make = lambda m: [
            (rng.choice(pii.KINDS), a, a + rng.randint(1, 30), True, [1, 0, 0, 1, 1]) for a in (rng.randrange(4 * n + 1) for _ in range(m))
        ]
        rows += [(n, make(n), make(n), "é" + "".join(rng.choice("abcé ") for _ in range(4 * n + 40))), (n, make(n), [], "x" * 999), (n, [], make(n), "y" * 999)]
    df = shared.createDataFrame(rows, f"n int, firm {pii.CANDIDATE}, loose {pii.CANDIDATE}, text string")
    got = df.select(
        "*", pii._apart(F.col("loose"), F.col("firm")).alias("free"), pii._placed(F.col("loose"), lambda s: s["base"]).alias("placed")
    ).withColumn("masked", pii.mask(F.col("text"), F.col("placed"))).collect()
    for r in got:
        want = [s for s in r.loose if not any(f.start < s.end and s.start < f.end for f in r.firm)]
        assert sorted(r.free) == sorted(want)
        at, parts = 0, []
        for s in r.placed:
            if s.start >= at:
                parts += [r.text[at:s.start], f"<{s.kind}>"]
            at = max(at, s.end)
        assert r.masked == "".join(parts) + r.text[at:]


def test_a_page_of_addresses(documents):
    """Time grows with the spans of a text, not with their square."""
    import time

    def seconds(n):
        text = " ".join(f"user{i}@mail{i % 97}.example.com, +1 (017) 555-{i % 10000:04d};" for i in range(n // 2))
        docs = documents([(1, text)])
        start = time.perf_counter()
        (row,) = pii.find(docs).collect()
        middle = time.perf_counter()
        (out,) = pii.masked(docs).collect()
        assert len(row.spans) == n and out.text.count("<email>") == out.text.count("<phone>") == n // 2
        return middle - start, time.perf_counter() - middle

    seconds(2)
    few, many = seconds(4_000), seconds(32_000)
    assert many[0] < 12 * few[0] + 4 and many[1] < 12 * few[1] + 4, (few, many)  # eight times the spans
    print(few, many)
