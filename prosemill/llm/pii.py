"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs the labelers.

Candidates are the spans of the base patterns (kept whatever comes) and of looser ones: digit groups
that fail the card check, national phone numbers, spelled-out e-mail addresses, IPv6 addresses, long
mixed tokens.  Five labelers vote for (1), against (-1) or not at all (0): a regular expression for the
strict form, a gazetteer (top-level domains, card issuers, country codes, reserved address blocks),
cue words in the text before, clean edges, and the variety of characters.  Expectation-maximisation
over the counts of (kind, votes) estimates each labeler's reliability and the share of true spans; a
logistic regression on votes and kind, trained on the resulting soft labels, is the span classifier.
The driver sees the counts by (kind, votes) only, at most 5 x 3^5 rows.

Everything that touches rows is DataFrame functions.  Patterns start a match at the edge of a run of
their first class only and are possessive, so that matching is linear in the text.  Offsets come
from the lengths of the pieces between matches, added up in two levels.

Defined results: null text is empty.  Rows are judged each, repeated rows included; other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosemill.llm.common import stored

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]

# The base patterns.  A run is only entered at its edge (or where the last match ended): a later
# start inside the run meets the same continuation, so leftmost matches stay what they are.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BYTE = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"

# Looser candidates.
LOOSE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\]|\{at\})\x20?[A-Za-z0-9-]++"
             r"(?:\x20?(?:\.|\(dot\)|\[dot\]|\{dot\})\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "secret": r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{24,}+",
}

# Fixed word lists of the labelers.
DOMAINS = "com org net edu gov mil int info biz io ai co uk de fr es it nl eu ch at be se no pl pt us ca au jp".split()
CUES = {
    "email": "mail contact write reach address kontakt correo courriel",
    "ip": "ip host server address addr login from client",
    "card": "card visa master credit debit amex payment pay karte tarjeta carte",
    "phone": "phone tel call mobile cell fax fon telefon dial llame contact",
    "secret": "token key secret password passwd pwd auth bearer api credential",
}
SPAN = "array<struct<start:int,end:int,text:string,before:string,after:string>>"
GROUP = 256
EM_ROUNDS = 200


def _total(lens: Column, first: Column, n: Column) -> Column:
    return F.aggregate(F.slice(lens, first, n), F.lit(0), lambda a, x: a + x)


def _spans(text: Column, pattern: str, may: Column) -> Column:
    """All matches with offsets in code points, the 40 characters before and the one after.

    `may`: a cheap necessary condition.  The place of match i is the sum of the lengths up to it; whole
    groups of 256 lengths are added up once.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    both = F.transform(
        F.arrays_zip(pieces.alias("piece"), found.alias("match")),
        lambda z: F.struct(
            z["piece"].alias("piece"), z["match"].alias("match"),
            (F.length(z["piece"]) + F.coalesce(F.length(z["match"]), F.lit(0))).alias("len"),
        ),
    )

    def place(zipped: Column) -> Column:
        lens = F.transform(zipped, lambda z: z["len"])
        groups = F.transform(
            F.sequence(F.lit(0), F.floor(F.size(lens) / GROUP).cast("int")),
            lambda g: _total(lens, g * GROUP + 1, F.lit(GROUP)),
        )
        packed = F.struct(
            zipped.alias("z"), lens.alias("lens"),
            F.transform(
                F.sequence(F.lit(0), F.size(groups) - 1), lambda g: _total(groups, F.lit(1), g)
            ).alias("upto"),
        )

        def out(p: Column) -> Column:
            def span(z: Column, i: Column) -> Column:
                start = (
                    F.get(p["upto"], F.floor(i / GROUP).cast("int"))
                    + _total(p["lens"], F.floor(i / GROUP).cast("int") * GROUP + 1, F.pmod(i, F.lit(GROUP)))
                    + F.length(z["piece"])
                )
                return F.struct(
                    start.alias("start"), (start + F.length(z["match"])).alias("end"),
                    z["match"].alias("text"), F.right(z["piece"], F.lit(40)).alias("before"),
                    F.left(F.coalesce(F.get(p["z"], i + 1)["piece"], F.lit("")), F.lit(1)).alias("after"),
                )

            return F.filter(F.transform(p["z"], span), lambda s: s["text"].isNotNull())

        return F.flatten(F.transform(F.array(packed), out))

    # each step is computed once: a one-element array carries it into the next
    whole = F.flatten(F.transform(F.array(both), lambda b: F.when(F.size(b) > 1, place(b)).otherwise(F.array().cast(SPAN))))
    return F.when(may, whole).otherwise(F.array().cast(SPAN))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, its digits added: the sum ends in 0."""
    each = F.split(F.reverse(digits), "")
    total = F.aggregate(
        F.transform(
            F.filter(each, lambda d: d != ""),
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
            ),
        ),
        F.lit(0), lambda a, x: a + x,
    )
    return total % 10 == 0


def _valid(kind: str, s: Column) -> Column:
    x = s["text"]
    if kind == "ip":
        return F.forall(F.split(x, r"\."), lambda part: part.rlike(BYTE))
    if kind == "card":
        n = F.length(_digits(x))
        return F.when(n.between(12, 19), _luhn(_digits(x))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(x)).between(9, 15)
    return F.lit(True)


def _votes(kind: str, s: Column, strict: Column) -> Column:
    x = s["text"]
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    if kind == "email":
        last = F.lower(F.regexp_extract(x, r"([A-Za-z0-9-]+)$", 1))
        known = F.when(last.isin(DOMAINS), yes).otherwise(no)
        varied = F.when(x.rlike("^[^@(\\[{]*[A-Za-z]"), yes).otherwise(no)
    elif kind == "ip":
        known = F.when(x.rlike(r"^(?:0|127|255)\."), no).otherwise(yes)
        varied = F.when(F.size(F.array_distinct(F.split(x, r"[.:]"))) > 1, yes).otherwise(no)
    elif kind == "card":
        known = F.when(_digits(x).rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"), yes).otherwise(no)
        varied = F.when(F.size(F.array_distinct(F.split(_digits(x), ""))) > 4, yes).otherwise(no)
    elif kind == "phone":
        known = F.when(x.rlike(r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"), yes).when(
            x.startswith("+"), no
        ).otherwise(none)
        varied = F.when(F.size(F.array_distinct(F.split(_digits(x), ""))) > 4, yes).otherwise(no)
    else:
        known = F.when(x.rlike("^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"), yes).otherwise(none)
        varied = F.when(x.rlike("[0-9]") & x.rlike("[A-Za-z]"), yes).otherwise(no)
    cue = F.when(F.lower(s["before"]).rlike("(?:" + "|".join(CUES[kind].split()) + ")"), yes).otherwise(none)
    edge = F.when(s["before"].rlike(r"[\p{L}\p{N}]$") | s["after"].rlike(r"[\p{L}\p{N}]"), no).otherwise(yes)
    return F.array(F.when(strict, yes).otherwise(no), known, cue, edge, varied)


def _candidates(kind: str, spans: Column, base: bool) -> Column:
    def one(s: Column) -> Column:
        valid = _valid(kind, s) if base else F.lit(False)
        return F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            valid.alias("base"), _votes(kind, s, valid).alias("votes"),
        )

    return F.transform(spans, one)


CANDIDATE = "array<struct<kind:string,start:int,end:int,base:boolean,votes:array<int>>>"


def with_candidates(docs: DataFrame, text_col: str = "text", name: str = "found") -> DataFrame:
    """`docs` with its rows' candidate spans and their votes in column `name`."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = {
        "email": (EMAIL, F.contains(text, F.lit("@"))),
        "ip": (IP, text.rlike(r"[0-9]\.[0-9]")),
        "card": (CARD, text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}")),
        "phone": (PHONE, F.contains(text, F.lit("+"))),
    }
    loose = {
        "email": text.rlike(r"(?i)at[)\]}]"),
        "ip": text.rlike(r"[0-9A-Fa-f]:[0-9A-Fa-f]"),
        "phone": text.rlike(r"[0-9]{3}[\x20.-][0-9]{4}"),
        "secret": text.rlike("[0-9]"),
    }
    columns = docs.columns
    sure = docs.select(
        "*",
        *[_spans(text, pattern, may).alias(f"__b_{k}") for k, (pattern, may) in base.items()],
        *[_spans(text, LOOSE[k], may).alias(f"__l_{k}") for k, may in loose.items()],
    )
    voted = sure.select(
        *columns,
        F.concat(*[_candidates(k, F.col(f"__b_{k}"), True) for k in base]).alias("__b"),
        F.concat(*[_candidates(k, F.col(f"__l_{k}"), False) for k in loose]).alias("__l"),
    )
    firm = F.filter("__b", lambda s: s["base"])
    # of base matches that fail their check only long digit groups remain candidates
    failed = F.filter("__b", lambda s: ~s["base"] & (s["kind"] == "card") & (s["end"] - s["start"] >= 12))
    found = _let(firm, lambda f: F.concat(f, _apart(F.concat(failed, F.col("__l")), f)))
    return voted.select(*columns, found.alias(name))


def _let(value: Column, then) -> Column:
    """then(value), with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _running(items: Column, value, kind: str) -> Column:
    """The items in groups of 256, each as (item, before): the largest value(item) of all items before.

    An item costs one step of its group; what the groups before hold is found from one number each.
    """
    start = F.struct(F.lit(0).alias("top"), F.array().cast(f"array<struct<item:{kind},before:int>>").alias("out"))

    def top(group: Column) -> Column:
        return F.aggregate(group, F.lit(0), lambda a, x: F.greatest(a, value(x)))

    def run(group: Column, before: Column) -> Column:
        done = F.aggregate(
            group, start,
            lambda a, x: F.struct(
                F.greatest(a["top"], value(x)).alias("top"),
                F.concat(a["out"], F.array(F.struct(x.alias("item"), a["top"].alias("before")))).alias("out"),
            ),
        )["out"]
        return F.transform(done, lambda r: F.struct(r["item"].alias("item"), F.greatest(r["before"], before).alias("before")))

    def groups(all_items: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_items) - 1) / GROUP).cast("int")),
            lambda g: F.slice(all_items, g * GROUP + 1, F.lit(GROUP)),
        )

    def all_runs(cut: Column) -> Column:
        return _let(
            F.transform(cut, top),
            lambda tops: F.transform(
                cut, lambda group, i: run(group, F.aggregate(F.slice(tops, F.lit(1), i), F.lit(0), lambda a, x: F.greatest(a, x)))
            ),
        )

    none = F.array().cast(f"array<array<struct<item:{kind},before:int>>>")
    return _let(items, lambda every: F.when(F.size(every) > 0, _let(groups(every), all_runs)).otherwise(none))


EVENT = f"struct<at:int,firm:boolean,far:int,span:{CANDIDATE[6:-1]}>"


def _apart(spans: Column, firm: Column) -> Column:
    """The spans that overlap no firm one: in the order of ends and firm starts, no firm end before is beyond their start."""
    events = F.concat(
        F.transform(firm, lambda f: F.struct(
            f["start"].alias("at"), F.lit(True).alias("firm"), f["end"].alias("far"), f.alias("span"))),
        F.transform(spans, lambda s: F.struct(
            s["end"].alias("at"), F.lit(False).alias("firm"), s["start"].alias("far"), s.alias("span"))),
    )
    ran = _running(F.sort_array(events), lambda e: F.when(e["firm"], e["far"]).otherwise(0), EVENT)
    free = F.filter(F.flatten(ran), lambda r: ~r["item"]["firm"] & (r["before"] <= r["item"]["far"]))
    # without firm spans there is nothing to compare with
    return F.when(
        (F.size(firm) > 0) & (F.size(spans) > 0), F.transform(free, lambda r: r["item"]["span"])
    ).otherwise(spans)


def aggregate_votes(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = EM_ROUNDS):
    """P(personal) of each (kind, votes, count), and the labelers' hit and false-alarm rates.

    A labeler votes 1, 0 or -1 with probabilities that depend on the true class only.  The true share is by kind.
    The start is a labeler that errs in one of five votes.
    """
    m = len(patterns[0][1])
    n = np.array([p[2] for p in patterns], float)
    votes = np.array([p[1] for p in patterns]) + 1  # 0, 1, 2
    kinds = np.array([KINDS.index(p[0]) for p in patterns])
    table = np.empty((2, m, 3))
    table[1], table[0] = (0.15, 0.2, 0.65), (0.65, 0.2, 0.15)
    share = np.full(len(KINDS), 0.5)
    p = np.zeros(len(patterns))
    for _ in range(rounds):
        logs = [np.log(table[c][np.arange(m), votes]).sum(axis=1) for c in (0, 1)]
        odds = logs[1] - logs[0] + np.log(share[kinds] / (1 - share[kinds]))
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        if np.abs(new - p).max() < 1e-9:
            p = new
            break
        p = new
        for c, weight in ((0, n * (1 - p)), (1, n * p)):
            for j in range(m):
                # as if each labeler had voted as at the start a few times, so no rate is 0 or 1
                prior = 3 * np.array((0.15, 0.2, 0.65) if c else (0.65, 0.2, 0.15))
                counts = np.bincount(votes[:, j], weights=weight, minlength=3) + prior
                table[c, j] = counts / counts.sum()
        for k in range(len(KINDS)):
            mine = kinds == k
            share[k] = ((n * p)[mine].sum() + 1) / (n[mine].sum() + 2)
    return p, table


def _features(kind: str, votes) -> list[float]:
    return [1.0] + [float(kind == k) for k in KINDS[1:]] + [float(v) for v in votes]


def train_classifier(patterns, p, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Logistic weights on (kind, votes) from soft labels, by Newton steps on the pattern counts."""
    x = np.array([_features(k, v) for k, v, _ in patterns])
    n = np.array([c for _, _, c in patterns], float)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (p - q)) - ridge * w
        hess = (x * (n * q * (1 - q))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w = w + move * min(1.0, 5.0 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-9:
            break
    return np.round(w, 9)


def _accept(s: Column, weights: np.ndarray) -> Column:
    z = F.lit(float(weights[0]))
    for k, w in zip(KINDS[1:], weights[1 : len(KINDS)]):
        z = z + F.when(s["kind"] == k, float(w)).otherwise(0.0)
    for j, w in enumerate(weights[len(KINDS) :]):
        z = z + F.get(s["votes"], F.lit(j)) * float(w)
    return s["base"] | (z >= math.log(0.9 / 0.1))


def fit(known: DataFrame, name: str = "found") -> np.ndarray:
    """The span classifier's weights, from the candidates in column `name`."""
    counts = (
        known.select(F.explode(name).alias("s")).groupBy("s.kind", "s.votes").agg(F.count(F.lit(1)).alias("n"))
        .collect()  # one row for each pattern of votes that occurs
    )
    patterns = sorted((r.kind, tuple(r.votes), r.n) for r in counts)
    if not patterns:
        return np.zeros(len(_features(KINDS[0], [0] * 5)))
    return train_classifier(patterns, aggregate_votes(patterns)[0])


def _placed(found: Column, keep) -> Column:
    """The kept candidates as (start, order, kind, end), sorted."""
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    return F.sort_array(
        F.transform(
            F.filter(found, keep),
            lambda s: F.struct(
                s["start"].alias("start"), order[s["kind"]].alias("order"), s["kind"].alias("kind"),
                s["end"].alias("end"),
            ),
        )
    )


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans): arrays of (start, order, kind, end), sorted; `spans` holds `base` and more."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    known = stored(with_candidates(rows).select("doc_id", "found"), "pii-candidates")
    weights = fit(known)
    return known.select(
        "doc_id",
        _placed(F.col("found"), lambda s: s["base"]).alias("base"),
        _placed(F.col("found"), lambda s: _accept(s, weights)).alias("spans"),
    )


def masked(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `docs` with every span of their text replaced by its kind; null text stays null.

    The texts are searched twice, once to fit the classifier and once to mask, and never shuffled.
    """
    weights = fit(with_candidates(docs.select(text_col), text_col))
    found = with_candidates(docs, text_col, "__found").withColumn(
        "__spans", _placed(F.col("__found"), lambda s: _accept(s, weights))
    )
    return found.select(
        *[mask(F.col(c), F.col("__spans")).alias(c) if c == text_col else F.col(c) for c in docs.columns]
    )


def listed(spans: Column) -> Column:
    """`kind:start:end` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


PLACED = "struct<start:int,order:int,kind:string,end:int>"


def mask(text: Column, spans: Column) -> Column:
    """`text` with every span replaced by its kind in angle brackets; overlapping spans become one.

    spans: sorted.  The text is cut once for each group of spans, and within that for each span.
    """
    def reach(r: Column) -> Column:
        return F.greatest(r["before"], r["item"]["end"])

    def of_group(group: Column) -> Column:
        base, end = F.get(group, F.lit(0))["before"], reach(F.element_at(group, -1))
        return _let(
            F.substring(text, base + 1, end - base),
            lambda part: F.array_join(
                F.transform(
                    group,
                    lambda r: F.when(
                        r["item"]["start"] >= r["before"],
                        F.concat(
                            F.substring(part, r["before"] - base + 1, r["item"]["start"] - r["before"]),
                            F.lit("<"), r["item"]["kind"], F.lit(">"),
                        ),
                    ).otherwise(F.lit("")),
                ),
                "",
            ),
        )

    def whole(groups: Column) -> Column:
        end = reach(F.element_at(F.element_at(groups, -1), -1))
        return F.concat(F.array_join(F.transform(groups, of_group), ""), F.substring(text, end + 1, F.length(text)))

    def masked_text(own: Column) -> Column:
        return F.when(F.size(own) > 0, _let(_running(own, lambda s: s["end"], PLACED), whole)).otherwise(text)

    return _let(spans, masked_text)
