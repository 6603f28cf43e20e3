"""Mixing sources to target token counts by entropy balancing.

Rates.  Among all non-negative document rates of at most `most` that give each source its target
number of words, the ones closest to "each document once" in relative entropy are exponentially
tilted: rate = min(most, exp(m * size)), with one multiplier m per source.  The convex dual is
maximised by Newton steps, all sources at once; a step is one aggregation over the (source, size)
counts, which the documents are reduced to first.  A step that leaves the known bracket, or is not
down to half of the one before, gives way to halving the bracket, or to doubling the step while there
is none, so that a source with short and very long documents settles too; one that does not is an error.

Copies.  A document is taken floor(rate) times, and once more if its key, a hash of it less its
rate's fraction, is below the source's cut.  The cut is found from word-weighted histograms, level by
level, so that the next document by key would pass the target.  What is left open, less than one
document, is filled from the (source, size) counts: the largest size that fits and has copies to spare,
as often as it can, then the next smaller one.  Documents of one size have one rate, so such copies go
round them in the order of their keys, those not yet rounded up first.  At the end a source's open
words are fewer than its smallest document that may still be taken once more, but for documents that
repeat in id and size: they are taken equally often, or their size is left.

Everything per source is a table; the driver sees totals and iteration counts only, and the
source's order number comes from a range-sorted pass, so sources may be many.  A source with a third
of all rows is aggregated map-side; the joins with per-source tables are on a broadcast
when Spark's statistics allow and are split by skew handling otherwise.

Defined results: null text has size 0; null source is a source, last in order.  Documents of size 0
have rate 1.  A source without words has target 0; documents with words have rate 0 at target 0.  Repeated rows are documents each.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prosemill.llm.common import stored, word_count
from prosemill.operators.scaling import with_position

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
SEED = 17
STEPS = 200  # a source still open after so many is an error
NEAR = 1e-7  # relative distance to the target at which the multipliers are settled
LEVELS, BINS = 3, 1024
TASK_ROWS = 1_000_000  # documents of one source and size ranked by one task, about
EXTRA = "map<bigint,struct<whole:bigint,below:double>>"


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from documents with source and size.

    Sources in code point order, null last, get the weights in turn and share all words by weight; a
    target stops at `most` times its source's size, and what is over is shared again by weight.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = with_position(
        per, [F.col("source").isNull(), F.col("source")], name="place"
    )
    share = F.array(*[F.lit(float(w)) for w in weights])
    per = stored(
        placed.withColumn("weight", F.get(share, F.pmod("place", F.lit(len(weights))).cast("int")))
        .withColumn("cap", F.lit(float(most)) * F.col("source_size"))
        .drop("place"),
        "mix-sources",
    )
    total = float(per.agg(F.sum("source_size")).first()[0] or 0)
    level = None  # words per unit of weight
    while True:
        over = F.lit(False) if level is None else F.col("weight") * F.lit(level) > F.col("cap")
        free = per.agg(
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(F.when(over, F.col("cap")).otherwise(0.0)).alias("capped"),
        ).first()
        if not free.weight:
            break
        new = (total - free.capped) / free.weight
        if new == level:
            break
        level = new
    target = F.least(F.col("cap"), F.col("weight") * F.lit(level or 0.0))
    return per.select("source", "source_size", target.alias("target"))


def _rate(m: Column, size: Column, most: float) -> Column:
    return F.least(F.lit(most), F.exp(F.least(m * size, F.lit(50.0))))


def tilts(counts: DataFrame, targets: DataFrame, most: float = MOST) -> DataFrame:
    """(source, source_size, target, m): the multiplier that meets each source's target.

    counts: (source, size, n).  At the cap m is infinite, at target 0 minus infinite; without words it is 0.
    """
    # scaled to the source's word-weighted mean size, a step of 1 is a factor e on a typical word
    scale = counts.groupBy("source").agg(
        F.try_divide(
            F.sum(F.col("n") * F.col("size") * F.col("size")), F.sum(F.col("n") * F.col("size"))
        ).alias("unit")
    )
    state = stored(
        targets.join(scale, targets.source.eqNullSafe(scale.source)).drop(scale.source)
        .withColumn("unit", F.when(F.col("unit") > 0, F.col("unit")).otherwise(1.0))
        .withColumn(
            "open",
            (F.col("source_size") > 0) & (F.col("target") > 0)
            & (F.col("target") < most * F.col("source_size") * (1 - 1e-12)),
        )
        .withColumn("m", F.lit(0.0))
        .withColumn("lo", F.lit(None).cast("double"))
        .withColumn("hi", F.lit(None).cast("double"))
        .withColumn("last", F.lit(None).cast("double")),
        "mix-state",
    )
    steps = 0
    while left := state.where("open").count():
        if steps == STEPS:
            raise RuntimeError(f"{left} sources do not meet their targets after {STEPS} steps")
        steps += 1
        c = counts.alias("c").join(state.where("open").alias("s"), F.expr("c.source <=> s.source"))
        x = F.col("c.size") / F.col("s.unit")
        rate = _rate(F.col("s.m"), x, most)
        words = F.col("c.n") * F.col("c.size")
        sums = c.groupBy(F.col("s.source").alias("source")).agg(
            F.sum(words * rate).alias("got"),
            F.sum(F.when(rate < most, words * x * rate).otherwise(0.0)).alias("slope"),
        )
        new = (
            state.alias("s")
            .join(sums.alias("g"), F.expr("s.source <=> g.source"), "left")
            .select("s.*", "g.got", "g.slope")
            .withColumn("gap", F.col("target") - F.col("got"))
            .withColumn("lo", F.when(F.col("gap") > 0, F.col("m")).otherwise(F.col("lo")))
            .withColumn("hi", F.when(F.col("gap") < 0, F.col("m")).otherwise(F.col("hi")))
            .withColumn("done", F.abs("gap") <= NEAR * F.col("target"))
            .withColumn("newton", F.when(F.col("slope") > 0, F.col("gap") / F.col("slope")))
            .withColumn(
                "good",
                F.col("newton").isNotNull()
                & (F.col("last").isNull() | (F.abs("newton") <= F.col("last") / 2))
                & (F.col("lo").isNull() | (F.col("m") + F.col("newton") > F.col("lo")))
                & (F.col("hi").isNull() | (F.col("m") + F.col("newton") < F.col("hi"))),
            )
            .withColumn("far", F.greatest(2 * F.coalesce("last", F.lit(1.0)), F.abs("newton")))
            .withColumn(
                "move",
                F.when(~F.col("open") | F.col("done"), 0.0)
                .when(F.col("good"), F.col("newton"))
                .when(F.col("lo").isNotNull() & F.col("hi").isNotNull(), (F.col("lo") + F.col("hi")) / 2 - F.col("m"))
                .otherwise(F.signum("gap") * F.col("far")),
            )
            .withColumn("m", F.col("m") + F.col("move"))
            .withColumn("last", F.abs("move"))
            .withColumn("open", F.col("open") & ~F.col("done"))
        )
        state = stored(
            new.select("source", "source_size", "target", "unit", "open", "m", "lo", "hi", "last"), "mix-state"
        )
    # rounded, so that the order in which a run adds its doubles leaves no trace
    m = F.when(
        (F.col("source_size") > 0) & (F.col("target") >= most * F.col("source_size") * (1 - 1e-12)),
        F.lit(float("inf")),
    ).when(
        (F.col("source_size") > 0) & (F.col("target") <= 0), F.lit(float("-inf"))
    ).otherwise(F.round(F.col("m") / F.col("unit"), 12))
    return stored(state.select("source", "source_size", "target", m.alias("m")), "mix-tilts")


def _base_and_key(doc_id: Column, size: Column, m: Column, most: int, seed: int) -> tuple[Column, Column]:
    """floor(rate), and the key in [-1, 1) that rounds up below a cut: the same in every run."""
    rate = (
        F.when(size == 0, F.lit(1.0))
        .when(m == float("inf"), F.lit(float(most)))
        .otherwise(_rate(m, size, float(most)))
    )
    draw = F.pmod(F.xxhash64(F.lit(seed), doc_id, size), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return F.floor(rate).cast("long"), draw - (rate - F.floor(rate))


def plan(docs: DataFrame, weights=WEIGHTS, most: int = 3, seed: int = SEED, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """The documents' (doc_id, source, size), and one row per source: source, source_size, target, m,
    cut, extra.  `copies` needs no more."""
    sized = stored(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
        ),
        "mix-sizes",
    )
    counts = stored(
        sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-counts"
    )
    targets = stored(
        source_targets(counts.select("source", (F.col("size") * F.col("n")).alias("size")), weights, float(most)),
        "mix-targets",
    )
    tilt = tilts(counts, targets, float(most))
    base, key = _base_and_key(F.col("d.doc_id"), F.col("d.size"), F.col("t.m"), most, seed)
    rated = stored(
        sized.alias("d").join(tilt.alias("t"), F.expr("d.source <=> t.source"))
        .select("d.source", "d.size", "t.target", base.alias("base"), key.alias("key"))
        .where((F.col("base") < most) & (F.col("size") > 0)),
        "mix-rated",
    )
    floor, _ = _base_and_key(F.lit(0), F.col("c.size"), F.col("t.m"), most, seed)
    groups = stored(
        counts.alias("c").join(tilt.alias("t"), F.expr("c.source <=> t.source"))
        .select("c.source", "c.size", "c.n", "t.target", floor.alias("base")),
        "mix-groups",
    )
    need = groups.groupBy("source").agg(
        (F.first("target") - F.sum(F.col("base") * F.col("size") * F.col("n"))).alias("need")
    )
    cuts = _cuts(rated, need)
    extra = _extra(rated, groups, cuts, most)
    per = stored(
        tilt.alias("t").join(cuts.alias("c"), F.expr("t.source <=> c.source"))
        .join(extra.alias("e"), F.expr("t.source <=> e.source"), "left")
        .select("t.source", "t.source_size", "t.target", "t.m", "c.cut", "e.extra"),
        "mix-plan",
    )
    return sized, per


def _turn(key: Column, cut: Column) -> Column:
    """Documents of one size in turn: those below the cut have been rounded up and come last."""
    return F.when(key < cut, key + 2.0).otherwise(key)


def copies(doc_id: Column, size: Column, per: str = "p", most: int = 3, seed: int = SEED) -> Column:
    """How often a document is taken; `per` is the alias of the plan's row of its source."""
    base, key = _base_and_key(doc_id, size, F.col(f"{per}.m"), most, seed)
    cut, extra = F.col(f"{per}.cut"), F.try_element_at(F.col(f"{per}.extra"), size)
    up = F.when((base < most) & (size > 0) & (key < cut), 1).otherwise(0)
    more = extra["whole"] + F.when(_turn(key, cut) < extra["below"], 1).otherwise(0)
    return base + up + F.coalesce(more, F.lit(0))


def mix(docs: DataFrame, weights=WEIGHTS, most: int = 3, seed: int = SEED, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every row."""
    sized, per = plan(docs, weights, most, seed, id_col, text_col, source_col)
    return (
        sized.alias("d").join(per.alias("p"), F.expr("d.source <=> p.source"))
        .select(
            "d.doc_id", "d.source", "d.size", "p.source_size", "p.target",
            copies(F.col("d.doc_id"), F.col("d.size"), "p", most, seed).alias("copies"),
        )
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def mixed(docs: DataFrame, weights=WEIGHTS, most: int = 3, seed: int = SEED, id_col: str = "doc_id",
          text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it."""
    _, per = plan(docs, weights, most, seed, id_col, text_col, source_col)
    # the size is made below the join, once: the rates use it many times
    sized = docs.withColumn("__size", word_count(F.col(text_col)))
    n = copies(F.col(f"d.{id_col}"), F.col("d.__size"), "p", most, seed)
    return (
        sized.alias("d").join(per.alias("p"), F.expr(f"d.{source_col} <=> p.source"))
        .select("d.*", F.explode(F.array_repeat(F.lit(0), n.cast("int"))).alias("__copy"))
        .drop("__copy", "__size")
    )


def _cuts(can: DataFrame, need: DataFrame) -> DataFrame:
    """(source, cut, left): documents with a key below the cut are rounded up, `left` words stay open.

    The next document by key would pass the target.  Each level cuts the bin that holds the crossing
    into `BINS` finer ones: one aggregation over the documents, grouped by source and bin.
    """
    state = stored(
        need.withColumn("left", F.col("need")).withColumn("lo", F.lit(-1.0)).withColumn("width", F.lit(2.0)),
        "mix-cuts",
    )
    for _ in range(LEVELS):
        inside = (
            can.alias("d").join(state.alias("s"), F.expr("d.source <=> s.source"))
            .where("d.key >= s.lo and d.key < s.lo + s.width")
            .select(
                "s.source", "d.size",
                F.least(
                    F.floor((F.col("d.key") - F.col("s.lo")) / F.col("s.width") * BINS), F.lit(BINS - 1)
                ).cast("int").alias("bin"),
            )
        )
        hist = inside.groupBy("source", "bin").agg(F.sum("size").alias("words"))
        ladder = hist.groupBy("source").agg(
            F.sort_array(F.collect_list(F.struct("bin", "words"))).alias("bins")  # at most BINS of them
        )
        start = F.struct(F.col("left").alias("left"), F.lit(BINS).alias("bin"), F.lit(False).alias("stop"))
        # the crossing bin is the first whose words would pass what is left
        walk = F.aggregate(
            "bins", start,
            lambda a, b: F.when(a["stop"], a)
            .when(
                b["words"] > a["left"],
                F.struct(a["left"].alias("left"), b["bin"].alias("bin"), F.lit(True).alias("stop")),
            )
            .otherwise(
                F.struct((a["left"] - b["words"]).alias("left"), a["bin"].alias("bin"), F.lit(False).alias("stop"))
            ),
        )
        state = stored(
            state.alias("s").join(ladder.alias("l"), F.expr("s.source <=> l.source"), "left")
            .select(
                "s.*",
                F.coalesce("l.bins", F.array().cast("array<struct<bin:int,words:bigint>>")).alias("bins"),
            )
            .withColumn("at", walk)
            .select(
                "source", F.col("at.left").alias("left"),
                (F.col("lo") + F.col("width") * F.col("at.bin") / BINS).alias("lo"),
                F.when(F.col("at.stop"), F.col("width") / BINS).otherwise(F.lit(0.0)).alias("width"),
            ),
            "mix-cuts",
        )
    return state.select("source", F.col("lo").alias("cut"), "left")


def _fill(sizes: pd.DataFrame) -> pd.DataFrame:
    """Of one source, by falling size: as many copies as fit and are to spare."""
    left, picked = float(sizes["left"].iloc[0]), []
    for size, n, spare in sizes.sort_values("size", ascending=False)[["size", "n", "spare"]].itertuples(index=False):
        take = min(spare, int(left // size))
        if take:
            left -= take * size
            picked.append((sizes["source"].iloc[0], size, n, take // n, take % n))
    return pd.DataFrame(picked, columns=["source", "size", "n", "whole", "rest"])


def _extra(can: DataFrame, groups: DataFrame, cuts: DataFrame, most: int) -> DataFrame:
    """(source, extra): of the sizes that fill what is left, how often all documents are taken once
    more, and the turn below which one copy more goes out.

    What is left is less than a document, so a source has no more sizes here than its longest
    document has words, and no more copies to give.
    """
    up = (
        can.alias("d").join(cuts.alias("c"), F.expr("d.source <=> c.source")).where("d.key < c.cut")
        .groupBy("d.source", "d.size").agg(F.count(F.lit(1)).alias("up"))
    )
    spare = (
        groups.alias("g").join(cuts.alias("c"), F.expr("g.source <=> c.source")).where("g.size between 1 and c.left")
        .join(up.alias("u"), F.expr("g.source <=> u.source and g.size = u.size"), "left")
        .select(
            "g.source", "g.size", "g.n", "c.left",
            (F.col("g.n") * (F.lit(most) - F.col("g.base")) - F.coalesce("u.up", F.lit(0))).alias("spare"),
        )
        .where("spare > 0")
    )
    picked = stored(
        spare.groupBy("source").applyInPandas(
            _fill, "source string, size long, n long, whole long, rest long"
        ),
        "mix-picked",
    )
    turns = (
        can.alias("d").join(cuts.alias("c"), F.expr("d.source <=> c.source"))
        .join(picked.where("rest > 0").alias("p"), F.expr("d.source <=> p.source and d.size = p.size"))
        .select(
            "p.source", "p.size", "p.rest", _turn(F.col("d.key"), F.col("c.cut")).alias("turn"),
            F.pmod(F.xxhash64("d.key"), F.ceil(F.col("p.n") / TASK_ROWS)).alias("part"),
        )
    )
    # the first of each part, then the first of those: a size that many documents have fills many parts
    first = turns.withColumn("i", F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("turn")))
    whole = first.where("i <= rest + 1").withColumn(
        "i", F.row_number().over(Window.partitionBy("source", "size").orderBy("turn"))
    )
    below = whole.where("i = rest + 1").select("source", "size", F.col("turn").alias("below"))
    return (
        picked.alias("p").join(below.alias("b"), F.expr("p.source <=> b.source and p.size = b.size"), "left")
        .groupBy("p.source")
        .agg(
            F.map_from_entries(
                F.collect_list(
                    F.struct(
                        F.col("p.size").alias("size"),
                        F.struct(F.col("p.whole").alias("whole"), F.coalesce("b.below", F.lit(-2.0)).alias("below")),
                    )
                )
            ).cast(EXTRA).alias("extra")
        )
    )
