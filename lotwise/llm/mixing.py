"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies, as close as possible (in
relative entropy) to one each while the words taken from each source meet its target and
no rate exceeds ``most`` copies. The optimum is an exponential tilt of the document's
size, ``min(most, exp(x * size / mean size))``, with one multiplier x for each source:
the maximum of a concave dual. Newton's method finds it: each iteration is one
aggregate over the table of (source, size, documents), far smaller than the documents,
and all sources step at once. A bracket around each multiplier catches steps that
overshoot where rates meet the bound.

Rates become whole copies by a hash of the document, shifted by an offset of its source.
All ``offsets`` candidates are tried in one aggregate, and each source takes the one whose
copies come nearest to its target. So the choice needs no order, no window and no
shuffle of documents, and a rerun agrees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import SPACE_WORDS, share, spare
from lotwise.workspace import stored, stored_lookup

WEIGHTS = (5.0, 2.0, 1.0)
OFFSETS = 32


def n_words(text: Column) -> Column:
    """Number of words between ASCII blanks; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORDS)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = 1.5, most: float = 2.0
) -> DataFrame:
    """(source, total, docs, target) from (source, total, docs), one row for each source.

    Sources by code point, null last, weigh ``weights`` in turn and share ``budget`` times
    all words. A target stops at ``most`` times its source's words; what is left over is
    shared again by weight until no target is above. The order is a window over the
    sources, a table of names, not of documents.
    """
    c = F.col
    order = Window.orderBy(c("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1)
    ranked = stored(sizes.withColumn("weight", weight), "sources")
    cap = c("total") * F.lit(float(most))
    total = ranked.agg(F.sum("total").alias("t")).first()["t"] or 0
    left, level, capped = budget * total, 0.0, -1
    while True:
        # sources below the water level keep their caps; the others share what is left
        above = c("weight") * F.lit(level) > cap
        now = ranked.agg(
            F.count(F.when(above, 1)).alias("n"),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, c("weight"))), F.lit(0.0)).alias("w"),
        ).first()
        if now["n"] == capped or now["w"] == 0:
            break
        capped, level = now["n"], (left - now["held"]) / now["w"]
    return ranked.withColumn("target", F.least(cap.cast("double"), c("weight") * F.lit(level)))


def _rate(x: Column, size: Column, mean: Column, most: float) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.least(x * size / mean, F.lit(50.0))))


def tilts(
    histogram: DataFrame, targets: DataFrame, most: float = 2.0, rounds: int = 80, close: float = 1e-7
) -> DataFrame:
    """(source, total, target, x, mean): each source's multiplier, by Newton steps on the dual.

    A source whose target is all its words ``most`` times gets the multiplier that brings
    its smallest possible document, one word, to the bound; one without words any.
    """
    c = F.col
    mean = F.greatest(c("total") / F.greatest(c("docs"), F.lit(1)), F.lit(1e-9))
    top = F.log(F.lit(float(most))) * mean
    full = c("target") >= c("total") * most * (1 - 1e-12)
    now = targets.select(
        *("source", "total", "target"),
        mean.alias("mean"),
        F.when(full, top).otherwise(0.0).alias("x"),
        (-60.0 * mean).alias("lo"),
        top.alias("hi"),
        F.lit(True).alias("open"),
    )
    now = stored_lookup(now, "tilts")
    for _ in range(rounds):
        side = now.select(c("source").alias("s"), "x", "mean")
        met = histogram.join(side, histogram["source"].eqNullSafe(side["s"])).drop("source")
        rate = _rate(c("x"), c("size"), c("mean"), most)
        words = c("size") * c("n")
        slope = F.when(rate < most, words * rate * c("size") / c("mean")).otherwise(0.0)
        sums = met.groupBy("s").agg(F.sum(words * rate).alias("f"), F.sum(slope).alias("d"))
        step = now.join(sums, now["source"].eqNullSafe(sums["s"]), "left")
        off = F.coalesce(c("f"), F.lit(0.0)) - c("target")
        settled = F.abs(off) <= close * c("target")
        lo = F.when(off <= 0, c("x")).otherwise(c("lo"))
        hi = F.when(off >= 0, c("x")).otherwise(c("hi"))
        newton = c("x") - off / F.nullif(c("d"), F.lit(0.0))
        moved = F.when((newton > lo) & (newton < hi), newton).otherwise((lo + hi) / 2)
        now = stored_lookup(
            step.select(
                *("source", "total", "target", "mean"),
                F.when(settled, c("x")).otherwise(moved).alias("x"),
                lo.alias("lo"),
                hi.alias("hi"),
                (~settled).alias("open"),
            ),
            "tilts",
        )
        if now.filter("open").isEmpty():
            break
    # digits beyond these depend on the order of a summation
    return now.select("source", "total", "target", F.round("x", 9).alias("x"), "mean")


def _copies(rate: Column, chance: Column) -> Column:
    return F.floor(rate + F.pmod(chance, F.lit(1.0))).cast("int")


def plan(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    id_column: str = "doc_id",
    weights: tuple[float, ...] = WEIGHTS,
    budget: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """(source, total, target, x, mean, offset): all that :func:`copies` needs to know."""
    c = F.col
    sized = docs.select(
        c(f"`{source}`").alias("source"),
        n_words(c(f"`{text}`")).alias("size"),
        _chance(id_column, text).alias("chance"),
    )
    sized = stored(sized, "sizes")
    histogram = stored(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    totals = histogram.groupBy("source").agg(
        F.sum(c("size") * c("n")).alias("total"), F.sum("n").alias("docs")
    )
    tilted = stored_lookup(tilts(histogram, source_targets(totals, weights, budget, most), most), "tilts")
    side = tilted.withColumnRenamed("source", "s")
    met = sized.join(side, sized["source"].eqNullSafe(side["s"])).drop("source")
    rate = _rate(c("x"), c("size"), c("mean"), most)
    tried = met.groupBy("s").agg(
        *[F.sum(_copies(rate, c("chance") + k / OFFSETS) * c("size")).alias(f"t{k}") for k in range(OFFSETS)]
    )
    both = tilted.join(tried, tilted["source"].eqNullSafe(tried["s"]), "left")
    distance = [F.struct(F.abs(c(f"t{k}") - c("target")).alias("d"), F.lit(k / OFFSETS).alias("o")) for k in range(OFFSETS)]
    best = F.array_min(F.array(*distance))
    return stored_lookup(both.select(*tilted.columns, best["o"].alias("offset")), "plan")


def _chance(id_column: str, text: str) -> Column:
    return share(F.xxhash64(F.col(f"`{id_column}`"), F.col(f"`{text}`")), 9)


def with_copies(
    docs: DataFrame,
    planned: DataFrame,
    text: str = "text",
    source: str = "source",
    id_column: str = "doc_id",
    most: float = 2.0,
    name: str = "mix",
) -> DataFrame:
    """``docs`` and a column ``name``: struct(size, source_size, target, copies).

    Null and wordless texts have size 0 and take part as one copy. Rows equal in id and text
    get the same number of copies, so a source made of one repeated row takes it a whole
    number of times and may miss its target by half of it; a null source is one of its own.
    """
    c = F.col
    name = spare(docs, name)
    side = planned.select(F.struct(*planned.columns).alias(spare(docs, "_plan")))
    plan_column = side.columns[0]
    met = docs.join(side, docs[f"`{source}`"].eqNullSafe(side[plan_column]["source"]), "left")
    p = c(plan_column)
    size = n_words(c(f"`{text}`"))
    rate = _rate(p["x"], size, p["mean"], most)
    mix = F.struct(
        size.alias("size"),
        p["total"].alias("source_size"),
        p["target"].alias("target"),
        _copies(rate, _chance(id_column, text) + p["offset"]).alias("copies"),
    )
    return met.withColumn(name, mix).drop(plan_column)


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it; columns unchanged."""
    columns = {k: v for k, v in options.items() if k in ("text", "source", "id_column", "most")}
    name = spare(docs, "mix")
    counted = with_copies(docs, plan(docs, **options), name=name, **columns)
    times = F.explode(F.array_repeat(F.lit(0), F.col(f"{name}.copies"))).alias(spare(docs, "_time"))
    return counted.select(*[F.col(f"`{x}`") for x in docs.columns], times).drop(spare(docs, "_time"))
