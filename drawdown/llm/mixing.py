"""Mixing sources to target weights by entropy balancing.

Every document starts with rate 1. Of all rates up to `MOST` whose words meet the sources' targets, entropy balancing takes those
nearest to 1 in relative entropy over documents. Their form is known: rate = min(MOST, exp(lambda x)), with x the document's words
over its source's mean, and one lambda for each token constraint. The multipliers solve the convex dual by Newton's method. An
iteration is one distributed aggregate: words reached (the dual's gradient) and their slope (its Hessian, diagonal as each
document counts towards one constraint), from one row per (source, size), combined before the shuffle. A bracket falls back to
bisection where a step would leave it. Sums are exact decimals, so reruns take the same steps.

Rates become copies: the whole part always, and one more for documents chosen in the order of Pareto sampling, whose key is drawn
from a hash of the document's id, until their words fill what the whole parts leave of the target. The place in that order is
found by distributed counts over ever finer buckets of keys; from the bucket where the words run over on, the next `CANDIDATES`
documents are walked in order and those that still fit are taken, then one that doesn't if it brings the sum nearer. So no source is sorted in
one task, and a source misses its target by less than its last small document.

Targets: sources in code point order, null last, weigh 1, 2, 3, repeating, and share all words; a target above `MOST` times its
source stops there and the excess is shared again by weight. The level is found by rounds of one aggregate over sources.

Everything is DataFrame operations. Texts are read once; later steps read (doc_id, source, size).

Defined results: a null text has size 0 and is taken 0 words; null `source` is a source of its own; a source without words has
target 0; rows of one source with one id and one size (repeated rows, null ids) are taken alike, which can cost a target their
joint words. An empty table gives an empty result. Extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from drawdown.llm.common import BROADCAST_ROWS
from drawdown.operators.skew import ordinal, salted_join
from drawdown.session import materialise

MOST = 3
WEIGHTS = 3
CANDIDATES = 1000
#: Keys have LEVELS * BITS bits; a level of the search splits a bucket into 2^BITS.
BITS, LEVELS = 13, 4
TOLERANCE = 1e-9
ITERATIONS = 100
EXACT = "decimal(38,9)"
WORDS = r"[^\x20\x09-\x0D]+"


def _meet(rows: DataFrame, sources: DataFrame, n_sources: int) -> DataFrame:
    """Rows with their source's columns: broadcast while sources are few, else a join that splits hot sources."""
    if n_sources <= BROADCAST_ROWS:
        return rows.join(F.broadcast(sources), "src")
    return salted_join(rows, sources, ["src"], "inner")


def source_targets(sources: DataFrame) -> DataFrame:
    """src, source_size, n_docs, full, target of sources given as src (from 1, in order), source_size, n_docs."""
    sources = sources.withColumn("weight", F.pmod(F.col("src") - 1, F.lit(WEIGHTS)) + 1)
    whole = lambda c: c.cast("decimal(38,0)")
    totals = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    rest, weight, full = totals[0] or 0, totals[1] or 0, F.lit(False)
    while rest:
        full = whole(F.col("weight")) * rest > whole(F.col("source_size")) * (MOST * weight)
        open_ = sources.select("source_size", "weight", full.alias("full")).agg(
            F.coalesce(F.sum(F.when(F.col("full"), F.col("source_size"))), F.lit(0)),
            F.sum(F.when(~F.col("full"), F.col("weight"))),
        )
        stopped, left = open_.first()
        new = totals[0] - MOST * stopped, left
        if new == (rest, weight):
            break
        rest, weight = new
    shared = (F.col("weight") * rest).cast("double") / F.lit(float(weight or 1))
    target = F.when(full, (F.col("source_size") * MOST).cast("double")).otherwise(shared)
    return sources.select("src", "source_size", "n_docs", full.alias("full"), target.alias("target"))


def rate(size: Column, state_lam: Column, mean: Column, full: Column) -> Column:
    tilted = F.least(F.lit(float(MOST)), F.exp(F.least(state_lam * (size.cast("double") / mean), F.lit(1.2))))
    return F.when(full, F.lit(float(MOST))).otherwise(tilted)


def balance(cells: DataFrame, sources: DataFrame, n_sources: int) -> DataFrame:
    """The sources with lam, the multiplier of each that is not full; cells: src, size, n."""
    c = F.col
    mean = F.try_divide(c("source_size").cast("double"), c("n_docs").cast("double"))
    idle = c("full") | (c("target") == 0)
    state = materialise(
        sources.withColumns(
            {
                "mean": mean,
                "lam": F.lit(0.0),
                "low": F.lit(None).cast("double"),
                "high": F.lit(None).cast("double"),
                "done": idle,
            }
        ),
        "mix-state",
    )
    cells = cells.filter("size > 0")
    for _ in range(ITERATIONS):
        if state.filter(~c("done")).isEmpty():
            break
        x = c("size").cast("double") / c("mean")
        w = rate(c("size"), c("lam"), c("mean"), c("full"))
        words = (c("n") * c("size")).cast("double")
        sums = (
            _meet(cells, state.filter(~c("done")).select("src", "mean", "lam", "full"), n_sources)
            .groupBy("src")
            .agg(
                F.sum((words * w).cast(EXACT)).alias("reached"),
                F.sum(F.when(w < MOST, words * w * x).otherwise(0.0).cast(EXACT)).alias("slope"),
            )
        )
        gap = c("target") - c("reached").cast("double")
        low = F.when(gap > 0, c("lam")).otherwise(c("low"))
        high = F.when(gap > 0, c("high")).otherwise(c("lam"))
        newton = c("lam") + F.try_divide(gap, c("slope").cast("double"))
        inside = (newton > F.coalesce(low, F.lit(float("-inf")))) & (newton < F.coalesce(high, F.lit(float("inf"))))
        wider = F.greatest(F.lit(1.0), F.abs(c("lam")))
        halved = F.coalesce((low + high) / 2, F.when(gap > 0, c("lam") + wider).otherwise(c("lam") - wider))
        met = F.abs(gap) <= c("target") * TOLERANCE
        stepped = state.join(sums, "src", "left")
        moved = {
            "lam": F.when(c("done") | met, c("lam")).when(inside, newton).otherwise(halved),
            "low": F.when(c("done"), c("low")).otherwise(low),
            "high": F.when(c("done"), c("high")).otherwise(high),
            "done": c("done") | met,
        }
        state = materialise(stepped.withColumns(moved).select(*state.columns), "mix-state")
    return state.select("src", "source_size", "full", "target", "mean", "lam")


def with_rates(rows: DataFrame) -> DataFrame:
    """Rows (size and the source's multiplier) with whole (copies for certain), part (the rest of the rate)."""
    w = rate(F.col("size"), F.col("lam"), F.col("mean"), F.col("full"))
    whole = F.when(F.col("size") > 0, F.floor(w)).otherwise(0).cast("long")
    return rows.withColumns({"whole": whole, "part": F.when(F.col("size") > 0, w - whole).otherwise(0.0)})


def _key() -> Column:
    """Pareto sampling's place of a document with a part, between 0 and 1, as an integer of LEVELS * BITS bits."""
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"))
    h = (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") + 0.5) / 2.0**52
    f = F.col("part")
    u = h * (1 - f) / (h * (1 - f) + f * (1 - h))
    return F.when(f > 0, F.floor(u * 2.0 ** (LEVELS * BITS)))


def boundaries(items: DataFrame, need: DataFrame, n_sources: int) -> DataFrame:
    """src, low, high, left of each source: keys below `low` are all taken and leave `left` words; keys up to `high` are candidates.

    items: src, key, size of documents with a part; need: src, left.
    """
    c = F.col
    found = None
    active = need.select("src", "left", F.lit(0).cast("long").alias("at"))
    for level in range(LEVELS):
        shift = (LEVELS - 1 - level) * BITS
        inside = _meet(items, active, n_sources).filter(F.shiftright("key", shift + BITS) == c("at"))
        child = (
            inside.groupBy("src", "left", F.shiftright("key", shift).alias("child"))
            .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        )
        upto = W.partitionBy("src").orderBy("child").rowsBetween(W.unboundedPreceding, 0)  # at most 2^BITS rows a source
        child = child.withColumns({"upto": F.sum("words").over(upto), "seen": F.sum("n").over(upto)})
        over = c("upto") > c("left")
        cross = child.groupBy("src", "left").agg(
            F.min(F.when(over, F.struct("child", "words", "upto", "seen", "n"))).alias("x"), F.max("child").alias("end")
        )
        after = F.coalesce(c("x.seen") - c("x.n"), F.lit(0)) + CANDIDATES
        last = (
            child.select("src", "child", "seen")
            .join(cross.select("src", c("x.child").alias("first"), after.alias("limit")), "src")
            .groupBy("src")
            .agg(F.max(F.when(c("seen") <= c("limit"), c("child"))).alias("last"))
        )
        bounds = cross.join(last, "src").select(
            "src",
            (c("left") - F.coalesce(c("x.upto") - c("x.words"), F.lit(0))).alias("left"),
            F.coalesce(c("x.child"), c("end") + 1).alias("at"),
            F.greatest("last", F.coalesce(c("x.child"), c("end"))).alias("last"),
            (c("x.n") > CANDIDATES).alias("open"),
        )
        bounds = materialise(bounds, "mix-boundaries")
        more = F.coalesce("open", F.lit(False)) & F.lit(level < LEVELS - 1)
        wide = F.lit(1 << shift).cast("long")
        settled = bounds.filter(~more).select("src", (c("at") * wide).alias("low"), ((c("last") + 1) * wide).alias("high"), "left")
        found = settled if found is None else found.unionByName(settled)
        active = bounds.filter(more).select("src", "left", "at")
        if active.isEmpty():
            break
    return found


def fill(candidates: DataFrame) -> DataFrame:
    """src, key, size of the candidates taken: in order those that fit, then one that brings the sum nearer.

    candidates: src, left, key, size, words (of all rows that are taken alike).
    """
    start = F.struct(F.col("left").alias("left"), F.array().cast("array<struct<key:bigint,size:bigint,words:bigint>>").alias("got"))

    def step(acc: Column, item: Column) -> Column:
        fits = item["words"] <= acc["left"]
        return F.struct(
            F.when(fits, acc["left"] - item["words"]).otherwise(acc["left"]).alias("left"),
            F.when(fits, F.concat(acc["got"], F.array(item))).otherwise(acc["got"]).alias("got"),
        )

    walked = (
        candidates.groupBy("src", "left")
        .agg(F.array_sort(F.collect_list(F.struct("key", "size", "words"))).alias("items"))
        .withColumn("walk", F.aggregate("items", start, step))
    )
    missed = F.array_except("items", "walk.got")
    nearest = F.array_min(F.transform(missed, lambda m: F.struct(m["words"].alias("words"), m["key"].alias("key"), m["size"].alias("size"))))
    better = F.col("nearest.words") < 2 * F.col("walk.left")
    extra = F.array(F.struct(F.col("nearest.key").alias("key"), F.col("nearest.size").alias("size"), F.col("nearest.words").alias("words")))
    taken = F.when(better, F.concat("walk.got", extra)).otherwise(F.col("walk.got"))
    return walked.withColumn("nearest", nearest).select("src", F.explode(taken).alias("t")).select("src", "t.key", "t.size")


def mix(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken per document."""
    c = F.col
    size = F.regexp_count(F.coalesce(c("text"), F.lit("")), F.lit(WORDS)).cast("long")
    narrow = materialise(documents.select("doc_id", c("source").cast("string").alias("source"), size.alias("size")), "mix-sizes")
    cells = materialise(narrow.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-cells")
    sources = cells.groupBy("source").agg(F.sum(c("size") * c("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    sources = materialise(sources, "mix-sources")
    n_sources = sources.count()
    named = ordinal(sources.filter("source IS NOT NULL"), [], "source", "src")
    last = sources.filter("source IS NULL").withColumn("src", F.lit(n_sources).cast("long"))
    named = materialise(named.unionByName(last).withColumn("known", c("source").isNotNull()), "mix-named")
    numbers = named.select(F.coalesce("source", F.lit("")).alias("name"), "known", "src")

    def numbered(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns({"name": F.coalesce("source", F.lit("")), "known": c("source").isNotNull()})
        if n_sources <= BROADCAST_ROWS:
            met = rows.join(F.broadcast(numbers), ["name", "known"])
        else:
            met = salted_join(rows, numbers, ["name", "known"], "inner")
        return met.drop("name", "known", "source")

    cells = materialise(numbered(cells), "mix-cells")
    state = materialise(balance(cells, source_targets(named.select("src", "source_size", "n_docs")), n_sources), "mix-rates")
    certain = (
        with_rates(_meet(cells, state, n_sources)).groupBy("src").agg(F.sum(c("n") * c("size") * c("whole")).alias("certain"))
    )
    need = state.join(certain, "src").select("src", F.greatest(F.lit(0), F.round("target").cast("long") - c("certain")).alias("left"))
    need = materialise(need, "mix-need")
    keyed = with_rates(_meet(numbered(narrow), state, n_sources)).withColumn("key", _key())
    keyed = materialise(keyed.select("doc_id", "src", "size", "source_size", "target", "whole", "key"), "mix-keys")
    items = keyed.filter("key IS NOT NULL").select("src", "key", "size")
    bounds = materialise(boundaries(items, need, n_sources), "mix-bounds")
    candidates = (
        _meet(items, bounds, n_sources)
        .filter((c("key") >= c("low")) & (c("key") < c("high")))
        .groupBy("src", "left", "key", "size")
        .agg(F.sum("size").alias("words"))
    )
    chosen = materialise(fill(candidates).withColumn("chosen", F.lit(1)), "mix-chosen")
    below = named.select("src").join(bounds.select("src", "low"), "src", "left")
    rows = _meet(keyed, below, n_sources).join(chosen, ["src", "key", "size"], "left")
    extra = F.when(c("key").isNull(), 0).when(c("key") < c("low"), 1).otherwise(F.coalesce("chosen", F.lit(0)))
    return rows.select("doc_id", "size", "source_size", "target", (c("size") * (c("whole") + extra)).cast("long").alias("taken"))
