"""Quality rules whose cutoffs are certified on labelled documents.

A rule rejects a document when its score reaches the rule's cutoff in the document's stratum (its ``lang``). Labelled
documents are split by a hash of their id. One half proposes: it orders cutoffs by what they reject among bad and good
documents. The other half, the holdout, certifies: with n good documents of which k would be rejected, a cutoff passes when
P(Binomial(n, max_false) <= k) <= error / (strata * rules), that is when the exact (Clopper-Pearson) upper bound of its
false-rejection rate is at most `max_false`. The correction over strata and rules is Bonferroni's; within a stratum and rule
the cutoffs are tested from the mildest on and testing stops at the first that fails, which needs no further correction. So
with probability 1 - error no rule in use rejects more than `max_false` of the good documents of its stratum. A stratum with
too few labels certifies nothing and rejects nothing beyond the base rule.

Everything is DataFrame operations. Features are one narrow row per document and are written once; the labelled counts are
sums that are combined before the shuffle. Repeated five-word windows are found inside the row by sorting window hashes
(64 bits, within one document), so no word is ever shuffled.

Defined results: a null text has no words and fails the base rule; null `lang` is a stratum of its own; null labels and labels
of unknown documents are ignored; a document labelled twice is good only if all its labels say so; repeated documents are
judged each by itself; empty labels certify nothing. Extra columns play no part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drawdown.llm.common import BROADCAST_ROWS, NOT_BLANK, blank_words, let, whole
from drawdown.session import materialise

WINDOW = 5

#: The cutoffs tested, from mild to strict. They are chosen beforehand, not from the labels.
CUTOFFS = {
    "symbols": (0.3, 0.2, 0.1, 0.05, 0.02),
    "upper_case": (0.8, 0.5, 0.3, 0.2),
    "not_letters": (0.6, 0.5, 0.4, 0.3, 0.2),
    "repeated_lines": (0.7, 0.5, 0.3, 0.2),
    "repeated_windows": (0.2, 0.15, 0.1, 0.05),
    "repeated_words": (0.95, 0.9, 0.85, 0.8, 0.7),
    "long_words": (15.0, 12.0, 10.0, 9.0),
    "short_words": (-1.5, -2.0, -2.5, -3.0),
}


def _without(text: Column, kept: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def _covered(starts: Column) -> Column:
    """Words covered by windows that begin at these places, in ascending order."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("words"))

    def step(acc: Column, at: Column) -> Column:
        end = at + WINDOW
        return F.struct(end.alias("end"), (acc["words"] + end - F.greatest(acc["end"], at)).alias("words"))

    return F.aggregate(starts, zero, step, lambda acc: acc["words"])


def _repeat_words(hashes: Column) -> Column:
    """Words in five-word windows that stand at least twice, from the words' hashes."""

    def windows(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - WINDOW)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    def twice(w: Column) -> Column:
        placed = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))

        def starts(s: Column) -> Column:
            def beside(x: Column, i: Column) -> Column:
                here = x["h"]
                return F.when((F.get(s, i - 1)["h"] == here) | (F.get(s, i + 1)["h"] == here), x["at"])

            return F.sort_array(F.array_compact(F.transform(s, beside)))

        alike = F.size(F.array_distinct(w)) == F.size(w)
        return F.when(alike, 0).otherwise(let(placed, lambda s: _covered(starts(s))))

    found = let(hashes, lambda h: let(windows(h), twice))
    return F.when(F.size(hashes) > WINDOW, found).otherwise(0).cast("long")


def with_features(documents: DataFrame) -> DataFrame:
    """The documents with their base counts, `base_failed` and one score per rule."""
    taken = set(documents.columns)
    words = "_words" if "_words" not in taken else "_words_of_text"
    text = whole("text")
    df = documents.withColumn(words, blank_words(text))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_BLANK))
    counts = {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": _without(text, "#*$%&|<>"),
        "_lines": let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct"))),
        "_hashed": let(
            F.transform(words, lambda x: F.xxhash64(x)),
            lambda h: F.struct(_repeat_words(h).alias("repeat"), F.size(F.array_distinct(h)).alias("distinct")),
        ),
        "_upper": _without(text, r"\p{Lu}"),
        "_letters": _without(text, r"\p{L}"),
    }
    df = df.withColumns(counts).drop(words)
    n_words, chars, letters = F.col("n_words"), F.col("word_chars"), F.col("_letters")
    n_lines, repeat = F.col("_lines.n"), F.col("_hashed.repeat")
    over = lambda part, all_of: F.coalesce(F.try_divide(part, all_of), F.lit(0.0))
    mean = over(chars, n_words)
    scores = {
        "symbols": over(F.col("n_symbols"), chars),
        "upper_case": over(F.col("_upper"), letters),
        "not_letters": over(chars - letters, chars),
        "repeated_lines": over(n_lines - F.col("_lines.distinct"), n_lines),
        "repeated_windows": over(repeat, n_words),
        "repeated_words": over(n_words - F.col("_hashed.distinct"), n_words),
        "long_words": mean,
        "short_words": -mean,
    }
    return df.select(
        *[F.col(f"`{c}`") for c in documents.columns],
        "n_words",
        "word_chars",
        "n_symbols",
        (n_lines - F.col("_lines.distinct")).cast("long").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"),
        ((n_words < 10) | (100 * repeat > 20 * n_words)).alias("base_failed"),
        *[value.cast("double").alias(f"score_{rule}") for rule, value in scores.items()],
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("stratum"),
    )


def _log_factorial(n: Column) -> Column:
    """Stirling's series from 16 on, where its error is under 1e-14; exact below."""
    exact = F.array(*[F.lit(math.log(math.factorial(i))) for i in range(16)])
    small = F.element_at(exact, F.least(n, F.lit(15)).cast("int") + 1)
    x = F.greatest(n, F.lit(16)).cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(x * 6.283185307179586) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(n < 16, small).otherwise(series)


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k) for k < n, summed from the largest term down."""
    odds = (1 - p) / p
    top = F.exp(
        _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    )
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] * i.cast("double") / (n - i + 1).cast("double") * odds
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    down = F.when(k > 0, F.sequence(k, F.lit(1).cast("long"), F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return top * F.aggregate(down, start, step, lambda acc: acc["sum"])


def thresholds(features: DataFrame, labels: DataFrame, max_false: float = 0.01, error: float = 0.1) -> DataFrame:
    """stratum, rule, cutoff, n_good, n_false, p_value, certified, chosen of every cutoff tested."""
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter(F.col("quality").isNotNull())
    cells = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.lit(cut).alias("cutoff"), (F.col(f"score_{rule}") >= cut).alias("hit"))
            for rule, cuts in CUTOFFS.items()
            for cut in cuts
        ]
    )
    is_good, hit = F.col("quality") == 1, F.col("hit")
    held = F.pmod(F.crc32(F.concat(F.lit("holdout:"), F.col("doc_id").cast("string"))), F.lit(2)) == 0
    n = lambda cond: F.coalesce(F.sum(cond.cast("long")), F.lit(0)).cast("long")
    counted = (
        features.filter(~F.col("base_failed"))
        .join(good, "doc_id")
        .select("stratum", "quality", held.alias("held"), F.explode(cells).alias("cell"))
        .select("stratum", "quality", "held", "cell.*")
        .groupBy("stratum", "rule", "cutoff")
        .agg(
            n(is_good & F.col("held")).alias("n_good"),
            n(is_good & F.col("held") & hit).alias("n_false"),
            n(~is_good & ~F.col("held") & hit).alias("bad_hit"),
            n(is_good & ~F.col("held") & hit).alias("good_hit"),
        )
    )
    counted = materialise(counted, "quality-counts")
    strata = counted.select("stratum").distinct().count()
    level = error / max(1, strata * len(CUTOFFS))
    may = F.col("n_false") < F.col("n_good") * max_false
    tested = counted.withColumn(
        "p_value", F.when(may, binomial_cdf(F.col("n_false"), F.col("n_good"), max_false)).otherwise(1.0)
    )
    mild_first = Window.partitionBy("stratum", "rule").orderBy(F.desc("cutoff"))
    gain = F.col("bad_hit") - 20 * F.col("good_hit")
    certified = tested.withColumn("certified", F.min(F.col("p_value") <= level).over(mild_first)).withColumn(
        "gain", F.when(F.col("certified") & (gain > 0), gain)
    )
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc_nulls_last("gain"), F.desc("cutoff"))
    return certified.withColumn("chosen", (F.row_number().over(best) == 1) & F.col("gain").isNotNull()).drop("gain")


def judged(features: DataFrame, table: DataFrame) -> DataFrame:
    """The features with `kept`: not base_failed, and below every chosen cutoff of the stratum."""
    chosen = table.filter("chosen")
    strata = chosen.select("stratum").distinct().count()
    cuts = chosen.groupBy(F.col("stratum").alias("_stratum")).agg(
        *[F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"_cut_{rule}") for rule in CUTOFFS]
    )
    cuts = F.broadcast(cuts) if strata <= BROADCAST_ROWS else cuts
    rejected = F.lit(False)
    for rule in CUTOFFS:
        rejected = rejected | F.coalesce(F.col(f"score_{rule}") >= F.col(f"_cut_{rule}"), F.lit(False))
    return features.join(cuts, features["stratum"] == cuts["_stratum"], "left").withColumn(
        "kept", ~F.col("base_failed") & ~rejected
    )


def report(documents: DataFrame, labels: DataFrame, max_false: float = 0.01, error: float = 0.1) -> DataFrame:
    """doc_id, the base counts, base_failed and kept per document."""
    features = materialise(with_features(documents.select("doc_id", "text", "lang")).drop("text"), "quality-features")
    table = thresholds(features, labels, max_false, error)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged(features, table).select(*names)


def keep(documents: DataFrame, labels: DataFrame, max_false: float = 0.01, error: float = 0.1) -> DataFrame:
    """The documents that pass, with all their columns and no others."""
    scored = with_features(documents.select("doc_id", "text", "lang")).drop("text")
    table = materialise(thresholds(materialise(scored, "quality-features"), labels, max_false, error), "quality-cutoffs")
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    parts = documents.select(row, "doc_id", "text", "lang")
    return judged(with_features(parts), table).filter("kept").select("_row.*")
