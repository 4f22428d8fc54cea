"""Joins and rankings that keep every task bounded when one key is hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from drawdown.functions.exprs import month_number

SALTS = 16


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    spread: list[str] | None = None,
    salts: int = SALTS,
    residual: Column | None = None,
) -> DataFrame:
    """Equi-join whose row-grain side is split into ``salts`` parts per key.

    ``spread`` names columns of ``big`` that differ between the rows of one key.
    ``small`` has few rows per key and is repeated once per part, so a key that
    holds a third of ``big`` is shared by that many tasks. Only join types that
    keep or drop rows of ``big`` are meaningful (inner, left, semi, anti). The
    optimiser counts neither the copies nor what files unpack to, and would
    broadcast them all for a side below its threshold; the hint rules that out.
    """
    part = F.pmod(F.xxhash64(*(spread or big.columns)), F.lit(salts)).cast("int")
    left = big.withColumn("_part", part)
    right = small.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    keys = [*on, "_part"]
    if residual is None:
        return left.join(right, keys, how).drop("_part")
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns]
    )
    match = residual
    for key in keys:
        match = match & (F.col(key) == F.col(f"_r_{key}"))
    joined = left.join(renamed, match, how)
    return joined.drop("_part", *[f"_r_{k}" for k in keys])


def by_month(df: DataFrame, start: str, end: str, month: str = "_month") -> DataFrame:
    """One row per calendar month (as a month number) a closed date interval touches."""
    months = F.sequence(month_number(F.col(start)), month_number(F.col(end)))
    return df.filter(F.col(end) >= F.col(start)).withColumn(month, F.explode(months))


def merged_intervals(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Disjoint union of closed date intervals per key.

    Intervals are first reduced to one per (key, start) with map-side
    combining, so the window sees at most one row per calendar day and key no
    matter how many intervals a key owns.
    """
    longest = (
        df.filter(F.col(end) >= F.col(start))
        .groupBy(key, start)
        .agg(F.max(end).alias(end))
    )
    order = W.partitionBy(key).orderBy(start)
    reach = F.max(end).over(order.rowsBetween(W.unboundedPreceding, -1))
    opens = F.when(F.col(start) <= F.date_add(F.col("_reach"), 1), 0).otherwise(1)
    return (
        longest.withColumn("_reach", reach)
        .withColumn("_opens", opens)
        .withColumn("_island", F.sum("_opens").over(order))
        .groupBy(key, "_island")
        .agg(F.min(start).alias(start), F.max(end).alias(end))
        .drop("_island")
    )


def _magnitude_bucket(cents: Column) -> Column:
    """Order-preserving bucket of an integer: sign, digit count, four leading digits.

    Needs no look at the data. A bucket spans one ten-thousandth of its decade,
    so the number of distinct values inside it is bounded by its width.
    """
    size = F.abs(cents)
    digits = F.length(size.cast("string"))
    lead = F.rpad(size.cast("string"), 4, "0").substr(1, 4).cast("int")
    code = digits * 10000 + lead
    return F.when(cents < 0, -code).when(cents == 0, 0).otherwise(code)


def competition_ranks(rows: DataFrame, value: str, ranks: dict[str, list[str]]) -> DataFrame:
    """``RANK() OVER (PARTITION BY keys ORDER BY value DESC NULLS LAST)`` per named rank.

    A plain window would pull all rows of a partition (for an org-wide rank:
    all rows) into one task. Here equal values are counted first, ranked inside
    narrow value buckets, and shifted by the row counts of higher buckets.
    ``rows`` is read once for the counts and once for each result, so a costly
    one should be materialised first.
    """
    cents = F.round(F.col(value).cast("decimal(24,2)") * 100, 0).cast("long")
    out = rows.withColumn("_cents", cents)
    every = sorted({k for keys in ranks.values() for k in keys})
    fine = out.groupBy(*every, "_cents").agg(F.count(F.lit(1)).alias("_n"))
    for name, keys in ranks.items():
        counts = fine if set(keys) == set(every) else fine.groupBy(*keys, "_cents").agg(
            F.sum("_n").alias("_n")
        )
        match = [*keys, "_cents"]
        out = out.join(_null_safe(_ranked_values(counts, keys, name), match), _null_match(match))
        out = out.drop(*[f"_k_{k}" for k in match])
    return out.drop("_cents")


def _ranked_values(counts: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rank of each distinct value from the row counts of all values."""
    counts = counts.withColumn("_bucket", _magnitude_bucket(F.col("_cents")))
    above = W.partitionBy(*keys).orderBy(F.col("_bucket").desc_nulls_last())
    buckets = (
        counts.groupBy(*keys, "_bucket")
        .agg(F.sum("_n").alias("_n"))
        .withColumn("_above", F.sum("_n").over(above.rowsBetween(W.unboundedPreceding, -1)))
        .drop("_n")
    )
    inside = W.partitionBy(*keys, "_bucket").orderBy(F.col("_cents").desc_nulls_last())
    match = [*keys, "_bucket"]
    ranked = counts.withColumn(
        "_before", F.sum("_n").over(inside.rowsBetween(W.unboundedPreceding, -1))
    ).join(_null_safe(buckets, match), _null_match(match))
    position = F.coalesce("_before", F.lit(0)) + F.coalesce("_above", F.lit(0)) + 1
    return ranked.select(*keys, "_cents", position.cast("long").alias(name))


def _null_safe(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"_k_{c}") if c in keys else F.col(c) for c in df.columns])


def _null_match(keys: list[str]) -> Column:
    match = F.lit(True)
    for key in keys:
        match = match & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    return match


def split_points(df: DataFrame, column: str, parts: int = 64) -> list:
    """At most ``parts`` ordered cut values from a bounded sample of a column."""
    sample = (
        df.select(column)
        .filter(F.col(column).isNotNull())
        .orderBy(F.xxhash64(column))
        .limit(parts * 16)
        .orderBy(column)
        .collect()
    )
    values = [row[0] for row in sample]
    step = max(1, len(values) // parts)
    return sorted(set(values[step::step]))


def ordinal(df: DataFrame, bucket: list[str], order: str, out: str) -> DataFrame:
    """``ROW_NUMBER`` per bucket in the order of a unique column, in bounded tasks.

    The order column is cut at sampled values held in the plan as literals, so
    the numbering is exact whatever the sample looks like; only the balance of
    the tasks depends on it.
    """
    cuts = [F.lit(v) for v in split_points(df, order)]
    part = F.lit(0)
    if cuts:
        part = F.size(F.filter(F.array(*cuts), lambda cut: cut <= F.col(order)))
    tagged = df.withColumn("_slice", part)
    before = W.partitionBy(*bucket).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy(*bucket, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = W.partitionBy(*bucket, "_slice").orderBy(order)
    return (
        tagged.withColumn("_rn", F.row_number().over(inside))
        .join(offsets, [*bucket, "_slice"])
        .withColumn(out, (F.col("_rn") + F.col("_offset")).cast("long"))
        .drop("_slice", "_rn", "_offset")
    )
