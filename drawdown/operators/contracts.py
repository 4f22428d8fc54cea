"""Contracts: validity, what is active on a date, coverage and overlaps."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from drawdown.functions import as_date, month_number
from drawdown.operators.skew import SALTS, by_month, merged_intervals, salted_join


def valid_contracts(contracts: DataFrame) -> DataFrame:
    return contracts.filter(F.col("end_date") >= F.col("start_date"))


def active_at(contracts: DataFrame, as_of) -> DataFrame:
    """Valid contracts whose closed interval contains the date."""
    day = as_date(as_of)
    return valid_contracts(contracts).filter(
        (F.col("start_date") <= day) & (F.col("end_date") >= day)
    )


def at_dates(df: DataFrame, as_of: date | list[date], holds) -> DataFrame:
    """Rows that hold at a date, tagged ``as_of_date``; a list gives one copy per date.

    Several snapshots therefore share one scan. ``holds`` maps a date column to
    a condition.
    """
    if not isinstance(as_of, (list, tuple)):
        day = as_date(as_of)
        return df.filter(holds(day)).withColumn("as_of_date", day)
    days = F.array(*[as_date(d) for d in as_of])
    some = reduce(lambda a, b: a | b, [holds(as_date(d)) for d in as_of])
    tagged = df.filter(some).withColumn("as_of_date", F.explode(days))
    return tagged.filter(holds(F.col("as_of_date")))


def active_contracts(
    contracts: DataFrame, accounts: DataFrame, as_of: date | list[date]
) -> DataFrame:
    """One row per known account: totals of its active contracts and the earliest one.

    A single aggregation with map-side combining finds totals and the primary
    contract, so neither a window nor a self-join over an account's contracts
    is needed.
    """
    active = at_dates(
        valid_contracts(contracts),
        as_of,
        lambda day: (F.col("start_date") <= day) & (F.col("end_date") >= day),
    )
    primary = F.min_by(
        F.struct("contract_id", "owner_id", "start_date", "end_date", "contract_term_months"),
        F.struct("start_date", "contract_id"),
    )
    totals = active.groupBy("account_id", "as_of_date").agg(
        primary.alias("p"),
        F.sum("annual_commit_dollars").alias("annual_commit_dollars"),
        F.sum("included_monthly_compute_credits").alias("included_monthly_compute_credits"),
        F.count(F.lit(1)).alias("active_contract_count"),
    )
    return totals.join(accounts, "account_id").select(
        "account_id",
        "employee_id",
        F.col("p.owner_id").alias("signing_owner_id"),
        "company_name",
        "industry",
        F.col("p.contract_id").alias("primary_contract_id"),
        F.col("p.start_date").alias("contract_start_date"),
        F.col("p.end_date").alias("contract_end_date"),
        "annual_commit_dollars",
        F.col("p.contract_term_months").alias("contract_term_months"),
        "included_monthly_compute_credits",
        "active_contract_count",
        (F.col("active_contract_count") > 1).alias("has_expansion"),
        "as_of_date",
    )


def covered_spans(contracts: DataFrame) -> DataFrame:
    """Disjoint closed intervals under contract per account (few rows per account)."""
    return merged_intervals(
        contracts.select("account_id", "start_date", "end_date"),
        "account_id",
        "start_date",
        "end_date",
    )


def contract_months(
    contracts: DataFrame, accounts: DataFrame | None = None, before: date | None = None
) -> DataFrame:
    """Allowance and covered days per account and month number, over valid contracts.

    ``covered_days`` has bit d-1 set when day d of the month lies in at least one
    contract: the union of all intervals as one integer, combined map-side like
    the sum next to it (bits of days a month lacks may be set; no date asks for
    them). Contracts with the same dates are added up before they
    are spread over months. ``accounts`` clears it for accounts that do not
    exist, and an account that is there n times gets its rows n times; ``before``
    leaves out the month of that date and later ones.
    """
    valid = valid_contracts(contracts)
    last = month_number(F.col("end_date"))
    if before is not None:
        valid = valid.filter(F.col("start_date") < as_date(before.replace(day=1)))
        last = F.least(last, F.lit(before.year * 12 + before.month - 2))
    spans = valid.groupBy("account_id", "start_date", "end_date").agg(
        F.sum("included_monthly_compute_credits").alias("included_monthly_compute_credits")
    )
    copies = F.lit(1).cast("long")
    if accounts is not None:
        # Accounts look small enough to broadcast in their files, but not once they are read.
        # Spans meet them before they are spread, and their months stay where the join left them.
        known = accounts.groupBy("account_id").agg(F.count(F.lit(1)).alias("_copies"))
        spans = spans.join(known.hint("merge"), "account_id", "left")
        copies = F.col("_copies")
    # Bits from the first day on, and bits up to the last day, once per span.
    one = F.lit(1).cast("long")
    months = spans.select(
        "account_id",
        "included_monthly_compute_credits",
        copies.alias("_copies"),
        month_number(F.col("start_date")).alias("_first"),
        month_number(F.col("end_date")).alias("_last"),
        (-F.call_function("shiftleft", one, F.dayofmonth("start_date") - 1)).alias("_since"),
        (F.call_function("shiftleft", one, F.dayofmonth("end_date")) - 1).alias("_until"),
        F.explode(F.sequence(month_number(F.col("start_date")), last)).alias("_month"),
    )
    every = F.lit((1 << 31) - 1)
    since = F.when(F.col("_month") == F.col("_first"), F.col("_since")).otherwise(every)
    until = F.when(F.col("_month") == F.col("_last"), F.col("_until")).otherwise(every)
    days = since.bitwiseAND(until).bitwiseAND(every)
    grid = months.groupBy("account_id", "_month").agg(
        F.sum("included_monthly_compute_credits").alias("included_monthly_compute_credits"),
        F.bit_or(days).alias("covered_days"),
        F.max("_copies").alias("_copies"),
    )
    if accounts is None:
        return grid.drop("_copies")
    covered = F.when(F.col("_copies").isNotNull(), F.col("covered_days")).otherwise(F.lit(0))
    times = F.coalesce(F.col("_copies"), F.lit(1)).cast("int")
    return (
        grid.withColumn("covered_days", covered)
        .withColumn("_copies", F.explode(F.array_repeat(F.lit(1), times)))
        .drop("_copies")
    )


def is_covered(day: Column, covered_days: Column) -> Column:
    """Whether a day is one of its month's covered days."""
    return F.call_function("getbit", covered_days, F.dayofmonth(day) - 1) == 1


def contract_types(contracts: DataFrame) -> DataFrame:
    """Label contracts base, expansion or renewal by their order within the account.

    The first is base; a later one that begins while an earlier one still runs
    is an expansion, any other a renewal. Earlier contracts are summarised per
    start day first, so the window is bounded by the calendar.
    """
    valid_id = F.when(F.col("end_date") >= F.col("start_date"), F.col("contract_id"))
    days = contracts.groupBy("account_id", "start_date").agg(
        F.min("contract_id").alias("_first_id"),
        F.min(valid_id).alias("_first_valid_id"),
        F.max("end_date").alias("_last_end"),
    )
    order = W.partitionBy("account_id").orderBy("start_date")
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    days = days.select(
        F.col("account_id").alias("_acct"),
        F.col("start_date").alias("_start"),
        "_first_id",
        "_first_valid_id",
        F.max("_last_end").over(earlier).alias("_reach"),
        (F.row_number().over(order) == 1).alias("_opening_day"),
    )
    # NULL account ids keep their contracts, hence the null-safe match.
    joined = contracts.join(
        days,
        F.col("account_id").eqNullSafe(F.col("_acct"))
        & F.col("start_date").eqNullSafe(F.col("_start")),
    )
    kind = (
        F.when(F.col("_opening_day") & (F.col("contract_id") == F.col("_first_id")), "base")
        .when(
            (F.col("_reach") >= F.col("start_date"))
            | (F.col("_first_valid_id") < F.col("contract_id")),
            "expansion",
        )
        .otherwise("renewal")
    )
    return joined.select(*contracts.columns, kind.alias("contract_type"))


def _sided(df: DataFrame, side: int) -> DataFrame:
    return df.select(
        "account_id",
        F.col("contract_id").alias(f"contract_{side}"),
        F.col("start_date").alias(f"c{side}_start"),
        F.col("end_date").alias(f"c{side}_end"),
        F.col("annual_commit_dollars").alias(f"c{side}_commit"),
    )


def overlapping_pairs(contracts: DataFrame, salts: int = SALTS) -> DataFrame:
    """Contracts of one account whose intervals overlap, each pair once.

    The pair is found where the later start falls into the other interval
    (which is therefore well formed; the later one need not be), so candidates are almost exactly the result: contracts spread over the months
    they run meet contracts that start in that month. The work follows the size
    of the answer; ``overlap_profile`` answers how many without listing them.
    """
    # Spread over months a side is larger than it looks to the optimiser.
    running = by_month(_sided(contracts, 1), "c1_start", "c1_end").hint("merge")
    starting = _sided(contracts, 2).withColumn("_month", month_number(F.col("c2_start")))
    later = (F.col("c2_start") > F.col("c1_start")) | (
        (F.col("c2_start") == F.col("c1_start")) & (F.col("contract_2") > F.col("contract_1"))
    )
    touch = (F.col("c2_start") <= F.col("c1_end")) & (F.col("c2_end") >= F.col("c1_start"))
    found = salted_join(
        running, starting, ["account_id", "_month"], spread=["contract_1"], salts=salts
    ).filter(later & touch)
    swap = F.col("contract_1") > F.col("contract_2")

    def pick(a: str, b: str) -> Column:
        return F.when(swap, F.col(b)).otherwise(F.col(a))

    return found.select(
        "account_id",
        pick("contract_1", "contract_2").alias("contract_1"),
        pick("c1_start", "c2_start").alias("c1_start"),
        pick("c1_end", "c2_end").alias("c1_end"),
        pick("c1_commit", "c2_commit").alias("c1_commit"),
        pick("contract_2", "contract_1").alias("contract_2"),
        pick("c2_start", "c1_start").alias("c2_start"),
        pick("c2_end", "c1_end").alias("c2_end"),
        pick("c2_commit", "c1_commit").alias("c2_commit"),
    )


def overlap_profile(contracts: DataFrame) -> DataFrame:
    """Per valid contract, how many valid contracts of the account overlap it.

    Counted without forming pairs: all that start by my end, minus those that
    ended before my start, minus myself. Running counts are kept per account
    and day, so the window is bounded by the calendar.
    """
    valid = valid_contracts(contracts).select(
        "account_id", "contract_id", "start_date", "end_date"
    )
    marks = (
        valid.select(
            "account_id",
            F.explode(
                F.array(
                    F.struct(F.col("start_date").alias("day"), F.lit(1).alias("s"), F.lit(0).alias("e")),
                    F.struct(F.col("end_date").alias("day"), F.lit(0).alias("s"), F.lit(1).alias("e")),
                )
            ).alias("m"),
        )
        .groupBy("account_id", F.col("m.day").alias("_day"))
        .agg(F.sum("m.s").alias("_s"), F.sum("m.e").alias("_e"))
    )
    upto = W.partitionBy("account_id").orderBy("_day").rowsBetween(W.unboundedPreceding, 0)
    running = marks.select(
        "account_id",
        "_day",
        F.sum("_s").over(upto).alias("_started"),
        (F.sum("_e").over(upto) - F.col("_e")).alias("_ended_before"),
    )
    by_end = running.select(
        "account_id", F.col("_day").alias("end_date"), F.col("_started").alias("_started_by_end")
    )
    by_start = running.select("account_id", F.col("_day").alias("start_date"), "_ended_before")
    return (
        valid.join(by_end, ["account_id", "end_date"])
        .join(by_start, ["account_id", "start_date"])
        .select(
            "account_id",
            "contract_id",
            "start_date",
            "end_date",
            (F.col("_started_by_end") - F.col("_ended_before") - 1).alias("overlapping_contracts"),
        )
    )


def accounts_with_overlap(contracts: DataFrame) -> DataFrame:
    """Accounts that own at least one overlapping pair, without forming pairs.

    A well-formed contract overlaps an earlier one that reaches its start. A
    malformed one (end before start) needs an earlier one that began by its end
    and reaches its start. Both are read off one running maximum per account
    and day.
    """
    good = F.col("end_date") >= F.col("start_date")
    days = (
        contracts.withColumn("_day", F.when(good, F.col("start_date")).otherwise(F.col("end_date")))
        .groupBy("account_id", "_day")
        .agg(
            F.max(F.when(good, F.col("end_date"))).alias("_end"),
            F.count_if(good).alias("_good"),
            F.min(F.when(~good, F.col("start_date"))).alias("_need"),
        )
    )
    order = W.partitionBy("account_id").orderBy("_day")
    days = days.withColumn("_reach", F.max("_end").over(order.rowsBetween(W.unboundedPreceding, -1)))
    hit = (
        (F.col("_good") > 1)
        | ((F.col("_good") > 0) & (F.col("_reach") >= F.col("_day")))
        | (F.greatest("_reach", "_end") >= F.col("_need"))
    )
    return days.filter(hit & F.col("account_id").isNotNull()).select("account_id").distinct()


def owner_history(contracts: DataFrame) -> DataFrame:
    """Ownership periods implied by signings: the latest signer owns the account."""
    signings = (
        contracts.groupBy("account_id", "start_date")
        .agg(F.max_by("owner_id", "contract_id").alias("employee_id"))
    )
    order = W.partitionBy("account_id").orderBy("start_date")
    return signings.select(
        "account_id",
        "employee_id",
        F.col("start_date").alias("effective_from"),
        F.date_sub(F.lead("start_date").over(order), 1).alias("effective_to"),
    )


def owner_as_of(events: DataFrame, history: DataFrame, day: str) -> DataFrame:
    """Attach the owner valid on each row's day; an open period has no end.

    Closed periods are cut into months, so that the join has an equi key finer than the account; an account has at most one open
    period, which joins by account. Rows on days nobody owned keep a NULL owner.
    """
    closed = history.filter(F.col("effective_to").isNotNull())
    # Spread over months the periods are larger than they look to the optimiser.
    periods = by_month(closed, "effective_from", "effective_to").hint("merge").select(
        F.col("account_id").alias("_acct"),
        "_month",
        F.col("employee_id").alias("_closed_owner"),
        F.col("effective_from").alias("_from"),
        F.col("effective_to").alias("_until"),
    )
    latest = history.filter(F.col("effective_to").isNull()).select(
        F.col("account_id").alias("_open_acct"),
        F.col("employee_id").alias("_open_owner"),
        F.col("effective_from").alias("_open_from"),
    )
    rows = events.withColumn("_row_month", month_number(F.col(day)))
    match = (
        (F.col("account_id") == F.col("_acct"))
        & (F.col("_row_month") == F.col("_month"))
        & F.col(day).between(F.col("_from"), F.col("_until"))
    )
    still = (F.col("account_id") == F.col("_open_acct")) & (F.col(day) >= F.col("_open_from"))
    owner = F.coalesce("_closed_owner", "_open_owner").alias("owner_id")
    return rows.join(periods, match, "left").join(latest, still, "left").select(*events.columns, owner)
