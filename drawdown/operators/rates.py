"""Trailing and rolling consumption rates, streaks and drops."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from drawdown.functions import (
    as_date,
    avg_exact,
    from_units,
    month_of,
    ratio,
    round_half_up,
    to_units,
    true_if,
)
from drawdown.model import OVERAGE_RATE, RAMP_DAYS, TRAILING_MONTHS, Tables
from drawdown.operators.contracts import active_contracts, at_dates
from drawdown.operators.usage import active_daily_usage, daily_consumption


def _recent_first(monthly: DataFrame, as_of, cutoff: str | None) -> DataFrame:
    """Months per account and snapshot date, ranked from the newest.

    One row per account and month comes in, so each window group is bounded by
    the calendar.
    """
    if cutoff is None:
        tagged = at_dates(monthly, as_of, lambda day: F.lit(True))
    else:
        tagged = at_dates(monthly, as_of, lambda day: F.col("usage_month") < month_of(day))
    newest = W.partitionBy("account_id", "as_of_date").orderBy(F.col("usage_month").desc())
    return tagged.withColumn("month_rank", F.row_number().over(newest))


def trailing_stats(
    monthly: DataFrame,
    as_of: date | list[date],
    k: int = TRAILING_MONTHS,
    overage: float = OVERAGE_RATE,
    cutoff: str | None = "complete_months",
) -> DataFrame:
    """Statistics of the last ``k`` months per account, plus the 1- and 2-month means.

    ``cutoff="complete_months"`` looks only at months that ended before as-of;
    ``None`` ranks every month of the contract grid, future ones included.
    ``peak_rate`` is the highest uncapped rate of all months considered.
    """
    rate = F.col("consumption_rate")
    recent = F.col("month_rank") <= k
    uncapped = ratio(F.col("credits_consumed"), F.col("included_monthly_compute_credits"))

    def last(n: int):
        return avg_exact(F.when(F.col("month_rank") <= n, rate))

    return (
        _recent_first(monthly, as_of, cutoff)
        .groupBy("account_id", "as_of_date")
        .agg(
            last(k).alias("trailing_90d_avg_rate"),
            last(2).alias("trailing_30d_avg_rate"),
            last(1).alias("trailing_7d_avg_rate"),
            F.count_if(recent).alias("months_of_data"),
            F.max(F.when(recent, rate)).alias("max_monthly_rate"),
            F.min(F.when(recent, rate)).alias("min_monthly_rate"),
            F.count_if(recent & (rate > overage)).alias("overage_months"),
            F.count_if(recent & F.col("is_zero_usage_month")).alias("zero_usage_months"),
            F.max(uncapped).alias("peak_rate"),
        )
    )


def yoy_rate(monthly: DataFrame, as_of: date) -> DataFrame:
    """Trailing twelve-month mean rate."""
    return trailing_stats(monthly, as_of, k=12).select(
        "account_id",
        round_half_up(F.col("trailing_90d_avg_rate"), 6).alias("trailing_12m_avg_rate"),
        F.col("months_of_data").alias("months_in_window"),
    )


def expansion_consecutive(
    monthly: DataFrame, as_of: date, overage: float = OVERAGE_RATE, k: int = TRAILING_MONTHS
) -> DataFrame:
    """Accounts with two calendar-adjacent overage months among the trailing ``k``."""
    order = W.partitionBy("account_id").orderBy("usage_month")
    over = F.col("consumption_rate") > overage
    adjacent = F.add_months(F.lag("usage_month").over(order), 1) == F.col("usage_month")
    pair = true_if(over & F.lag(over).over(order) & adjacent)
    return (
        _recent_first(monthly, as_of, "complete_months")
        .filter(F.col("month_rank") <= k)
        .withColumn("_pair", pair)
        .groupBy("account_id")
        .agg(
            F.count_if(over).alias("overage_months"),
            F.bool_or("_pair").alias("expansion_consecutive"),
        )
    )


def spike_drop(monthly: DataFrame, as_of: date) -> DataFrame:
    """High historical peak, near-zero now; ``is_spike_drop`` keeps the capped formula."""
    stats = trailing_stats(monthly, as_of)
    low = F.col("trailing_90d_avg_rate") < 0.05
    return stats.select(
        "account_id",
        round_half_up(F.col("peak_rate"), 6).alias("peak_rate"),
        round_half_up(F.col("trailing_90d_avg_rate"), 6).alias("trailing_90d_avg_rate"),
        true_if((F.col("max_monthly_rate") > 2.0) & low).alias("is_spike_drop"),
        true_if((F.col("peak_rate") > 2.0) & low).alias("is_spike_drop_hist"),
    )


def rolling_rates(t: Tables, as_of: date, windows: tuple[int, ...] = (7, 30, 90)) -> DataFrame:
    """Credits over the last W days against the allowance prorated to W days.

    For one date this is a single conditional aggregation over sparse usage.
    """
    sparse = active_daily_usage(t, as_of, days_back=max(windows))
    allowance = F.col("included_monthly_compute_credits")
    sums = [
        F.coalesce(
            from_units(
                F.sum(F.when(F.col("date") > F.date_sub(as_date(as_of), w), F.col("units")))
            ),
            F.lit(0.0),
        ).alias(f"credits_{w}d")
        for w in windows
    ]
    totals = sparse.groupBy("account_id", "included_monthly_compute_credits").agg(*sums)
    return totals.select(
        "account_id",
        *[f"credits_{w}d" for w in windows],
        *[
            ratio(F.col(f"credits_{w}d"), allowance * F.lit(w) / F.lit(30.0)).alias(f"rate_{w}d")
            for w in windows
        ],
    )


def rolling_rates_since(t: Tables, as_of: date, since: date, windows: tuple[int, ...] = (7, 30, 90)) -> DataFrame:
    """Rolling rates of the days from ``since`` to as-of.

    The daily grain, and the logs read for it, begin one longest window before
    ``since``, so the cost follows the days asked for and not the contracts.
    """
    daily = daily_consumption(t, as_of, since=since - timedelta(days=max(windows) - 1))
    return rolling_rates_daily(daily, windows).filter(F.col("date") >= as_date(since))


def rolling_rates_daily(daily: DataFrame, windows: tuple[int, ...] = (7, 30, 90)) -> DataFrame:
    """Rolling rates for every day of the (gapless) daily grain.

    A window of W days is the difference of two running totals W rows apart, so
    the cost per row does not grow with W. A window group is one account's
    contract days, bounded by the calendar.
    """
    order = W.partitionBy("account_id").orderBy("date")
    allowance = F.col("included_monthly_compute_credits")
    running = F.sum(to_units(F.col("daily_credits_consumed"))).over(
        order.rowsBetween(W.unboundedPreceding, 0)
    )
    totals = daily.withColumn("_running", running)
    rates = []
    for w in windows:
        total = F.col("_running") - F.coalesce(F.lag("_running", w).over(order), F.lit(0))
        share = allowance * F.lit(w) / F.lit(30.0)
        rates.append(ratio(from_units(total), share).alias(f"rate_{w}d"))
    return totals.select("account_id", "date", *rates)


def early_shelfware_streak(t: Tables, as_of: date, below: float = 0.05, days: int = 30) -> DataFrame:
    """Length of the run of days under ``below`` that ends at as-of.

    A run ends at the last day at or above the threshold, so the newest such
    day gives its length without materialising quiet days.
    """
    allowance = F.col("included_monthly_compute_credits") / F.lit(30.0)
    busy = ratio(from_units(F.col("units")), allowance) >= below
    since = F.coalesce(
        F.date_add(F.max(F.when(busy, F.col("date"))), 1), F.col("contract_start_date")
    )
    known = F.col("included_monthly_compute_credits") != 0
    length = F.when(known, F.datediff(as_date(as_of), F.col("streak_start")) + 1).otherwise(0)
    return (
        active_daily_usage(t, as_of)
        .groupBy("account_id", "contract_start_date", "included_monthly_compute_credits")
        .agg(since.alias("streak_start"))
        .select(
            "account_id",
            F.when(known & (length > 0), F.col("streak_start")).alias("streak_start"),
            length.cast("long").alias("streak_days"),
            (length >= days).alias("early_shelfware_flag"),
        )
    )


def _blocks(t: Tables, as_of: date, length: int, ramping_only: bool = False) -> DataFrame:
    """Zero-filled blocks of ``length`` days counted back from as-of, per active account.

    Block 0 is the newest; only blocks that lie wholly inside the contract
    exist. The rate is credits over the prorated allowance.
    """
    active = active_contracts(t.contracts, t.accounts, as_of)
    if ramping_only:
        active = active.filter(
            F.col("contract_start_date") >= F.date_sub(as_date(as_of), RAMP_DAYS)
        )
    active = active.select(
        "account_id", "contract_start_date", "included_monthly_compute_credits"
    )
    whole = F.floor((F.datediff(as_date(as_of), F.col("contract_start_date")) + 1) / length)
    grid = active.filter(whole > 0).withColumn(
        "block", F.explode(F.sequence(F.lit(0), (whole - 1).cast("int")))
    )
    # A ramping account's days all lie in the ramp, so only those leave the log scan.
    sparse = active_daily_usage(t, as_of, days_back=RAMP_DAYS + 1 if ramping_only else None)
    used = (
        sparse.join(active.select("account_id"), "account_id", "left_semi")
        .filter(F.col("date").isNotNull())
        .withColumn("block", F.floor(F.datediff(as_date(as_of), F.col("date")) / length).cast("int"))
        .groupBy("account_id", "block")
        .agg(F.sum("units").alias("units"))
    )
    share = F.col("included_monthly_compute_credits") * F.lit(length) / F.lit(30.0)
    return grid.join(used, ["account_id", "block"], "left").select(
        "account_id",
        "block",
        ratio(F.coalesce(from_units(F.col("units")), F.lit(0.0)), share).alias("rate"),
    )


def onboarding_stall(t: Tables, as_of: date, flat: float = 0.02, pairs: int = 2) -> DataFrame:
    """Ramping accounts whose weekly rate stayed flat for ``pairs`` consecutive week pairs."""
    order = W.partitionBy("account_id").orderBy(F.col("block").desc())
    change = F.col("rate") - F.lag("rate").over(order)
    steps = _blocks(t, as_of, 7, ramping_only=True).withColumn("_change", change)
    is_flat = true_if(F.abs("_change") < flat)
    # A run of flat pairs shares the count of non-flat weeks before it.
    run = F.sum(F.when(is_flat, 0).otherwise(1)).over(order)
    runs = (
        steps.withColumn("_flat", is_flat)
        .withColumn("_run", run)
        .groupBy("account_id", "_run")
        .agg(F.count_if("_flat").alias("_length"), F.count(F.lit(1)).alias("_weeks"))
    )
    return runs.groupBy("account_id").agg(
        F.sum("_weeks").alias("weeks"),
        F.max("_length").alias("longest_flat_run"),
        (F.max("_length") >= pairs).alias("onboarding_stall_flag"),
    )


def mom_drop(t: Tables, as_of: date, drop: float = 0.40) -> DataFrame:
    """Largest and latest decline between neighbouring 30-day rates."""
    order = W.partitionBy("account_id").orderBy(F.col("block").desc())
    prior = F.lag("rate").over(order)
    decline = F.try_divide(prior - F.col("rate"), F.nullif(prior, F.lit(0.0)))
    return (
        _blocks(t, as_of, 30)
        .withColumn("_decline", decline)
        .groupBy("account_id")
        .agg(
            F.count(F.lit(1)).alias("periods"),
            round_half_up(F.max(F.when(F.col("block") == 0, F.col("_decline"))), 6).alias(
                "latest_decline"
            ),
            round_half_up(F.max("_decline"), 6).alias("largest_decline"),
            true_if(F.bool_or(F.col("_decline") > drop)).alias("spike_drop_early_flag"),
        )
    )


def zero_streak(monthly: DataFrame, as_of: date, months: int = 2) -> DataFrame:
    """Longest and current run of calendar-adjacent zero-usage months before as-of."""
    cut = month_of(as_date(as_of))
    number = F.year("usage_month") * 12 + F.month("usage_month")
    order = W.partitionBy("account_id").orderBy("usage_month")
    zero = (
        monthly.filter(F.col("is_zero_usage_month") & (F.col("usage_month") < cut))
        .withColumn("_island", number - F.row_number().over(order))
        .groupBy("account_id", "_island")
        .agg(F.count(F.lit(1)).alias("_length"), F.max("usage_month").alias("_last"))
    )
    current = F.max(F.when(F.add_months("_last", 1) == cut, F.col("_length")))
    return zero.groupBy("account_id").agg(
        F.max("_length").alias("longest_zero_streak"),
        F.coalesce(current, F.lit(0)).alias("current_zero_streak"),
        (F.max("_length") >= months).alias("outreach_flag"),
    )
