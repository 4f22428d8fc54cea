"""Detectors of the irregular usage patterns and their scorecard."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drawdown.functions import as_date, avg_exact, from_units, month_number, month_of, ratio, round_half_up
from drawdown.model import OVERAGE_RATE, Tables
from drawdown.operators.contracts import accounts_with_overlap
from drawdown.operators.skew import by_month, salted_join
from drawdown.operators.usage import daily_totals, guarded_daily


def _monthly_credits(t: Tables) -> DataFrame:
    """Unguarded credits per account and month, via daily totals."""
    return (
        daily_totals(t.logs)
        .groupBy("account_id", month_of(F.col("date")).alias("usage_month"))
        .agg(
            F.sum("units").alias("units"),
            F.min("date").alias("first_day"),
            F.max("date").alias("last_day"),
            F.sum("log_count").alias("log_count"),
        )
    )


def spike_drop_accounts(
    t: Tables, spike_month: date | None = None, share: float = 0.80, rest: float = 100.0
) -> DataFrame:
    """Accounts whose first usage month (or a given one) holds nearly all their credits."""
    totals = _monthly_credits(t).groupBy("account_id").agg(*_spike_totals(spike_month))
    part, left = _spike_share()
    return totals.filter((part > share) & (left < rest)).select(
        "account_id",
        round_half_up(F.col("month_1"), 0).alias("month_1_credits"),
        round_half_up(left, 0).alias("remaining_credits"),
        round_half_up(part, 2).alias("month_1_share"),
    )


def _spike_totals(spike_month: date | None) -> list[Column]:
    """Credits of the spike month and of all months, from account-months."""
    if spike_month is None:
        # min_by over account-months: one bounded row per month and account.
        spike = F.min_by("units", "usage_month")
    else:
        spike = F.sum(
            F.when(F.col("usage_month") == as_date(spike_month), F.col("units")).otherwise(0)
        )
    return [from_units(spike).alias("month_1"), from_units(F.sum("units")).alias("total")]


def _spike_share() -> tuple[Column, Column]:
    """The spike month's part of all credits, and what is left of them."""
    return ratio(F.col("month_1"), F.col("total")), F.col("total") - F.col("month_1")


def _accounts_with_logs(t: Tables) -> DataFrame:
    return t.logs.select("account_id").distinct()


def shelfware_accounts(t: Tables) -> DataFrame:
    """Contracts of accounts that never logged usage."""
    quiet = t.accounts.join(_accounts_with_logs(t), "account_id", "left_anti")
    return salted_join(
        t.contracts, quiet.drop("employee_id"), ["account_id"], spread=["contract_id"]
    ).select(
        "account_id",
        "contract_id",
        "company_name",
        "industry",
        "annual_commit_dollars",
        "included_monthly_compute_credits",
    )


def consistent_overage(
    t: Tables, over: float = OVERAGE_RATE, majority: float = 0.5
) -> DataFrame:
    """Accounts over 120% of the largest covering allowance in half their months or more.

    A day counts once per contract covering it, as joining logs to contracts
    would. Contracts are first reduced to distinct spans and allowances per
    (account, start, end), and meet daily totals month by month.
    """
    spans = t.contracts.groupBy("account_id", "start_date", "end_date").agg(
        F.max("included_monthly_compute_credits").alias("allowance"),
        F.count(F.lit(1)).alias("copies"),
    )
    # Spread over months the spans are larger than they look to the optimiser.
    pieces = by_month(spans, "start_date", "end_date").hint("merge")
    daily = daily_totals(t.logs).withColumn("_month", month_number(F.col("date")))
    covered = daily.join(pieces, ["account_id", "_month"]).filter(
        F.col("date").between(F.col("start_date"), F.col("end_date"))
    )
    monthly = covered.groupBy("account_id", "_month").agg(
        from_units(F.sum(F.col("units") * F.col("copies"))).alias("credits"),
        F.max("allowance").alias("allowance"),
    )
    rate = ratio(F.col("credits"), F.col("allowance"))
    mean = avg_exact(rate, T.DecimalType(24, 12))
    return (
        monthly.groupBy("account_id")
        .agg(
            F.count(F.lit(1)).alias("active_months"),
            F.count_if(F.col("credits") > F.col("allowance") * over).alias("overage_months"),
            round_half_up(mean, 2).alias("avg_consumption_rate"),
        )
        .filter(F.col("overage_months") >= F.col("active_months") * majority)
    )


def orphan_profile(t: Tables) -> DataFrame:
    """Log count, first and last day and credits per unknown account."""
    per_account = (
        _monthly_credits(t)
        .groupBy("account_id")
        .agg(
            F.sum("log_count").alias("orphan_log_count"),
            F.min("first_day").alias("earliest_log"),
            F.max("last_day").alias("latest_log"),
            round_half_up(from_units(F.sum("units")), 0).alias("total_credits"),
        )
    )
    return per_account.join(t.accounts.select("account_id"), "account_id", "left_anti")


def _usage_counts(t: Tables, share: float = 0.80, rest: float = 100.0) -> DataFrame:
    """One row with the four counts that need logs, from two scans of them.

    Spikes, accounts without logs and orphaned logs come from one row per
    account; what is covered by a contract has its own, guarded scan.
    """
    used = (
        _monthly_credits(t)
        .groupBy("account_id")
        .agg(*_spike_totals(None), F.sum("log_count").alias("logs"))
    )
    known = t.accounts.groupBy(F.col("account_id").alias("_known")).agg(F.count(F.lit(1)).alias("rows"))
    part, left = _spike_share()
    unused, unknown = F.col("logs").isNull(), F.col("rows").isNull()
    covered = guarded_daily(t).agg(F.coalesce(F.sum("log_count"), F.lit(0))).scalar()

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    return used.join(known, F.col("account_id") == F.col("_known"), "full").agg(
        F.count_if((part > share) & (left < rest)).alias("spike_drop_accounts"),
        total(F.when(unused, F.col("rows"))).alias("shelfware_accounts"),
        total(F.when(unknown, F.col("logs"))).alias("orphaned_usage"),
        (total(F.when(~unknown, F.col("logs"))) - covered).alias("out_of_contract_usage"),
    )


def edge_case_scorecard(t: Tables, expected: dict[str, str] | None = None) -> DataFrame:
    """Counts of the five patterns next to what is expected of them."""
    labels = expected or {}

    def row(name: str, n: Column) -> Column:
        return F.struct(
            F.lit(name).alias("edge_case"), n.alias("count"), F.lit(labels.get(name, "any")).alias("expected")
        )

    usage = _usage_counts(t)
    rows = usage.select(F.inline(F.array(*[row(c, F.col(c)) for c in usage.columns])))
    overlap = row("accounts_with_overlap", F.count(F.lit(1)))
    return rows.unionByName(accounts_with_overlap(t.contracts).agg(overlap.alias("row")).select("row.*"))
