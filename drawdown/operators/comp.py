"""Compensation formulas applied to every contract."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from drawdown.functions import (
    avg_exact,
    month_number,
    null_greatest,
    null_least,
    ratio,
    round_half_up,
)
from drawdown.model import Tables
from drawdown.operators.contracts import valid_contracts
from drawdown.operators.usage import monthly_consumption


@dataclass(frozen=True)
class CompPlan:
    """Quotas, weights and term multipliers (fixed values of the plan)."""

    ae_quota: float = 1000000.0
    ae_bookings_weight: float = 0.70
    ae_consumption_weight: float = 0.30
    am_quota: float = 800000.0
    am_bookings_weight: float = 0.30
    am_consumption_weight: float = 0.70
    multipliers: dict[int, float] = field(
        default_factory=lambda: {1: 1.00, 2: 1.20, 3: 1.35, 5: 1.50}
    )
    renewal_term_years: int = 1

    def multiplier(self, years: Column) -> Column:
        """NULL for a term the plan does not list."""
        chain = None
        for term, value in self.multipliers.items():
            hit = years == term
            chain = F.when(hit, value) if chain is None else chain.when(hit, value)
        return chain


PLAN = CompPlan()


def _years() -> Column:
    return F.col("contract_term_months") / F.lit(12.0)


def _last_year() -> Column:
    """Number of contract years begun."""
    return F.ceil(F.col("contract_term_months") / F.lit(12.0)).cast("int")


def _cents(value: Column) -> Column:
    return round_half_up(value, 2)


def _money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def deal_economics(contracts: DataFrame, plan: CompPlan = PLAN) -> DataFrame:
    """Total contract value and quota credit under the three approaches.

    Part years count by their months; a term that the plan does not list has no multiplier.
    """
    acv = F.col("annual_commit_dollars")
    return valid_contracts(contracts).withColumn("term_years", _years()).select(
        "contract_id",
        "owner_id",
        "term_years",
        acv.alias("acv"),
        _cents(acv * F.col("contract_term_months") / 12.0).alias("tcv"),
        acv.cast("double").alias("credit_none"),
        _cents(acv * plan.multiplier(F.col("term_years"))).alias("credit_multiplier"),
        _cents(acv * F.col("contract_term_months") / 12.0).alias("credit_full_tcv"),
    )


_APPROACHES = ("none", "multiplier", "full_tcv")


def bookings_attainment(contracts: DataFrame, plan: CompPlan = PLAN) -> DataFrame:
    """Credit of a rep's signed deals over the bookings quota, per approach."""
    quota = F.lit(plan.ae_quota * plan.ae_bookings_weight)
    credits = deal_economics(contracts, plan).groupBy("owner_id").agg(
        F.count(F.lit(1)).alias("deals"),
        *[F.sum(_money(F.col(f"credit_{a}"))).alias(f"c_{a}") for a in _APPROACHES],
    )
    return credits.select(
        F.col("owner_id").alias("employee_id"),
        "deals",
        *[
            round_half_up(ratio(F.col(f"c_{a}"), quota), 4).alias(f"attainment_{a}")
            for a in _APPROACHES
        ],
    )


def contract_year_rates(t: Tables, as_of: date) -> DataFrame:
    """Mean account rate in each contract year, NULL before its first complete month.

    A contract year's mean depends only on the account and the month the year
    opens, so means are taken once per (account, opening month), however many
    contracts share it, and then attached to the contracts.
    """
    before = as_of.replace(day=1)
    rates = monthly_consumption(t, before=before).select(
        "account_id", month_number(F.col("usage_month")).alias("_month"), "consumption_rate"
    )
    terms = valid_contracts(t.contracts).select(
        "contract_id", "account_id", "owner_id", "start_date", "annual_commit_dollars",
        _years().alias("term_years"), _last_year().alias("last_year"), "contract_term_months",
    ).filter(F.col("last_year") >= 1)
    # The last year of a contract covers the months that are left of its term.
    start = month_number(F.col("start_date"))
    opening = start + (F.col("year") - 1) * 12
    ending = F.least(opening + 11, start + F.col("contract_term_months") - 1).cast("int")
    years = (
        terms.withColumn("year", F.explode(F.sequence(F.lit(1), F.col("last_year"))))
        .withColumns({"_opening": opening, "_ending": ending})
        .drop("start_date", "contract_term_months")
    )
    newest = F.lit(before.year * 12 + before.month - 2)
    closing = F.least(F.col("_ending"), newest)
    months = (
        years.filter(F.col("_opening") <= newest)
        .select("account_id", "_opening", "_ending")
        .distinct()
        .withColumn("_month", F.explode(F.sequence(F.col("_opening"), closing)))
    )
    # The openings look small enough to broadcast, but not once spread over months.
    means = (
        months.hint("merge")
        .join(rates, ["account_id", "_month"])
        .groupBy("account_id", "_opening", "_ending")
        .agg(avg_exact(F.col("consumption_rate")).alias("rate"))
    )
    keys = ["account_id", "_opening", "_ending"]
    return years.join(means, keys, "left").drop("_opening", "_ending")


def _yearly(t: Tables, as_of: date) -> DataFrame:
    acv, rate = F.col("annual_commit_dollars"), F.col("rate")
    return contract_year_rates(t, as_of).select(
        "contract_id",
        "account_id",
        "owner_id",
        "last_year",
        "year",
        acv.alias("acv"),
        "rate",
        null_least(acv * rate, acv.cast("double")).alias("value"),
        null_greatest(acv * rate - acv, F.lit(0.0)).alias("overage"),
    )


def comp_yearly(t: Tables, as_of: date, plan: CompPlan = PLAN) -> DataFrame:
    """Capped value, overage and AE contribution per contract year."""
    return _yearly(t, as_of).select(
        "contract_id",
        "year",
        round_half_up(F.col("rate"), 6).alias("consumption_rate"),
        _cents(F.col("value")).alias("annual_value"),
        _cents(F.col("overage")).alias("overage"),
        _cents(F.col("value") * plan.ae_consumption_weight).alias("ae_contribution"),
    )


def sensitivity(
    contracts: DataFrame,
    rates: tuple[float, ...] = (0.20, 0.40, 0.60, 0.80, 1.00),
    plan: CompPlan = PLAN,
) -> DataFrame:
    """Attainment of each contract at flat rates and the gain over the lowest one."""
    acv = F.col("acv")
    contribution = F.least(acv * F.col("flat_rate"), acv.cast("double")) * plan.ae_consumption_weight
    bookings = ratio(
        acv * plan.multiplier(F.col("term_years")), F.lit(plan.ae_quota * plan.ae_bookings_weight)
    )
    quota = F.lit(plan.ae_quota * plan.ae_consumption_weight)

    def total(rate: Column) -> Column:
        return bookings + ratio(
            F.least(acv * rate, acv.cast("double")) * plan.ae_consumption_weight, quota
        )

    rows = deal_economics(contracts, plan).withColumn(
        "flat_rate", F.explode(F.array(*[F.lit(r) for r in rates]))
    )
    delta = total(F.col("flat_rate")) - total(F.lit(rates[0]))
    return rows.select(
        "contract_id",
        "flat_rate",
        _cents(F.least(acv * F.col("flat_rate"), acv.cast("double"))).alias("annual_value"),
        _cents(contribution).alias("ae_contribution"),
        round_half_up(bookings, 6).alias("bookings_attainment"),
        round_half_up(total(F.col("flat_rate")), 6).alias("total_attainment"),
        F.when(F.col("flat_rate") != rates[0], round_half_up(delta, 6)).alias("delta_vs_baseline"),
    )


def ae_summary(t: Tables, as_of: date, plan: CompPlan = PLAN) -> DataFrame:
    """Bookings plus first-year consumption attainment per signing rep and approach."""
    quota = F.lit(plan.ae_quota * plan.ae_consumption_weight)
    first = (
        _yearly(t, as_of)
        .filter(F.col("year") == 1)
        .groupBy(F.col("owner_id").alias("employee_id"))
        .agg(F.sum(_money(_cents(F.col("value")))).alias("value"))
    )
    share = ratio(F.coalesce("value", F.lit(0)) * F.lit(plan.ae_consumption_weight), quota)
    rows = bookings_attainment(t.contracts, plan).join(first, "employee_id", "left")
    return rows.select(
        "employee_id",
        "deals",
        *[f"attainment_{a}" for a in _APPROACHES],
        F.col("value").cast("double").alias("year1_value"),
        round_half_up(share, 4).alias("year1_attainment"),
        *[
            round_half_up(F.col(f"attainment_{a}") + share, 4).alias(f"combined_{a}")
            for a in _APPROACHES
        ],
    )


def renewal_credit(contracts: DataFrame, plan: CompPlan = PLAN) -> DataFrame:
    """Credit of renewing each contract for one year, over the bookings quota."""
    acv = F.col("annual_commit_dollars")
    credit = acv * F.lit(float(plan.renewal_term_years)) * plan.am_bookings_weight
    quota = F.lit(plan.am_quota * plan.am_bookings_weight)
    return valid_contracts(contracts).select(
        "contract_id",
        acv.alias("renewal_acv"),
        F.lit(plan.multipliers[plan.renewal_term_years]).alias("renewal_multiplier"),
        _cents(credit).alias("renewal_credit"),
        round_half_up(ratio(credit, quota), 6).alias("renewal_attainment"),
    )


def am_yearly(t: Tables, as_of: date, plan: CompPlan = PLAN) -> DataFrame:
    """AM credit from year two on, running value, and attainment with the renewal year.

    The running sum is per contract, over at most the years of its term.
    """
    upto = W.partitionBy("contract_id").orderBy("year").rowsBetween(W.unboundedPreceding, 0)
    quota = F.lit(plan.am_quota * plan.am_consumption_weight)
    value = _cents(F.col("value"))
    running = F.coalesce(F.sum(_money(value)).over(upto).cast("double"), F.lit(0.0))
    contribution = F.col("value") * plan.am_consumption_weight
    renewal = F.when(
        F.col("year") == F.col("last_year"),
        ratio(
            F.col("acv") * F.lit(float(plan.renewal_term_years)) * plan.am_bookings_weight,
            F.lit(plan.am_quota * plan.am_bookings_weight),
        ),
    )
    rows = _yearly(t, as_of).filter(F.col("year") >= 2).withColumn("running", running)
    this_year = ratio(contribution, quota)
    return rows.select(
        "contract_id",
        "year",
        value.alias("annual_value"),
        _cents(contribution).alias("am_contribution"),
        F.col("running").alias("cumulative_value"),
        round_half_up(this_year, 6).alias("year_attainment"),
        round_half_up(ratio(F.col("running") * plan.am_consumption_weight, quota), 6).alias(
            "cumulative_attainment"
        ),
        round_half_up(renewal, 6).alias("renewal_attainment"),
        round_half_up(this_year + F.coalesce(renewal, F.lit(0.0)), 6).alias("combined_attainment"),
    )
