"""The account fact: trailing rate, tier, capped value, overage and value at risk."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawdown.functions import (
    consumed_value,
    health_tier,
    is_ramping,
    overage_value,
    true_if,
    value_at_risk,
)
from drawdown.model import RAMP_DAYS, TIER_CUTS, TRAILING_MONTHS, Tables
from drawdown.operators.contracts import active_contracts
from drawdown.operators.rates import trailing_stats
from drawdown.operators.skew import salted_join
from drawdown.operators.usage import monthly_consumption, recent_consumption

FACT_COLUMNS = (
    "account_id",
    "employee_id",
    "signing_owner_id",
    "company_name",
    "industry",
    "primary_contract_id",
    "contract_start_date",
    "contract_end_date",
    "contract_term_months",
    "annual_commit_dollars",
    "included_monthly_compute_credits",
    "has_expansion",
    "active_contract_count",
    "trailing_90d_avg_rate",
    "months_of_data",
    "max_monthly_rate",
    "overage_months",
    "zero_usage_months",
    "expansion_flag",
    "is_spike_drop",
    "low_data_flag",
    "is_new_account",
    "health_tier",
    "cacv",
    "expansion_signal_acv",
    "acv_at_risk",
    "as_of_date",
)
RATE_COLUMNS = ("trailing_30d_avg_rate", "trailing_7d_avg_rate")


def account_metrics(
    active: DataFrame,
    stats: DataFrame,
    ramp_days: int = RAMP_DAYS,
    tier_cuts=TIER_CUTS,
    run_ts: datetime | None = None,
    with_rates: bool = False,
) -> DataFrame:
    """Account-grain fact per snapshot date.

    Accounts without usage statistics stay, with NULL rate, tier and values.
    ``run_ts`` adds ``calculated_at``; ``with_rates`` keeps the shorter windows.
    """
    joined = active.join(stats, ["account_id", "as_of_date"], "left")
    rate, commit = F.col("trailing_90d_avg_rate"), F.col("annual_commit_dollars")
    ramping = F.col("is_new_account")
    known = F.col("months_of_data").isNotNull()
    out = (
        joined.withColumn(
            "is_new_account",
            is_ramping(F.col("contract_start_date"), F.col("as_of_date"), ramp_days),
        )
        .withColumn("health_tier", health_tier(rate, ramping, known, tier_cuts))
        .withColumn("expansion_flag", F.when(known, F.col("overage_months") >= 2))
        .withColumn(
            "is_spike_drop",
            F.when(known, true_if((F.col("max_monthly_rate") > 2.0) & (rate < 0.05))),
        )
        .withColumn("low_data_flag", F.when(known, F.col("months_of_data") < 2))
        .withColumn("cacv", consumed_value(commit, rate, ramping))
        .withColumn("expansion_signal_acv", overage_value(commit, rate, ramping))
        .withColumn("acv_at_risk", value_at_risk(commit, rate, ramping))
    )
    columns = [*FACT_COLUMNS, *(RATE_COLUMNS if with_rates else ())]
    out = out.select(*columns)
    return out if run_ts is None else out.withColumn("calculated_at", F.lit(run_ts))


def account_fact(
    t: Tables,
    as_of: date | list[date],
    cutoff: str | None = "complete_months",
    with_rates: bool = False,
    **params,
) -> DataFrame:
    """The fact for one date, or for several dates from one pass over the logs.

    With complete months only the logs of the months it needs are read;
    ``cutoff=None`` ranks future months too and reads them all.
    """
    if cutoff is None:
        monthly = monthly_consumption(t)
    else:
        monthly = recent_consumption(t, as_of, TRAILING_MONTHS)
    stats = trailing_stats(monthly, as_of, cutoff=cutoff)
    active = active_contracts(t.contracts, t.accounts, as_of)
    return account_metrics(active, stats, with_rates=with_rates, **params)


def with_rep(fact: DataFrame, reps: DataFrame) -> DataFrame:
    """Account rows with their rep's attributes; accounts of unknown reps drop out."""
    attributes = reps.select(
        "employee_id", F.col("name").alias("rep_name"), "region", "segment",
        "manager_id", "manager_name",
    )
    return salted_join(fact, attributes, ["employee_id"], "inner", spread=["account_id"])
