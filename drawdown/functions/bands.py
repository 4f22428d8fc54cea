"""Classification rules: tiers, flags, urgency buckets and score bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from drawdown.functions.exprs import (
    as_date,
    null_greatest,
    null_least,
    round_half_up,
    true_if,
)
from drawdown.model import (
    ATTAINMENT_TARGET,
    ATTAINMENT_WATCH,
    RAMP_DAYS,
    RISK_TIERS,
    TIER_CUTS,
    TIER_RISK,
)

__all__ = [
    "attainment_band",
    "confidence_level",
    "consumed_value",
    "days_to_renewal",
    "health_tier",
    "in_risk_tier",
    "is_ramping",
    "nrr_band",
    "overage_value",
    "pace_band",
    "renewal_score",
    "tier_severity",
    "urgency_bucket",
    "value_at_risk",
]

# Fixed labels of the urgency buckets and activation paces.
URGENCY = ("0–30 days", "31–60 days", "61–90 days", "91–180 days")
PACES = ("Lagging (<20%)", "Developing (20–50%)", "On Pace (50–80%)", "Strong (≥80%)")


def is_ramping(start: Column, as_of, days: int = RAMP_DAYS) -> Column:
    """A contract that began within the last ``days`` days, the last one included."""
    return true_if(start >= F.date_sub(as_date(as_of), days))


def health_tier(rate: Column, ramping: Column, has_stats: Column, cuts=TIER_CUTS) -> Column:
    """Tier of a trailing rate; boundaries belong to the better tier except 1.2.

    A known account without a rate is Inactive; one without any statistics row
    has no tier at all.
    """
    inactive, shelf, risk, top = cuts
    by_rate = (
        F.when(rate > top, "Expansion")
        .when(rate >= risk, "Healthy")
        .when(rate >= shelf, "At Risk")
        .when(rate >= inactive, "Shelfware")
        .otherwise("Inactive")
    )
    return F.when(ramping, "Ramping").when(has_stats, by_rate)


def _mature(ramping: Column, value: Column) -> Column:
    return F.when(~ramping, round_half_up(value, 2))


def consumed_value(commit: Column, rate: Column, ramping: Column) -> Column:
    """Commit backed by consumption, never above the commit itself."""
    return _mature(ramping, null_least(commit * rate, commit.cast("double")))


def overage_value(commit: Column, rate: Column, ramping: Column) -> Column:
    return _mature(ramping, null_greatest(commit * rate - commit, F.lit(0.0)))


def value_at_risk(commit: Column, rate: Column, ramping: Column) -> Column:
    return _mature(ramping, commit - null_least(commit * rate, commit.cast("double")))


def in_risk_tier(tier: Column) -> Column:
    return tier.isin(*RISK_TIERS)


def days_to_renewal(end: Column, as_of) -> Column:
    return F.datediff(end, as_date(as_of)).cast("long")


def urgency_bucket(days: Column) -> Column:
    return (
        F.when(days <= 30, URGENCY[0])
        .when(days <= 60, URGENCY[1])
        .when(days <= 90, URGENCY[2])
        .otherwise(URGENCY[3])
    )


def tier_severity(tier: Column) -> Column:
    """Severity 1 to 5 of a tier, NULL for an unknown one."""
    pairs = reduce(lambda acc, kv: acc + [F.lit(kv[0]), F.lit(kv[1])], TIER_RISK.items(), [])
    return F.try_element_at(F.create_map(*pairs), tier)


def renewal_score(severity: Column, days: Column) -> Column:
    """Severity times the number of 30-day steps left; lower is more urgent."""
    return round_half_up(severity * (1 + F.floor(days / 30)), 2)


def attainment_band(rate: Column) -> Column:
    return (
        F.when(rate >= ATTAINMENT_TARGET, "Above target")
        .when(rate >= ATTAINMENT_WATCH, "Below target")
        .otherwise("Needs attention")
    )


def nrr_band(rate: Column) -> Column:
    return (
        F.when(rate >= 0.90, "≥ 90%")
        .when(rate >= 0.70, "70–90%")
        .when(rate >= 0.50, "50–70%")
        .when(rate < 0.50, "< 50%")
    )


def pace_band(rate: Column) -> Column:
    """Activation pace of a ramping account; upper edges are inclusive."""
    return (
        F.when((rate > -0.001) & (rate <= 0.2), PACES[0])
        .when((rate > 0.2) & (rate <= 0.5), PACES[1])
        .when((rate > 0.5) & (rate <= 0.8), PACES[2])
        .when((rate > 0.8) & (rate <= 2.0), PACES[3])
    )


def confidence_level(months: Column, ramping: Column, age_days: Column) -> Column:
    return (
        F.when(age_days > 2, "Stale")
        .when(ramping, "Low")
        .when(months >= 3, "High")
        .when(months >= 1, "Medium")
    )
