"""Account-level views and parameterised user queries over the fact.

``fact`` arguments named ``owned`` are fact rows already joined to their rep
(``metrics.with_rep``).
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawdown.functions import (
    as_date,
    confidence_level,
    count_where,
    days_to_renewal,
    health_tier,
    in_risk_tier,
    pace_band,
    ratio,
    renewal_score,
    round_half_up,
    tier_severity,
    true_if,
    urgency_bucket,
)
from drawdown.functions.bands import PACES
from drawdown.model import RENEWAL_HORIZON_DAYS, TIERS


def alert_columns() -> dict[str, Column]:
    """Behavioural flags as the account view defines them, dated by the snapshot."""
    weekly, months = F.col("trailing_7d_avg_rate"), F.col("months_of_data")
    age = F.datediff(F.col("as_of_date"), F.col("contract_start_date"))
    return {
        "early_shelfware_flag": true_if(
            (weekly < 0.30) & (months <= 2) & ~F.col("is_new_account")
        ),
        "onboarding_stall_flag": true_if(F.col("is_new_account") & (weekly == 0) & (age > 30)),
        "spike_drop_early_flag": true_if(
            (weekly < 0.05) & (F.col("max_monthly_rate") > 2.0) & (months <= 2)
        ),
    }


def alert_flags(fact_with_rates: DataFrame) -> DataFrame:
    rated = fact_with_rates.filter(F.col("months_of_data").isNotNull())
    return rated.select("account_id", *[c.alias(n) for n, c in alert_columns().items()])


def account_detail(owned: DataFrame) -> DataFrame:
    """Full account view; accounts without any usage month are not part of it."""
    days = days_to_renewal(F.col("contract_end_date"), F.col("as_of_date"))
    return owned.filter(F.col("months_of_data").isNotNull()).select(
        "account_id",
        "company_name",
        "industry",
        "primary_contract_id",
        "active_contract_count",
        "has_expansion",
        "contract_start_date",
        "contract_end_date",
        "contract_term_months",
        "annual_commit_dollars",
        "included_monthly_compute_credits",
        days.alias("days_to_renewal"),
        "employee_id",
        "rep_name",
        "region",
        "segment",
        "manager_name",
        *[
            round_half_up(F.col(c), 6).alias(c)
            for c in ("trailing_7d_avg_rate", "trailing_30d_avg_rate", "trailing_90d_avg_rate")
        ],
        "health_tier",
        "cacv",
        "acv_at_risk",
        F.col("expansion_signal_acv").alias("consumption_overage_acv"),
        "months_of_data",
        round_half_up(F.col("max_monthly_rate"), 6).alias("max_monthly_rate"),
        "overage_months",
        "zero_usage_months",
        "is_new_account",
        "expansion_flag",
        "is_spike_drop",
        "low_data_flag",
        *[c.alias(n) for n, c in alert_columns().items()],
        "as_of_date",
    )


def renewal_pipeline(owned: DataFrame, horizon_days: int = RENEWAL_HORIZON_DAYS) -> DataFrame:
    """Risk register of contracts that end within the horizon; lower score, more urgent."""
    end, day = F.col("contract_end_date"), F.col("as_of_date")
    left = days_to_renewal(end, day)
    return (
        owned.filter(end.between(day, F.date_add(day, horizon_days)))
        .withColumn("days_to_renewal", left)
        .withColumn("tier_risk", tier_severity(F.col("health_tier")))
        .filter(F.col("tier_risk").isNotNull())
        .select(
            "account_id",
            "company_name",
            "industry",
            "primary_contract_id",
            "contract_start_date",
            "contract_end_date",
            "contract_term_months",
            "days_to_renewal",
            urgency_bucket(F.col("days_to_renewal")).alias("renewal_urgency_bucket"),
            "annual_commit_dollars",
            "cacv",
            "acv_at_risk",
            F.col("expansion_signal_acv").alias("consumption_overage_acv"),
            "health_tier",
            round_half_up(F.col("trailing_90d_avg_rate"), 6).alias("trailing_90d_avg_rate"),
            "months_of_data",
            "is_new_account",
            "expansion_flag",
            "is_spike_drop",
            "employee_id",
            "rep_name",
            "region",
            "segment",
            "manager_name",
            "as_of_date",
            "tier_risk",
            renewal_score(F.col("tier_risk"), F.col("days_to_renewal")).alias(
                "renewal_risk_score"
            ),
        )
    )


def in_risk_order(detail: DataFrame) -> DataFrame:
    """Presentation order of the account view: value at risk, largest first."""
    return detail.orderBy(F.desc_nulls_last("acv_at_risk"), "account_id", "as_of_date")


def in_urgency_order(register: DataFrame) -> DataFrame:
    """Presentation order of the register."""
    return register.orderBy("renewal_risk_score", F.desc_nulls_last("acv_at_risk"), "account_id")


def health_tiers(fact: DataFrame) -> DataFrame:
    return fact.select(
        "account_id",
        round_half_up(F.col("trailing_90d_avg_rate"), 6).alias("trailing_90d_avg_rate"),
        "is_new_account",
        "health_tier",
    )


def retier(fact: DataFrame, cuts: tuple[float, float, float, float]) -> DataFrame:
    """Tiers under other cut-offs."""
    tier = health_tier(
        F.col("trailing_90d_avg_rate"),
        F.col("is_new_account"),
        F.col("months_of_data").isNotNull(),
        cuts,
    )
    return fact.withColumn("health_tier", tier)


def confidence(fact: DataFrame, calculated_at: datetime, now: datetime) -> DataFrame:
    """Data confidence per account, given when the snapshot was calculated."""
    age = F.lit((now - calculated_at).total_seconds() / 86400.0)
    level = confidence_level(F.col("months_of_data"), F.col("is_new_account"), age)
    return fact.select("account_id", "months_of_data", "is_new_account", level.alias("confidence"))


# Fixed score ranges and actions per tier.
_CS_BANDS = (
    ("Expansion", 90, 100, "Flag for AE expansion handoff"),
    ("Healthy", 70, 89, "Maintain check-in cadence"),
    ("At Risk", 40, 69, "Open CS escalation playbook; 30-day SLA"),
    ("Shelfware", 20, 39, "Executive sponsor outreach playbook"),
    ("Inactive", 0, 19, "Immediate save plan; escalate to VP CS"),
    ("Ramping", None, None, "Onboarding playbook; 90-day activation tracking"),
)


def cs_score_band(fact: DataFrame) -> DataFrame:
    """Score range and playbook of each account's tier, from a map literal (no join)."""
    cases = {"cs_score_low": 1, "cs_score_high": 2, "cs_action": 3}
    columns = []
    for name, at in cases.items():
        kind = "string" if at == 3 else "int"
        chain = None
        for row in _CS_BANDS:
            value = F.lit(row[at]).cast(kind)
            hit = F.col("health_tier") == row[0]
            chain = F.when(hit, value) if chain is None else chain.when(hit, value)
        columns.append(chain.alias(name))
    return fact.filter(F.col("health_tier").isNotNull()).select(
        "account_id", "health_tier", *columns
    )


def extract_crm(owned: DataFrame) -> DataFrame:
    """CRM field mapping of the account fact."""
    commit = F.col("annual_commit_dollars")
    return owned.select(
        F.col("account_id").alias("account"),
        F.col("health_tier").alias("Health_Tier__c"),
        round_half_up(ratio(F.col("cacv"), commit), 4).alias("Attainment__c"),
        F.col("acv_at_risk").alias("ACV_at_Risk__c"),
        F.when(true_if(F.col("expansion_flag")), "Expansion Identified").alias("StageName"),
        true_if(F.col("is_spike_drop")).alias("Spike_Drop_Flag__c"),
        F.col("employee_id").alias("Owner"),
        F.col("signing_owner_id").alias("Signing_Owner__c"),
    )


def extract_cs(detail: DataFrame, streaks: DataFrame, age_days: Column | None = None) -> DataFrame:
    """Customer-success extract: health score, confidence and warning flags.

    `streaks` are `rates.zero_streak` rows: outreach is due while at least two adjacent months up to now had no usage.
    `age_days` is the age of the snapshot; over two days the confidence is Stale.
    """
    current = streaks.select("account_id", F.col("current_zero_streak").alias("_streak"))
    age = F.lit(0.0) if age_days is None else age_days
    score = F.least(F.lit(100.0), F.coalesce("trailing_90d_avg_rate", F.lit(0.0)) * 100)
    level = confidence_level(F.col("months_of_data"), F.col("is_new_account"), age)
    return detail.join(current, "account_id", "left").select(
        "account_id",
        "health_tier",
        round_half_up(score, 2).alias("cs_health_score"),
        level.alias("confidence"),
        (F.coalesce("_streak", F.lit(0)) >= 2).alias("outreach_flag"),
        "early_shelfware_flag",
        "onboarding_stall_flag",
        "spike_drop_early_flag",
    )


def extract_comp(portfolio: DataFrame) -> DataFrame:
    """Compensation extract of the rep view."""
    return portfolio.select(
        "employee_id",
        "as_of_date",
        F.col("total_cacv").alias("quota_attainment_numerator"),
        F.col("cacv_attainment_rate").alias("accelerator_rate"),
        F.col("total_acv").alias("quota_denominator"),
        (F.col("expansion_opportunities") > 0).alias("expansion_spif_eligible"),
    )


def activation_bonus(fact: DataFrame, threshold: float = 0.80) -> DataFrame:
    hit = ~F.col("is_new_account") & (F.col("trailing_90d_avg_rate") >= threshold)
    return fact.filter(hit).select(
        "employee_id",
        "account_id",
        "company_name",
        round_half_up(F.col("trailing_90d_avg_rate"), 6).alias("trailing_90d_avg_rate"),
    )


def activation_pace(fact: DataFrame) -> DataFrame:
    """Ramping accounts and commit per pace band; empty bands count zero."""
    ramping = F.col("is_new_account")
    band = pace_band(F.coalesce("trailing_90d_avg_rate", F.lit(0.0)))
    commit = F.col("annual_commit_dollars")
    rows = F.array(
        *[
            F.struct(
                F.lit(pace).alias("pace"),
                count_where(ramping & (band == pace)).alias("accounts"),
                F.coalesce(F.sum(F.when(ramping & (band == pace), commit)), F.lit(0)).alias("acv"),
            )
            for pace in PACES
        ]
    )
    return fact.agg(rows.alias("rows")).select(F.inline("rows"))


_ACCOUNT_LIST = (
    "account_id",
    "company_name",
    "health_tier",
    "annual_commit_dollars",
    "cacv",
    "acv_at_risk",
    "expansion_signal_acv",
    "trailing_90d_avg_rate",
    "rep_name",
    "region",
)


def _listed(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(
        *[
            round_half_up(F.col(c), 2).alias(c) if c == "trailing_90d_avg_rate" else F.col(c)
            for c in columns
        ]
    )


def _top(df: DataFrame, value: str, n: int) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(value), "account_id").limit(n)


def q_accounts(
    owned: DataFrame,
    health_tier: str | None = None,
    rep_name: str | None = None,
    region: str | None = None,
    min_acv_at_risk: float | None = None,
    limit: int = 10,
) -> DataFrame:
    """Accounts by value at risk, filtered like the user's question."""
    rows = owned
    if health_tier is not None:
        rows = rows.filter(F.col("health_tier") == health_tier)
    if rep_name is not None:
        rows = rows.filter(F.lower("rep_name") == rep_name.lower())
    if region is not None:
        rows = rows.filter(F.upper("region") == region.upper())
    if min_acv_at_risk is not None:
        rows = rows.filter(F.col("acv_at_risk") >= min_acv_at_risk)
    return _listed(_top(rows, "acv_at_risk", limit), *_ACCOUNT_LIST)


def q_rep(rollup: DataFrame, name: str) -> DataFrame:
    return rollup.filter(F.lower("rep_name") == name.lower())


def q_renewals(
    owned: DataFrame,
    as_of: date,
    days: int = 90,
    health_tier: str | None = None,
    limit: int = 20,
    include_expired: bool = False,
) -> DataFrame:
    """Contracts ending within ``days``, by value at risk."""
    left = days_to_renewal(F.col("contract_end_date"), as_of)
    rows = owned.withColumn("days_to_renewal", left).filter(F.col("days_to_renewal") <= days)
    if not include_expired:
        rows = rows.filter(F.col("days_to_renewal") >= 0)
    if health_tier is not None:
        rows = rows.filter(F.col("health_tier") == health_tier)
    return _listed(
        _top(rows, "acv_at_risk", limit),
        "account_id",
        "company_name",
        "contract_end_date",
        "days_to_renewal",
        "health_tier",
        "annual_commit_dollars",
        "cacv",
        "acv_at_risk",
        "trailing_90d_avg_rate",
        "rep_name",
        "region",
    )


def q_portfolio(owned: DataFrame, region: str | None = None) -> DataFrame:
    """Portfolio totals with tier counts and commits as maps (absent tiers left out)."""
    rows = owned if region is None else owned.filter(F.upper("region") == region.upper())
    tier, commit = F.col("health_tier"), F.col("annual_commit_dollars")
    per_rep = rows.groupBy("employee_id").agg(
        F.sum(commit).alias("acv"),
        F.sum(F.col("cacv").cast("decimal(18,2)")).alias("cacv"),
        F.sum(F.col("acv_at_risk").cast("decimal(18,2)")).alias("risk"),
        F.sum(F.col("expansion_signal_acv").cast("decimal(18,2)")).alias("signal"),
        F.count(F.lit(1)).alias("accounts"),
        *[count_where(tier == t).alias(f"n_{t}") for t in TIERS],
        *[F.sum(F.when(tier == t, commit)).alias(f"c_{t}") for t in TIERS],
    )
    total = per_rep.agg(
        F.sum("acv").alias("acv"),
        F.sum("cacv").alias("cacv"),
        F.sum("risk").alias("risk"),
        F.sum("signal").alias("signal"),
        F.count(F.lit(1)).alias("rep_count"),
        F.sum("accounts").alias("account_count"),
        *[F.sum(f"n_{t}").alias(f"n_{t}") for t in TIERS],
        *[F.sum(f"c_{t}").alias(f"c_{t}") for t in TIERS],
    )

    def by_tier(prefix: str) -> Column:
        entries = F.array(
            *[F.struct(F.lit(t).alias("t"), F.col(f"{prefix}_{t}").alias("v")) for t in TIERS]
        )
        return F.map_filter(F.map_from_entries(entries), lambda _, n: n > 0)

    return total.select(
        F.lit(region or "All Regions").alias("scope"),
        F.col("acv").alias("total_acv"),
        round_half_up(F.col("cacv"), 0).alias("total_cacv"),
        F.coalesce(round_half_up(ratio(F.col("cacv"), F.col("acv")), 4), F.lit(0.0)).alias(
            "attainment_rate"
        ),
        round_half_up(F.col("risk"), 0).alias("total_acv_at_risk"),
        round_half_up(F.col("signal"), 0).alias("total_expansion_signal_acv"),
        "rep_count",
        "account_count",
        by_tier("n").alias("health_tier_counts"),
        by_tier("c").alias("health_tier_acv"),
    )


def top_at_risk(owned: DataFrame, n: int = 10) -> DataFrame:
    rows = owned.filter(in_risk_tier(F.col("health_tier")))
    return _listed(_top(rows, "acv_at_risk", n), *_ACCOUNT_LIST)


def top_expansion(owned: DataFrame, n: int = 10) -> DataFrame:
    rows = owned.filter(F.col("health_tier") == "Expansion")
    return _listed(_top(rows, "expansion_signal_acv", n), *_ACCOUNT_LIST)


def urgent_renewals(owned: DataFrame, days: int = 30) -> DataFrame:
    """At-risk accounts that renew within ``days``."""
    left = days_to_renewal(F.col("contract_end_date"), F.col("as_of_date"))
    return (
        owned.withColumn("days_to_renewal", left)
        .filter(in_risk_tier(F.col("health_tier")) & F.col("days_to_renewal").between(0, days))
        .select(
            "account_id", "company_name", "rep_name", "health_tier", "acv_at_risk", "days_to_renewal"
        )
    )


def expansion_pipeline(owned: DataFrame) -> DataFrame:
    """Flagged accounts with their signal."""
    return owned.filter(F.col("expansion_flag")).select(
        "account_id",
        "company_name",
        "rep_name",
        "region",
        "annual_commit_dollars",
        round_half_up(F.col("trailing_90d_avg_rate"), 6).alias("trailing_90d_avg_rate"),
        "cacv",
        "expansion_signal_acv",
        "acv_at_risk",
        "contract_end_date",
    )


def ramp_tracker(owned: DataFrame) -> DataFrame:
    """Ramping accounts with their current rate and pace."""
    rate = F.coalesce("trailing_90d_avg_rate", F.lit(0.0))
    return owned.filter(F.col("is_new_account")).select(
        "account_id",
        "company_name",
        "rep_name",
        "region",
        "annual_commit_dollars",
        round_half_up(rate, 6).alias("rate"),
        pace_band(rate).alias("pace"),
        "contract_start_date",
        "contract_end_date",
    )


def ramp_kpis(owned: DataFrame) -> DataFrame:
    rate = F.coalesce("trailing_90d_avg_rate", F.lit(0.0))
    return owned.filter(F.col("is_new_account")).agg(
        F.count(F.lit(1)).alias("ramping_accounts"),
        F.coalesce(F.sum("annual_commit_dollars"), F.lit(0)).alias("acv_ramping"),
        count_where(rate >= 0.5).alias("strong_start"),
        count_where((rate >= 0.2) & (rate < 0.5)).alias("developing"),
        count_where(rate < 0.2).alias("needs_attention"),
    )


def align(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns in target order; those the frame lacks are skipped."""
    return df.select(*[c for c in columns if c in df.columns])


def snapshot_latest(snapshots: DataFrame, as_of, fallback: str = "latest") -> DataFrame:
    """Rows of one snapshot date.

    If that date is absent, ``latest`` takes the newest snapshot, ``none`` gives
    no rows and ``all`` every row. On a table partitioned by ``as_of_date`` the
    lookup reads partition values only and the result prunes to one partition.
    """
    day = as_date(as_of)
    if fallback == "none":
        return snapshots.filter(F.col("as_of_date") == day)
    dates = snapshots.select("as_of_date").distinct()
    wanted = F.max(F.when(F.col("as_of_date") == day, day))
    if fallback == "latest":
        best = dates.agg(F.coalesce(wanted, F.max("as_of_date"))).scalar()
        return snapshots.filter(F.col("as_of_date") == best)
    found = dates.agg(wanted).scalar()
    return snapshots.filter(F.coalesce(F.col("as_of_date") == found, F.lit(True)))


def snapshot_dates(snapshots: DataFrame, n: int = 30) -> DataFrame:
    return snapshots.select("as_of_date").distinct().orderBy(F.desc("as_of_date")).limit(n)


