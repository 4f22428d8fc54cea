"""Roll-ups of the account fact to reps, regions, segments, cohorts and the org.

Every roll-up starts from one aggregation to rep grain with map-side combining.
Reps are joined after it, one row per rep, so a rep who owns a third of all
accounts costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawdown.functions import (
    attainment_band,
    avg_exact,
    count_where,
    days_to_renewal,
    in_risk_tier,
    nrr_band,
    ratio,
    round_half_up,
    sum_where,
    true_if,
    urgency_bucket,
)
from drawdown.model import AMOUNT, ATTAINMENT_TARGET, TIERS
from drawdown.operators.skew import competition_ranks
from drawdown.session import materialise

_TIER_COLUMN = {tier: "accounts_" + tier.lower().replace(" ", "_") for tier in TIERS}


def _amount(value: str) -> Column:
    return F.sum(F.col(value).cast(AMOUNT))


def rep_measures(fact: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """All additive measures per rep (and ``extra`` columns) and snapshot date."""
    tier, commit, new = F.col("health_tier"), F.col("annual_commit_dollars"), F.col("is_new_account")
    flag = true_if(F.col("expansion_flag"))
    counts = [count_where(tier == t).alias(c) for t, c in _TIER_COLUMN.items()]
    return fact.groupBy("employee_id", "as_of_date", *(extra or [])).agg(
        F.count(F.lit(1)).alias("total_accounts"),
        count_where(new).alias("ramping"),
        count_where(~new).alias("mature"),
        F.sum(commit).alias("commit_all"),
        F.sum(F.when(~new, commit)).alias("commit_mature"),
        _amount("cacv").alias("cacv"),
        _amount("acv_at_risk").alias("at_risk"),
        _amount("expansion_signal_acv").alias("signal"),
        *counts,
        sum_where(tier == "Expansion", commit).alias("acv_expansion"),
        sum_where(tier == "Healthy", commit).alias("acv_healthy"),
        sum_where(in_risk_tier(tier), commit).alias("acv_at_risk_tiers"),
        count_where(flag).alias("expansion_opportunities"),
        sum_where(flag, commit).alias("expansion_acv_pipeline"),
        F.sum(F.when(flag, F.col("expansion_signal_acv").cast(AMOUNT))).alias("flagged_signal"),
        count_where(true_if(F.col("is_spike_drop"))).alias("spike_drop_accounts"),
        count_where(true_if(F.col("low_data_flag"))).alias("low_data_accounts"),
        count_where(F.col("has_expansion")).alias("mid_year_expansion_accounts"),
        avg_exact(F.when(~new, F.col("trailing_90d_avg_rate"))).alias("avg_rate"),
    )


def _named(reps: DataFrame) -> DataFrame:
    return reps.withColumnRenamed("name", "rep_name")


def _attainment(cacv: Column, commit: Column) -> Column:
    return round_half_up(ratio(cacv, commit), 4)


def _double(*names: tuple[str, str]) -> list[Column]:
    return [F.col(src).cast("double").alias(dst) for src, dst in names]


def rep_rollup(fact: DataFrame, reps: DataFrame) -> DataFrame:
    """Rep grain with tier counts, attainment and region and org ranks."""
    rows = rep_measures(fact).join(_named(reps), "employee_id").select(
        "employee_id",
        "rep_name",
        "region",
        "segment",
        "total_accounts",
        F.col("ramping").alias("ramping_accounts"),
        F.col("mature").alias("mature_accounts"),
        F.col("commit_all").alias("total_acv"),
        *_double(
            ("cacv", "total_cacv"),
            ("at_risk", "total_acv_at_risk"),
            ("signal", "total_expansion_signal_acv"),
        ),
        _attainment(F.col("cacv"), F.col("commit_mature")).alias("cacv_attainment_rate"),
        *_TIER_COLUMN.values(),
        "acv_expansion",
        "acv_healthy",
        "acv_at_risk_tiers",
        "expansion_opportunities",
        "expansion_acv_pipeline",
        "spike_drop_accounts",
        "mid_year_expansion_accounts",
        round_half_up(F.col("avg_rate"), 4).alias("avg_consumption_rate"),
        "as_of_date",
    )
    return _ranked(rows, ["region"])


def _ranked(rows: DataFrame, region: list[str]) -> DataFrame:
    """Region and org ranks; rep rows are written once, as ranking reads them again."""
    return competition_ranks(
        materialise(rows, "rep-rows"),
        "total_cacv",
        {"region_rank": [*region, "as_of_date"], "org_rank": ["as_of_date"]},
    )


def in_value_order(rollup: DataFrame) -> DataFrame:
    """Presentation order of the rep roll-up: consumed value, largest first."""
    return rollup.orderBy(F.desc_nulls_last("total_cacv"), "employee_id", "as_of_date")


def in_attainment_order(comp: DataFrame) -> DataFrame:
    """Presentation order of the compensation view: newest snapshot first, best attainment first."""
    return comp.orderBy(F.desc("as_of_date"), F.desc_nulls_last("cacv_attainment_rate"), "employee_id")


def in_level_order(summary: DataFrame) -> DataFrame:
    """Presentation order of the organisation summary: newest first, the org row before its regions."""
    return summary.orderBy(F.desc("as_of_date"), "rollup_level", F.desc_nulls_last("attainment_rate"), "region")


def rep_leaderboard(fact: DataFrame, reps: DataFrame) -> DataFrame:
    return rep_rollup(fact, reps).select(
        "employee_id", "rep_name", "region", "total_cacv", "region_rank", "org_rank"
    )


def rep_portfolio(fact: DataFrame, reps: DataFrame, ranked: bool = True) -> DataFrame:
    """Rep view: ramping accounts count, but stay out of ``total_acv``.

    Without ranks nothing is written on the way and nothing runs before the result does.
    """
    rows = rep_measures(fact).join(_named(reps), "employee_id").select(
        "employee_id",
        "rep_name",
        "region",
        "segment",
        "manager_name",
        "manager_id",
        "total_accounts",
        F.col("ramping").alias("accounts_ramping"),
        F.col("mature").alias("accounts_mature"),
        F.coalesce("commit_mature", F.lit(0)).alias("total_acv"),
        *_double(
            ("cacv", "total_cacv"),
            ("at_risk", "total_acv_at_risk"),
            ("signal", "total_expansion_signal_acv"),
            ("signal", "total_consumption_overage_acv"),
        ),
        "expansion_opportunities",
        _attainment(F.col("cacv"), F.col("commit_mature")).alias("cacv_attainment_rate"),
        *[c for t, c in _TIER_COLUMN.items() if t != "Ramping"],
        "acv_expansion",
        "acv_healthy",
        "acv_at_risk_tiers",
        "spike_drop_accounts",
        "low_data_accounts",
        "mid_year_expansion_accounts",
        round_half_up(F.col("avg_rate"), 4).alias("avg_consumption_rate_90d"),
        "as_of_date",
    )
    return _ranked(rows, ["region"]) if ranked else rows


def demo_rep_rollup(fact: DataFrame, reps: DataFrame) -> DataFrame:
    """The snapshot variant: ramping in the denominator, pipeline from the signal,
    region rank inside region and segment."""
    zero = F.lit(0.0)
    cacv = F.coalesce(F.col("cacv").cast("double"), zero)
    average = F.when(F.col("mature") == 0, zero).otherwise(round_half_up(F.col("avg_rate"), 4))
    rows = rep_measures(fact).join(_named(reps), "employee_id").select(
        "employee_id",
        "rep_name",
        "region",
        "segment",
        "total_accounts",
        F.col("ramping").alias("ramping_accounts"),
        F.col("mature").alias("mature_accounts"),
        F.col("commit_all").alias("total_acv"),
        cacv.alias("total_cacv"),
        F.coalesce(F.col("at_risk").cast("double"), zero).alias("total_acv_at_risk"),
        F.coalesce(F.col("signal").cast("double"), zero).alias("total_expansion_signal_acv"),
        F.coalesce(_attainment(cacv, F.col("commit_all")), zero).alias("cacv_attainment_rate"),
        *_TIER_COLUMN.values(),
        "acv_expansion",
        "acv_healthy",
        "acv_at_risk_tiers",
        "expansion_opportunities",
        F.coalesce(F.col("flagged_signal").cast("double"), zero).alias("expansion_acv_pipeline"),
        "spike_drop_accounts",
        "mid_year_expansion_accounts",
        average.alias("avg_consumption_rate"),
        "as_of_date",
    )
    return _ranked(rows, ["region", "segment"])


def comp_input(fact: DataFrame, reps: DataFrame) -> DataFrame:
    """Compensation view: mature accounts only."""
    return (
        rep_measures(fact)
        .filter(F.col("mature") > 0)
        .join(_named(reps), "employee_id")
        .select(
            "employee_id",
            "rep_name",
            "region",
            "segment",
            "manager_id",
            "as_of_date",
            F.col("mature").alias("total_mature_accounts"),
            F.col("commit_mature").alias("total_acv"),
            *_double(("cacv", "total_cacv")),
            _attainment(F.col("cacv"), F.col("commit_mature")).alias("cacv_attainment_rate"),
            *_double(
                ("at_risk", "total_acv_at_risk"), ("signal", "total_consumption_overage_acv")
            ),
        )
    )


_SUMMED = (
    "total_accounts",
    "mature",
    "ramping",
    *_TIER_COLUMN.values(),
    "acv_expansion",
    "acv_healthy",
    "acv_at_risk_tiers",
    "commit_mature",
    "cacv",
    "at_risk",
    "signal",
)


def _total(grouped) -> DataFrame:
    """Measures of a group of rep rows; a rep has one row per group, so rows are reps."""
    return grouped.agg(
        *[F.sum(c).alias(c) for c in _SUMMED], F.count(F.lit(1)).alias("total_reps")
    )


def _summary_columns() -> list[Column]:
    return [
        F.coalesce("commit_mature", F.lit(0)).alias("total_acv"),
        *_double(
            ("cacv", "total_cacv"),
            ("at_risk", "total_acv_at_risk"),
            ("signal", "total_consumption_overage_acv"),
        ),
        _attainment(F.col("cacv"), F.col("commit_mature")).alias("attainment_rate"),
        F.col("total_accounts"),
        F.col("mature").alias("total_mature_accounts"),
        F.col("ramping").alias("total_ramping_accounts"),
        *[F.col(c) for t, c in _TIER_COLUMN.items() if t != "Ramping"],
        F.col("accounts_ramping").alias("accounts_ramping_tier"),
        F.col("acv_expansion"),
        F.col("acv_healthy"),
        F.col("acv_at_risk_tiers"),
        F.col("total_reps"),
    ]


def summarise(fact: DataFrame, reps: DataFrame, by: list[str]) -> DataFrame:
    """Summary measures by any rep attribute or fact column, via rep grain."""
    own = [c for c in by if c in fact.columns]
    rows = rep_measures(fact, own).join(reps, "employee_id")
    return _total(rows.groupBy(*by, "as_of_date")).select(*by, "as_of_date", *_summary_columns())


def org_summary(fact: DataFrame, reps: DataFrame) -> DataFrame:
    """Region rows plus an org row that re-divides the summed measures, in one pass."""
    rows = rep_measures(fact).join(reps, "employee_id")
    region, day = F.col("region"), F.col("as_of_date")
    total = rows.groupingSets([[region, day], [day]], region, day).agg(
        F.grouping("region").alias("is_org"),
        *[F.sum(c).alias(c) for c in _SUMMED],
        F.count(F.lit(1)).alias("total_reps"),
    )
    is_org = F.col("is_org") == 1
    return total.select(
        F.when(is_org, "org_total").otherwise("region").alias("rollup_level"),
        F.when(is_org, "All Regions").otherwise(F.col("region")).alias("region"),
        "as_of_date",
        *_summary_columns(),
    )


def cohort_summary(fact: DataFrame, reps: DataFrame, fy_start_month: int = 8) -> DataFrame:
    """Summary by the fiscal quarter in which the primary contract began."""
    from drawdown.operators.calendar import fiscal_quarter_label

    cohort = fiscal_quarter_label(F.col("contract_start_date"), fy_start_month)
    return summarise(fact.withColumn("cohort", cohort), reps, ["cohort"])


def attainment_cube(fact: DataFrame, reps: DataFrame) -> DataFrame:
    """Org, region and segment levels in one result; NULL marks a rolled-up column."""
    rows = rep_measures(fact).join(reps, "employee_id")
    return (
        rows.rollup("region", "segment")
        .agg(
            F.grouping_id().cast("long").alias("level"),
            F.sum("total_accounts").alias("total_accounts"),
            F.sum("commit_mature").alias("commit_mature"),
            F.sum("cacv").alias("cacv"),
        )
        .select(
            "region",
            "segment",
            "level",
            "total_accounts",
            F.coalesce("commit_mature", F.lit(0)).alias("total_acv"),
            *_double(("cacv", "total_cacv")),
            _attainment(F.col("cacv"), F.col("commit_mature")).alias("attainment_rate"),
        )
    )


def _plain_rollup(fact: DataFrame, reps: DataFrame) -> DataFrame:
    """Rep roll-up without ranks, for the pages that only re-aggregate it."""
    return rep_measures(fact).join(_named(reps), "employee_id")


def region_page(fact: DataFrame, reps: DataFrame) -> DataFrame:
    rows = _plain_rollup(fact, reps)
    total = rows.groupBy("region").agg(
        F.count(F.lit(1)).alias("reps"),
        F.sum("total_accounts").alias("total_accounts"),
        F.sum("commit_all").alias("total_acv"),
        F.sum("cacv").alias("cacv"),
        F.sum("at_risk").alias("at_risk"),
        F.sum("accounts_expansion").alias("accounts_expansion"),
        F.sum("accounts_at_risk").alias("accounts_at_risk"),
        F.sum("expansion_acv_pipeline").alias("expansion_acv_pipeline"),
        F.sum("spike_drop_accounts").alias("spike_drop_accounts"),
    )
    return total.select(
        "region",
        "reps",
        "total_accounts",
        "total_acv",
        *_double(("cacv", "total_cacv"), ("at_risk", "total_acv_at_risk")),
        "accounts_expansion",
        "accounts_at_risk",
        "expansion_acv_pipeline",
        "spike_drop_accounts",
        round_half_up(ratio(F.col("cacv"), F.col("total_acv")), 6).alias("att_rate"),
        round_half_up(ratio(F.col("at_risk"), F.col("total_acv")), 6).alias("risk_pct"),
    )


def tier_mix_region(fact: DataFrame, reps: DataFrame) -> DataFrame:
    columns = list(_TIER_COLUMN.values())
    sums = _plain_rollup(fact, reps).groupBy("region").agg(*[F.sum(c).alias(c) for c in columns])
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return sums.select(
        "region",
        *[round_half_up(ratio(F.col(c) * 100, total), 4).alias(f"pct_{c[9:]}") for c in columns],
    )


def expansion_by_region(fact: DataFrame, reps: DataFrame) -> DataFrame:
    flagged = fact.filter(F.col("expansion_flag"))
    rate = F.col("trailing_90d_avg_rate").cast("decimal(18,12)")
    per_rep = flagged.groupBy("employee_id").agg(
        F.count(F.lit(1)).alias("n"),
        _amount("expansion_signal_acv").alias("signal"),
        F.sum(rate).alias("rate_sum"),
        F.count(rate).alias("rates"),
    )
    return (
        per_rep.join(reps, "employee_id")
        .groupBy("region")
        .agg(
            F.sum("n").alias("exp_accounts"),
            F.sum("signal").cast("double").alias("exp_signal_acv"),
            round_half_up(ratio(F.sum("rate_sum"), F.sum("rates")), 6).alias("avg_rate"),
        )
    )


def tier_distribution(fact: DataFrame) -> DataFrame:
    return fact.groupBy("health_tier").agg(
        F.count(F.lit(1)).alias("accounts"), F.sum("annual_commit_dollars").alias("acv")
    )


def _upcoming(fact: DataFrame, days: int) -> DataFrame:
    left = days_to_renewal(F.col("contract_end_date"), F.col("as_of_date"))
    return fact.withColumn("days_to_renewal", left).filter(
        F.col("days_to_renewal").between(0, days)
    )


def renewal_bucket_exposure(fact: DataFrame, days: int = 180) -> DataFrame:
    return (
        _upcoming(fact, days)
        .filter(in_risk_tier(F.col("health_tier")))
        .groupBy(urgency_bucket(F.col("days_to_renewal")).alias("bucket"), "health_tier")
        .agg(F.count(F.lit(1)).alias("accounts"), _amount("acv_at_risk").cast("double").alias("acv_at_risk"))
    )


def portfolio_kpis(fact: DataFrame, reps: DataFrame, target: float = ATTAINMENT_TARGET) -> DataFrame:
    total = _plain_rollup(fact, reps).agg(
        F.sum("commit_all").alias("total_acv"),
        F.sum("cacv").cast("double").alias("total_cacv"),
        F.sum("at_risk").cast("double").alias("total_acv_at_risk"),
        F.sum("signal").cast("double").alias("total_overage"),
    )
    gap = F.col("total_acv") * F.lit(target) - F.col("total_cacv")
    rate = ratio(F.col("total_cacv"), F.col("total_acv"))
    return total.select(
        "*",
        round_half_up(rate, 6).alias("attainment"),
        round_half_up(F.greatest(gap, F.lit(0.0)), 2).alias("gap_to_target"),
    )


def renewal_kpis(fact: DataFrame, reps: DataFrame, days: int = 180) -> DataFrame:
    left = days_to_renewal(F.col("contract_end_date"), F.col("as_of_date"))
    due = left.between(0, days)
    risky = due & in_risk_tier(F.col("health_tier"))
    per_rep = fact.groupBy("employee_id").agg(
        count_where(due).alias("due"),
        count_where(risky).alias("risky"),
        F.sum(F.when(risky, F.col("acv_at_risk").cast(AMOUNT))).alias("exposed"),
        F.sum("annual_commit_dollars").alias("acv"),
    )
    known = per_rep.join(reps.select("employee_id"), "employee_id", "left_semi")
    return known.agg(
        F.sum("due").alias("accounts_expiring"),
        F.sum("risky").alias("at_risk_accounts"),
        F.sum("exposed").cast("double").alias("acv_exposed"),
        round_half_up(ratio(F.sum("exposed"), F.sum("acv")), 6).alias("share_of_total_acv"),
    )


def near_risk_renewals(fact: DataFrame, reps: DataFrame) -> DataFrame:
    return renewal_kpis(fact, reps, days=90).select(
        F.col("at_risk_accounts").alias("near_risk_count"),
        F.col("acv_exposed").alias("near_risk_acv"),
    )


def lagging_region(fact: DataFrame, reps: DataFrame) -> DataFrame:
    """Region with the lowest attainment; a region without commits divides by one."""
    rows = _plain_rollup(fact, reps).groupBy("region").agg(
        F.sum("commit_all").alias("acv"), F.sum("cacv").alias("cacv")
    )
    base = F.when(F.col("acv") > 0, F.col("acv")).otherwise(F.lit(1))
    rate = round_half_up(ratio(F.coalesce("cacv", F.lit(0)), base), 6)
    return rows.select("region", rate.alias("attainment")).orderBy("attainment", "region").limit(1)


def nrr_forecast(fact: DataFrame, reps: DataFrame) -> DataFrame:
    """Renewal outcome band that each region's attainment points to."""
    rate = F.col("att_rate")
    return region_page(fact, reps).select("region", "att_rate", nrr_band(rate).alias("nrr_band"))


def attainment_bands(fact: DataFrame, reps: DataFrame) -> DataFrame:
    """Attainment band of every rep."""
    rows = _plain_rollup(fact, reps)
    rate = _attainment(F.col("cacv"), F.col("commit_mature"))
    return rows.select(
        "employee_id", "rep_name", "region", rate.alias("cacv_attainment_rate")
    ).withColumn("band", attainment_band(F.col("cacv_attainment_rate")))


def _rep_scores(fact: DataFrame, reps: DataFrame) -> DataFrame:
    total = F.col("commit_all")
    gap = F.greatest(total * F.lit(ATTAINMENT_TARGET) - F.col("cacv").cast("double"), F.lit(0.0))
    return _plain_rollup(fact, reps).select(
        "employee_id",
        "rep_name",
        "region",
        total.alias("total_acv"),
        *_double(("cacv", "total_cacv")),
        _attainment(F.col("cacv"), F.col("commit_mature")).alias("cacv_attainment_rate"),
        round_half_up(gap, 2).alias("gap_to_target"),
        "accounts_at_risk",
    )


def top_reps(fact: DataFrame, reps: DataFrame, n: int = 3) -> DataFrame:
    rows = _rep_scores(fact, reps).filter(F.col("cacv_attainment_rate").isNotNull())
    return rows.orderBy(F.desc("cacv_attainment_rate"), "employee_id").limit(n)


def gap_reps(fact: DataFrame, reps: DataFrame, n: int = 3) -> DataFrame:
    rows = _rep_scores(fact, reps).filter(F.col("cacv_attainment_rate").isNotNull())
    return rows.orderBy(F.desc("gap_to_target"), "employee_id").limit(n)


def coaching_reps(fact: DataFrame, reps: DataFrame, n: int = 3) -> DataFrame:
    rows = _rep_scores(fact, reps).filter(F.col("cacv_attainment_rate") < ATTAINMENT_TARGET)
    return rows.orderBy("cacv_attainment_rate", "employee_id").limit(n)


def top20_reps(fact: DataFrame, reps: DataFrame, n: int = 20) -> DataFrame:
    rows = _rep_scores(fact, reps)
    return rows.orderBy(F.desc_nulls_last("total_cacv"), "employee_id").limit(n)


def data_coverage(fact: DataFrame, reps: DataFrame) -> DataFrame:
    """Coverage counts of a snapshot as (metric, value) rows."""
    tier = F.col("health_tier")
    per_rep = fact.groupBy("employee_id").agg(
        F.count(F.lit(1)).alias("accounts"),
        F.count("trailing_90d_avg_rate").alias("rated"),
        count_where(F.col("cacv") > 0).alias("consuming"),
        count_where(tier.isin("Shelfware", "Inactive")).alias("shelf"),
        count_where(tier == "Ramping").alias("ramping"),
        count_where(true_if(F.col("expansion_flag"))).alias("flagged"),
    )
    known = per_rep.join(reps.select("employee_id"), "employee_id", "left_semi")
    counts = {
        "accounts": F.sum("accounts"),
        "reps": F.count(F.lit(1)),
        "rated_accounts": F.sum("rated"),
        "consuming_accounts": F.sum("consuming"),
        "idle_accounts": F.sum("shelf"),
        "ramping_accounts": F.sum("ramping"),
        "flagged_accounts": F.sum("flagged"),
    }
    rows = F.array(
        *[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in counts.items()]
    )
    long = known.agg(F.sum("accounts").alias("accounts"), rows.alias("rows")).select(
        "accounts", F.inline("rows")
    )
    share = round_half_up(ratio(F.col("value"), F.col("accounts")), 4)
    return long.select("metric", "value", share.alias("share_of_accounts"))
