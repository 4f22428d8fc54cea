from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from drawdown import functions as fn
from drawdown.model import ACCOUNT_FACT
from drawdown.operators import contracts, metrics, rates, usage
from tests.build import AS_OF, contract, log, rows, tables

# Scenario, commit, average rate, expected value, expected overage.
SCENARIOS = [
    ("healthy", 200000, 0.917, 183400.0, 0.0, "Healthy"),
    ("shelfware", 300000, 0.033, 9900.0, 0.0, "Inactive"),
    ("inactive", 150000, 0.003, 450.0, 0.0, "Inactive"),
    ("overage", 80000, 1.390, 80000.0, 31200.0, "Expansion"),
    ("at risk", 500000, 0.680, 340000.0, 0.0, "At Risk"),
    ("spike aged out", 120000, 0.030, 3600.0, 0.0, "Inactive"),
    ("mid-year expansion", 180000, 0.880, 158400.0, 0.0, "Healthy"),
    ("at target", 400000, 0.850, 340000.0, 0.0, "Healthy"),
]


def _values(spark, commit, rate, ramping=False, known=True):
    commit, rate = F.lit(commit), F.lit(rate).cast("double")
    ramp = F.lit(ramping)
    return spark.range(1).select(
        fn.health_tier(rate, ramp, F.lit(known)).alias("tier"),
        fn.consumed_value(commit, rate, ramp).alias("value"),
        fn.overage_value(commit, rate, ramp).alias("overage"),
        fn.value_at_risk(commit, rate, ramp).alias("risk"),
    ).first()


@pytest.mark.parametrize("name,commit,rate,value,overage,tier", SCENARIOS)
def test_scenarios_with_given_average(spark, name, commit, rate, value, overage, tier):
    got = _values(spark, commit, rate)
    assert (got.value, got.overage, got.tier) == (value, overage, tier)
    assert got.risk == pytest.approx(commit - value)


def test_ramping_has_no_value(spark):
    got = _values(spark, 250000, 0.5, ramping=True)
    assert (got.tier, got.value, got.overage, got.risk) == ("Ramping", None, None, None)


@pytest.mark.parametrize(
    "rate,tier",
    [(0.05, "Shelfware"), (0.0499, "Inactive"), (0.40, "At Risk"), (0.80, "Healthy"),
     (1.20, "Healthy"), (1.2001, "Expansion"), (None, "Inactive")],
)
def test_tier_boundaries(spark, rate, tier):
    assert _values(spark, 100, rate).tier == tier


def test_unknown_account_has_no_tier_and_null_rate_no_value(spark):
    assert _values(spark, 100, None, known=False).tier is None
    assert _values(spark, 100, None).value is None


def _usage(account, month_credits, first_id=0):
    """One log on the 10th of each month."""
    return [
        log(first_id + account * 100 + i, account, f"{m}-10", c)
        for i, (m, c) in enumerate(month_credits)
    ]


def test_fact_from_exact_months(spark):
    """Rates .90 .94 .91 average 0.91666..., worth 183,333.33 of 200,000."""
    t = tables(
        spark,
        [contract(1, 1, "2024-07-01", "2025-06-30", commit=200000, credits=100)],
        _usage(1, [("2025-03", 90), ("2025-04", 94), ("2025-05", 91), ("2025-06", 999)]),
    )
    fact = rows(metrics.account_fact(t, AS_OF), "account_id")[1]
    assert fact["cacv"] == 183333.33
    assert fact["months_of_data"] == 3
    assert fact["health_tier"] == "Healthy"


def test_average_of_exactly_point_eight_is_healthy(spark):
    t = tables(
        spark,
        [contract(1, 1, "2024-07-01", "2025-06-30")],
        _usage(1, [("2025-03", 80), ("2025-04", 80), ("2025-05", 80)]),
    )
    assert metrics.account_fact(t, AS_OF).first().health_tier == "Healthy"


def test_future_months_do_not_count_unless_asked(spark):
    t = tables(
        spark,
        [contract(1, 1, "2025-01-01", "2025-12-31")],
        _usage(1, [("2025-03", 90), ("2025-04", 90), ("2025-05", 90)]),
    )
    assert metrics.account_fact(t, AS_OF).first().trailing_90d_avg_rate == 0.9
    assert metrics.account_fact(t, AS_OF, cutoff=None).first().trailing_90d_avg_rate == 0.0


@pytest.mark.parametrize("days,ramping", [(90, True), (91, False)])
def test_day_ninety_is_ramping(spark, days, ramping):
    start = AS_OF - timedelta(days=days)
    t = tables(spark, [contract(1, 1, start.isoformat(), "2026-12-31")])
    fact = metrics.account_fact(t, AS_OF).first()
    assert fact.is_new_account is ramping
    assert (fact.health_tier == "Ramping") is ramping


def test_zero_allowance_gives_null_rate_not_the_cap(spark):
    t = tables(
        spark,
        [contract(1, 1, "2024-07-01", "2025-06-30", credits=0)],
        _usage(1, [("2025-03", 50), ("2025-04", 50), ("2025-05", 50)]),
    )
    fact = metrics.account_fact(t, AS_OF).first()
    assert fact.trailing_90d_avg_rate is None
    assert fact.cacv is None
    assert fact.health_tier == "Inactive"


def test_account_without_month_rows_keeps_nulls(spark):
    """The contract began this month: no complete month, not ramping by a short ramp."""
    t = tables(spark, [contract(1, 1, "2025-06-05", "2026-06-04")])
    fact = metrics.account_fact(t, AS_OF, ramp_days=5).first()
    assert fact.health_tier is None and fact.cacv is None and fact.expansion_flag is None


def test_overlapping_contracts_sum_and_do_not_double_usage(spark):
    t = tables(
        spark,
        [
            contract(2, 1, "2024-07-01", "2025-06-30", commit=1000, credits=60),
            contract(1, 1, "2024-07-01", "2025-12-31", commit=500, credits=40, owner=9),
        ],
        _usage(1, [("2025-03", 50), ("2025-04", 50), ("2025-05", 50)]),
    )
    monthly = rows(usage.monthly_consumption(t), "usage_month")
    march = monthly[date(2025, 3, 1)]
    assert (march["credits_consumed"], march["included_monthly_compute_credits"]) == (50.0, 100)
    assert march["consumption_rate"] == 0.5
    fact = metrics.account_fact(t, AS_OF).first()
    # Same start: the smaller id is primary.
    assert (fact.primary_contract_id, fact.signing_owner_id) == (1, 9)
    assert (fact.annual_commit_dollars, fact.active_contract_count) == (1500, 2)
    assert fact.has_expansion
    fan = rows(usage.monthly_usage_fanout(t), "usage_month")[date(2025, 3, 1)]
    assert (fan["credits_consumed"], fan["active_usage_days"]) == (100.0, 1)


def test_guards_and_zero_fill(spark):
    t = tables(
        spark,
        [
            contract(1, 1, "2025-01-15", "2025-03-10"),
            contract(2, 1, "2025-03-20", "2025-03-19"),  # malformed
            contract(3, 2, "2025-01-01", "2025-12-31"),  # no usage
        ],
        [
            log(1, 1, "2025-01-14", 5),  # day before
            log(2, 1, "2025-01-15", 7),  # first day
            log(3, 1, "2025-03-10", 11),  # last day
            log(4, 1, "2025-03-11", 13),  # day after
            log(5, 1, "2025-03-20", 17),  # malformed contract covers nothing
            log(6, 99, "2025-02-01", 19),  # unknown account
            log(2, 1, "2025-01-15", 1),  # same id and day again
        ],
    )
    inside = usage.in_contract_logs(t.logs, t.accounts, t.contracts)
    assert sorted(r.log_id for r in inside.collect()) == [2, 2, 3]
    outside = usage.out_of_contract_usage(t.logs, t.accounts, t.contracts)
    assert sorted(r.log_id for r in outside.collect()) == [1, 4, 5]
    assert [r.log_id for r in usage.orphaned_logs(t.logs, t.accounts).collect()] == [6]
    monthly = rows(usage.monthly_consumption(t), "account_id", "usage_month")
    used = {k[1].month: (v["credits_consumed"], v["active_usage_days"])
            for k, v in monthly.items() if k[0] == 1}
    assert used == {1: (8.0, 1), 2: (0.0, 0), 3: (11.0, 1)}
    assert sum(1 for k in monthly if k[0] == 2) == 12


def test_rate_is_capped_but_the_peak_is_not(spark):
    t = tables(
        spark,
        [contract(1, 1, "2024-07-01", "2025-06-30")],
        _usage(1, [("2024-07", 250), ("2025-05", 1)]),
    )
    monthly = usage.monthly_consumption(t)
    assert rows(monthly, "usage_month")[date(2024, 7, 1)]["consumption_rate"] == 2.0
    spike = rates.spike_drop(monthly, AS_OF).first()
    assert spike.peak_rate == 2.5
    assert (spike.is_spike_drop, spike.is_spike_drop_hist) == (False, True)


def test_expansion_flag_needs_two_months_consecutive_needs_neighbours(spark):
    t = tables(
        spark,
        [contract(a, a, "2024-07-01", "2025-06-30") for a in (1, 2)],
        _usage(1, [("2025-03", 130), ("2025-04", 10), ("2025-05", 130)])
        + _usage(2, [("2025-03", 10), ("2025-04", 130), ("2025-05", 130)]),
    )
    assert all(r.expansion_flag for r in metrics.account_fact(t, AS_OF).collect())
    got = rows(rates.expansion_consecutive(usage.monthly_consumption(t), AS_OF), "account_id")
    assert not got[1]["expansion_consecutive"] and got[2]["expansion_consecutive"]


def test_several_snapshots_from_one_pass_equal_single_ones(spark):
    t = tables(
        spark,
        [
            contract(1, 1, "2024-01-01", "2024-12-31", credits=50),
            contract(2, 1, "2024-10-01", "2025-09-30", credits=70),
            contract(3, 2, "2025-05-01", "2026-04-30"),
        ],
        _usage(1, [(f"2024-{m:02d}", m * 10) for m in range(1, 13)]) + _usage(2, [("2025-05", 30)]),
    )
    dates = [date(2024, 6, 30), date(2024, 12, 31), AS_OF]
    many = rows(metrics.account_fact(t, dates), "account_id", "as_of_date")
    single = {}
    for day in dates:
        single |= rows(metrics.account_fact(t, day), "account_id", "as_of_date")
    assert many == single


def test_fact_schema(spark, sf_dir):
    from drawdown.operators.quality import schema_check
    from drawdown.plans.catalog import RUN_TS
    from drawdown.sources import tpch

    fact = metrics.account_fact(tpch.load(spark, sf_dir), tpch.AS_OF, run_ts=RUN_TS)
    assert schema_check({"fact": fact}, {"fact": ACCOUNT_FACT}) == []
    assert schema_check({"fact": fact.drop("cacv")}, {"fact": ACCOUNT_FACT}) == [
        ("fact", "cacv", "missing")
    ]


def test_streaks_and_rolling_rates(spark):
    t = tables(
        spark,
        [contract(1, 1, "2025-01-01", "2025-12-31", credits=30)],
        [log(1, 1, "2025-05-20", 1), log(2, 1, "2025-06-25", 0.04), log(3, 1, "2025-06-24", 6)],
    )
    streak = rates.early_shelfware_streak(t, AS_OF).first()
    assert (streak.streak_start, streak.streak_days) == (date(2025, 6, 25), 6)
    assert not streak.early_shelfware_flag
    rolling = rates.rolling_rates(t, AS_OF).first()
    assert rolling.credits_7d == 6.04 and rolling.credits_90d == 7.04
    assert rolling.rate_7d == pytest.approx(6.04 / 7)
    daily = rows(rates.rolling_rates_daily(usage.daily_consumption(t, AS_OF)), "date")
    assert len(daily) == 181
    assert daily[AS_OF]["rate_30d"] == pytest.approx(6.04 / 30)
    assert daily[date(2025, 6, 23)]["rate_30d"] == 0.0


def test_zero_streak_ends_at_the_last_complete_month(spark):
    t = tables(
        spark,
        [contract(1, 1, "2024-07-01", "2025-12-31")],
        _usage(1, [("2024-07", 1), ("2024-12", 1), ("2025-03", 1)]),
    )
    got = rates.zero_streak(usage.monthly_consumption(t), AS_OF).first()
    assert (got.longest_zero_streak, got.current_zero_streak, got.outreach_flag) == (4, 2, True)


def test_active_contracts_ignores_malformed_and_unknown_accounts(spark):
    t = tables(
        spark,
        [
            contract(1, 1, "2025-06-30", "2025-06-30"),
            contract(2, 1, "2025-07-01", "2025-12-31"),
            contract(3, 5, "2025-01-01", "2025-12-31"),
        ],
        accounts=[(1, "A", "x", 1)],
    )
    got = contracts.active_contracts(t.contracts, t.accounts, AS_OF).collect()
    assert [(r.account_id, r.active_contract_count) for r in got] == [(1, 1)]
