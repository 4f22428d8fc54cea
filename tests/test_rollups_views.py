from __future__ import annotations

from datetime import date

import pytest

from pyspark.sql import functions as F

from drawdown.operators import rollups, views
from drawdown.operators.metrics import account_fact, with_rep
from tests.build import AS_OF, contract, log, rows, tables

REPS = [
    (1, "Ann", "EMEA", "Enterprise", 7, "Boss"),
    (2, "Bob", "EMEA", "Mid-Market", 7, "Boss"),
    (3, "Cy", "APAC", "Enterprise", 8, "Chief"),
]


@pytest.fixture(scope="module")
def book(spark):
    """Five accounts: healthy, capped, ramping, of an unknown rep, and a quiet one."""
    accounts = [
        (10, "Healthy Co", "x", 1),
        (11, "Over Co", "x", 1),
        (12, "New Co", "x", 2),
        (13, "Lost Co", "x", 99),
        (14, "Quiet Co", "x", 3),
    ]
    contracts = [
        contract(1, 10, "2024-08-01", "2025-07-15", commit=1000),
        contract(2, 11, "2024-07-15", "2025-12-31", commit=2000),
        contract(3, 12, "2025-05-01", "2026-04-30", commit=4000),
        contract(4, 13, "2024-07-01", "2025-12-31", commit=8000),
        contract(5, 14, "2024-07-01", "2025-08-15", commit=500),
    ]
    logs = [
        log(a * 100 + i, a, f"2025-0{m}-10", c)
        for a, c in ((10, 90), (11, 150), (13, 50))
        for i, m in enumerate((3, 4, 5))
    ]
    t = tables(spark, contracts, logs, accounts, REPS)
    fact = account_fact(t, AS_OF, with_rates=True).cache()
    return t, fact, with_rep(fact, t.reps)


def test_rep_rollup_ranks_nulls_last_and_drops_unknown_reps(book):
    t, fact, _ = book
    got = rows(rollups.rep_rollup(fact, t.reps), "employee_id")
    assert set(got) == {1, 2, 3}
    ann = got[1]
    assert (ann["total_acv"], ann["total_cacv"], ann["cacv_attainment_rate"]) == (3000, 2900.0, 0.9667)
    assert (ann["accounts_expansion"], ann["accounts_healthy"]) == (1, 1)
    assert ann["total_expansion_signal_acv"] == 1000.0
    assert ann["avg_consumption_rate"] == 1.2
    # Only a ramping account: nothing to attain, ranked last.
    assert got[2]["total_cacv"] is None and got[2]["cacv_attainment_rate"] is None
    assert {k: (v["region_rank"], v["org_rank"]) for k, v in got.items()} == {
        1: (1, 1), 2: (2, 3), 3: (1, 2)
    }


def test_three_denominators(book):
    t, fact, _ = book
    assert rows(rollups.rep_portfolio(fact, t.reps), "employee_id")[2]["total_acv"] == 0
    demo = rows(rollups.demo_rep_rollup(fact, t.reps), "employee_id")[2]
    assert (demo["total_acv"], demo["cacv_attainment_rate"], demo["total_cacv"]) == (4000, 0.0, 0.0)
    assert demo["region_rank"] == 1  # alone in EMEA / Mid-Market
    assert set(rows(rollups.comp_input(fact, t.reps), "employee_id")) == {1, 3}


def test_org_summary_levels(book):
    t, fact, _ = book
    got = rows(rollups.org_summary(fact, t.reps), "region")
    assert set(got) == {"EMEA", "APAC", "All Regions"}
    org = got["All Regions"]
    assert (org["total_accounts"], org["total_reps"], org["total_acv"]) == (4, 3, 3500)
    assert org["attainment_rate"] == pytest.approx(2900 / 3500, abs=1e-4)
    assert org["rollup_level"] == "org_total"


def test_cohort_is_the_fiscal_quarter(book):
    t, fact, _ = book
    got = rows(rollups.cohort_summary(fact, t.reps), "cohort")
    # 15 July is still the old fiscal year, 1 August opens the new one.
    assert {k: v["total_accounts"] for k, v in got.items()} == {
        "FY2024-Q4": 2, "FY2025-Q1": 1, "FY2025-Q4": 1
    }


def test_renewal_register(book):
    _, _, owned = book
    got = rows(views.renewal_pipeline(owned), "account_id")
    assert set(got) == {10, 14}
    assert got[10]["days_to_renewal"] == 15
    assert got[10]["renewal_urgency_bucket"] == "0–30 days"
    assert got[10]["renewal_risk_score"] == 2.0
    assert (got[14]["tier_risk"], got[14]["renewal_risk_score"]) == (5, 10.0)
    ordered = [r.account_id for r in views.in_urgency_order(views.renewal_pipeline(owned)).collect()]
    assert ordered == [10, 14]


def test_user_queries(book):
    t, fact, owned = book
    assert [r.account_id for r in views.q_accounts(owned, region="emea", limit=1).collect()] == [10]
    assert [r.account_id for r in views.q_accounts(owned, rep_name="CY").collect()] == [14]
    assert views.q_accounts(owned, health_tier="Healthy", min_acv_at_risk=101).count() == 0
    assert [r.account_id for r in views.q_renewals(owned, date(2025, 8, 1)).collect()] == [14]
    late = views.q_renewals(owned, date(2025, 8, 1), include_expired=True)
    assert {r.account_id for r in late.collect()} == {10, 14}
    assert views.q_rep(rollups.rep_rollup(fact, t.reps), "aNN").count() == 1
    summary = views.q_portfolio(owned, "apac").first()
    assert summary.health_tier_counts == {"Inactive": 1}
    assert summary.health_tier_acv == {"Inactive": 500}
    assert (summary.scope, summary.rep_count, summary.attainment_rate) == ("apac", 1, 0.0)


def test_bands_and_extracts(book):
    t, fact, owned = book
    pace = rows(views.activation_pace(owned), "pace")
    assert len(pace) == 4 and pace["Lagging (<20%)"] == {
        "pace": "Lagging (<20%)", "accounts": 1, "acv": 4000
    }
    bands = rows(views.cs_score_band(fact), "account_id")
    assert (bands[11]["cs_score_low"], bands[11]["cs_score_high"]) == (90, 100)
    assert bands[12]["cs_score_low"] is None
    crm = rows(views.extract_crm(owned), "account")
    assert crm[11]["StageName"] == "Expansion Identified" and crm[10]["StageName"] is None
    detail = views.account_detail(owned)
    streaks = detail.sparkSession.createDataFrame([(10, 1, 1), (11, 2, 2)], "account_id LONG, current_zero_streak LONG, x LONG")
    cs = rows(views.extract_cs(detail, streaks, F.lit(3)), "account_id")
    assert {k: cs[k]["outreach_flag"] for k in (10, 11, 12)} == {10: False, 11: True, 12: False}
    assert cs[10]["confidence"] == "Stale"
    cs = rows(views.extract_cs(detail, streaks), "account_id")
    assert cs[12]["confidence"] == "Low" and cs[10]["confidence"] == "High"
    assert cs[11]["cs_health_score"] == 100.0
    assert views.align(fact, ["cacv", "nope", "account_id"]).columns == ["cacv", "account_id"]
    assert rows(views.retier(fact, (0.0, 0.4, 0.7, 1.0)), "account_id")[14]["health_tier"] == "Shelfware"


def test_alert_flags_date_from_the_snapshot(book):
    _, fact, _ = book
    got = rows(views.alert_flags(fact), "account_id")
    assert got[12]["onboarding_stall_flag"]  # 60 days in, nothing used
    assert not got[10]["onboarding_stall_flag"]


def test_snapshot_lookup(book, spark):
    _, fact, _ = book
    assert views.snapshot_latest(fact, AS_OF).count() == 5
    assert views.snapshot_latest(fact, date(2020, 1, 1)).count() == 5
    assert views.snapshot_latest(fact, date(2020, 1, 1), "none").count() == 0
    assert views.snapshot_latest(fact, date(2020, 1, 1), "all").count() == 5
    assert [r.as_of_date for r in views.snapshot_dates(fact).collect()] == [AS_OF]
