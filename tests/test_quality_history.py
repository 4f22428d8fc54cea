from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest

from pyspark.sql import functions as F

from drawdown.model import AMENDMENTS
from drawdown.operators import comp, contracts, edge_cases, history, quality, usage
from drawdown.operators.metrics import account_fact
from tests.build import AS_OF, contract, d, log, rows, tables


@pytest.fixture(scope="module")
def messy(spark):
    return tables(
        spark,
        [
            contract(1, 1, "2025-01-01", "2025-12-31"),
            contract(2, 1, "2025-03-01", "2025-02-01"),
            contract(3, 50, "2025-01-01", "2025-12-31"),
            contract(4, 2, "2025-05-01", "2026-04-30"),
            contract(5, 1, "2025-02-01", "2025-12-31"),
        ],
        [log(1, 1, "2025-06-01", 5), log(1, 1, "2025-06-02", -5), log(2, 60, "2025-06-01", 1)]
        + [log(10 + i, 61, "2025-06-01", 1) for i in range(12)]
        + [log(40, 2, "2024-01-01", 3)],
        accounts=[(1, "A", "x", 1), (2, "B", "x", 9)],
    )


def test_report_counts_all_rows_and_samples_five(messy):
    got = rows(quality.dq_report(messy, AS_OF), "test_name")
    counts = {k: (v["passed"], v["row_count"]) for k, v in got.items()}
    assert counts == {
        "null_primary_keys": (True, 0),
        "negative_credits": (False, 1),
        "malformed_contracts": (False, 1),
        "duplicate_log_ids": (False, 1),
        "contracts_missing_accounts": (False, 1),
        "accounts_missing_reps": (False, 1),
        "orphaned_usage": (False, 13),
        "out_of_contract": (False, 1),
        "shelfware_rate": (False, 2),
        "overlapping_contracts": (True, 1),
        "new_account_rate": (True, 1),
    }
    assert got["orphaned_usage"]["sample_rows"][0] == '{"account_id":61,"orphan_count":12}'
    assert got["malformed_contracts"]["sample_rows"] == [
        '{"contract_id":2,"account_id":1,"start_date":"2025-03-01","end_date":"2025-02-01"}'
    ]
    gate = quality.dq_gate(quality.dq_report(messy, AS_OF)).first()
    assert (gate.passed, gate.errors, gate.warnings, gate.gate_passed) == (3, 5, 3, False)


def test_null_keys_are_counted(messy):
    nulls = replace(messy, logs=messy.logs.selectExpr(
        "nullif(log_id, 40) log_id", "account_id", "date", "compute_credits_consumed"))
    got = quality.null_primary_keys(nulls).first()
    assert (got.passed, got.row_count) == (False, 1)
    assert got.detail == "1 null keys; tables daily_usage_logs"


def test_a_check_that_cannot_run_fails_as_an_error(messy):
    broken = replace(messy, contracts=messy.contracts.drop("end_date"))
    got = rows(quality.dq_report(broken, AS_OF), "test_name")
    assert len(got) == 11
    assert got["malformed_contracts"]["severity"] == "ERROR"
    assert got["out_of_contract"]["severity"] == "ERROR" and not got["out_of_contract"]["passed"]
    assert got["negative_credits"]["row_count"] == 1


def test_invariants_hold_and_phantoms_are_found(messy):
    got = rows(quality.metric_invariants(account_fact(messy, AS_OF), messy), "rule")
    found = {k: v["violations"] for k, v in got.items() if v["violations"]}
    assert found == {"no phantom reps": 1}
    checks = rows(quality.snapshot_checks(account_fact(messy, AS_OF), messy.reps), "check_name")
    assert checks["orphaned accounts (no rep)"]["row_count"] == 1
    assert checks["ramping rate"]["row_count"] == 1


def test_spike_month_and_scorecard(spark):
    t = tables(
        spark,
        [contract(1, 1, "2024-01-01", "2024-12-31"), contract(2, 2, "2024-01-01", "2024-12-31")],
        [log(1, 1, "2024-02-03", 500), log(2, 1, "2024-05-01", 40), log(3, 9, "2024-01-01", 1)],
    )
    got = edge_cases.spike_drop_accounts(t).collect()
    assert [(r.account_id, r.month_1_credits, r.month_1_share) for r in got][0] == (1, 500.0, 0.93)
    assert {r.account_id for r in edge_cases.spike_drop_accounts(t, date(2024, 1, 1)).collect()} == {9}
    card = rows(edge_cases.edge_case_scorecard(t, {"shelfware_accounts": "~100"}), "edge_case")
    assert (card["shelfware_accounts"]["count"], card["shelfware_accounts"]["expected"]) == (1, "~100")
    assert card["orphaned_usage"]["count"] == 1


def test_amendments_and_versions(spark):
    t = tables(spark, [contract(1, 1, "2025-01-01", "2025-12-31", commit=100, credits=10)])
    changes = [
        (1, 1, "annual_commit_dollars", "150", d("2025-03-01"), d("2025-02-01")),
        (2, 1, "annual_commit_dollars", "140", d("2025-03-01"), d("2025-02-15")),
        (3, 1, "end_date", "2026-06-30", d("2025-05-01"), d("2025-05-01")),
        (4, 1, "annual_commit_dollars", "900", d("2025-09-01"), d("2025-02-01")),
        (5, 1, "included_monthly_compute_credits", "ten", d("2025-04-01"), d("2025-04-01")),
        (6, 1, "included_monthly_compute_credits", "10", d("2025-06-01"), d("2025-06-01")),
    ]
    amendments = spark.createDataFrame(changes, AMENDMENTS)
    got = history.contracts_as_of(t.contracts, amendments, date(2025, 5, 31)).first()
    # The later-created of two same-day changes wins; text that is no number is ignored.
    assert (got.annual_commit_dollars, got.end_date, got.included_monthly_compute_credits) == (
        140, d("2026-06-30"), 10
    )
    versions = history.scd2_contracts(t.contracts, amendments).orderBy("valid_from").collect()
    assert [(v.valid_from, v.valid_to, v.annual_commit_dollars) for v in versions] == [
        (d("2025-01-01"), d("2025-02-28"), 100),
        (d("2025-03-01"), d("2025-04-30"), 140),
        (d("2025-05-01"), d("2025-08-31"), 140),
        (d("2025-09-01"), None, 900),
    ]
    assert [v.is_current for v in versions] == [False, False, False, True]


def test_corrections_are_null_safe(spark):
    schema = "account_id long, as_of_date date, cacv double, health_tier string"
    old = spark.createDataFrame(
        [(1, AS_OF, 5.0, "Healthy"), (2, AS_OF, None, "Ramping"), (3, AS_OF, 1.0, "At Risk")], schema
    )
    new = spark.createDataFrame(
        [(1, AS_OF, 5.0, "Healthy"), (2, AS_OF, None, "Ramping"), (4, AS_OF, None, None)], schema
    )
    got = history.snapshot_corrections(old, new.union(spark.createDataFrame(
        [(3, AS_OF, 2.0, "At Risk")], schema)))
    assert sorted((r.account_id, r.old_cacv, r.new_cacv) for r in got.collect() if r.account_id == 3) == [
        (3, 1.0, 2.0)
    ]


def test_owner_history_lookup(spark):
    t = tables(
        spark,
        [
            contract(1, 1, "2025-01-01", "2025-12-31", owner=5),
            contract(2, 1, "2025-03-01", "2025-12-31", owner=6),
            contract(3, 1, "2025-03-01", "2025-12-31", owner=7),
        ],
        [log(1, 1, "2024-12-31", 1), log(2, 1, "2025-02-28", 1), log(3, 1, "2025-03-01", 1)],
    )
    late = t.logs.unionByName(t.logs.filter("log_id = 3").withColumns({"log_id": F.lit(4), "date": F.lit(date(2099, 5, 1))}))
    owned = contracts.owner_as_of(late, contracts.owner_history(t.contracts), "date")
    assert {r.log_id: r.owner_id for r in owned.collect()} == {1: None, 2: 5, 3: 7, 4: 7}


def test_contract_types(spark):
    t = tables(
        spark,
        [
            contract(1, 1, "2024-01-01", "2024-12-31"),
            contract(2, 1, "2024-06-01", "2024-08-31"),
            contract(3, 1, "2025-01-01", "2025-12-31"),
            contract(4, 1, "2025-01-01", "2025-12-31"),
        ],
    )
    got = {r.contract_id: r.contract_type for r in contracts.contract_types(t.contracts).collect()}
    assert got == {1: "base", 2: "expansion", 3: "renewal", 4: "expansion"}


def test_retention(spark):
    t = tables(
        spark,
        [
            contract(1, 1, "2024-01-01", "2024-12-31", commit=100),
            contract(2, 1, "2025-01-01", "2025-12-31", commit=150),
            contract(3, 2, "2024-01-01", "2024-12-31", commit=100),
            contract(4, 3, "2024-01-01", "2026-12-31", commit=200),
            contract(5, 4, "2024-01-01", "2024-12-31", commit=100),
            contract(6, 4, "2025-01-01", "2025-12-31", commit=60),
        ],
    )
    got = history.retention_metrics(t.contracts, date(2024, 6, 30), AS_OF).first()
    assert (got.begin_acv, got.expansion_acv, got.contraction_acv, got.churned_acv) == (500, 50, 40, 100)
    assert (got.nrr, got.grr, got.logo_churn) == (0.82, 0.72, 0.3333)


def test_comp_formulas_match_a_worked_deal(spark):
    """A three-year deal of 300,000 with full usage in year one, half in year two."""
    months = [(f"{y}-{m:02d}", c) for y, c in ((2023, 100), (2024, 50)) for m in range(1, 13)]
    t = tables(
        spark,
        [contract(1, 1, "2023-01-01", "2025-12-31", commit=300000, term=36),
         contract(2, 1, "2023-01-01", "2022-12-31", commit=1, term=48)],
        [log(i, 1, f"{m}-05", c) for i, (m, c) in enumerate(months)],
    )
    deal = comp.deal_economics(t.contracts).first()
    assert (deal.tcv, deal.credit_none, deal.credit_multiplier) == (900000.0, 300000.0, 405000.0)
    yearly = rows(comp.comp_yearly(t, date(2025, 1, 15)), "year")
    assert {y: v["annual_value"] for y, v in yearly.items()} == {1: 300000.0, 2: 150000.0, 3: None}
    assert yearly[1]["ae_contribution"] == 90000.0
    am = rows(comp.am_yearly(t, date(2025, 1, 15)), "year")
    assert set(am) == {2, 3}
    assert am[2]["cumulative_value"] == 150000.0 and am[3]["renewal_attainment"] == 0.375
    low, *_, top = sorted(comp.sensitivity(t.contracts).collect(), key=lambda r: r.flat_rate)
    assert low.delta_vs_baseline is None and top.delta_vs_baseline == pytest.approx(0.24)
    summary = comp.ae_summary(t, date(2025, 1, 15)).first()
    assert (summary.year1_attainment, summary.combined_none) == (0.3, 0.7286)


def test_part_year_terms_count_by_their_months(spark):
    t = tables(
        spark,
        [contract(1, 1, "2024-01-01", "2024-08-31", commit=120000, term=8),
         contract(2, 2, "2023-01-01", "2024-06-30", commit=120000, term=18)],
        [log(i, a, f"{y}-{m:02d}-05", 50 if (y, m) != (2024, 7) else 100)
         for i, (a, y, m) in enumerate((a, y, m) for a in (1, 2) for y in (2023, 2024) for m in range(1, 13))],
    )
    deals = rows(comp.deal_economics(t.contracts), "contract_id")
    assert (deals[1]["tcv"], deals[1]["credit_multiplier"]) == (80000.0, None)
    assert (deals[2]["tcv"], deals[2]["credit_multiplier"]) == (180000.0, None)
    yearly = comp.comp_yearly(t, date(2025, 1, 15)).collect()
    assert {(r.contract_id, r.year) for r in yearly} == {(1, 1), (2, 1), (2, 2)}
    # The second year of 18 months ends with June, so July's usage is not in it.
    assert next(r for r in yearly if (r.contract_id, r.year) == (2, 2)).annual_value == 60000.0


def test_usage_of_unlisted_term_has_no_multiplier(spark):
    t = tables(spark, [contract(1, 1, "2023-01-01", "2026-12-31", commit=10, term=48)])
    assert comp.deal_economics(t.contracts).first().credit_multiplier is None
    assert usage.daily_totals(t.logs).count() == 0


def test_key_remap_cycles_and_keeps_unmatched(spark):
    reps = "employee_id long, rep_name string, region string, segment string"
    source = spark.createDataFrame(
        [(-1, "b", "E", "x"), (-2, "a", "E", "x"), (-3, "c", "E", "x"), (-4, "d", "W", "x")], reps
    )
    target = spark.createDataFrame([(10, "q", "E", "x"), (11, "p", "E", "x")], reps)
    got = {r.source_key: r.target_key
           for r in history.key_remap(source, target, ["region", "segment"], "rep_name").collect()}
    assert got == {-2: 10, -1: 11, -3: 10, -4: -4}
