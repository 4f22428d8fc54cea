"""Plans that read only what they need: scorecard, ramp and rolling windows, roll-ups without ranks; presentation orders."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from drawdown.operators import edge_cases, quality, rates, rollups, usage, views
from tests.build import contract, log, tables

AS_OF = date(2025, 6, 30)


def fixture(spark):
    return tables(
        spark,
        [
            contract(1, 1, "2025-01-01", "2025-12-31", credits=30),
            contract(2, 2, "2025-05-02", "2026-05-01", credits=30),
            contract(3, 3, "2024-01-01", "2024-12-31", credits=30),
        ],
        [
            log(1, 1, "2025-05-20", 1),
            log(2, 1, "2025-06-25", 0.04),
            log(3, 1, "2025-02-24", 6),
            log(4, 2, "2025-05-03", 7),
            log(5, 2, "2025-06-03", 7),
            log(6, 3, "2024-03-01", 900),
            log(7, 3, "2025-02-01", 2),
            log(8, 77, "2025-02-01", 2),
            log(9, 77, "2025-02-01", 3),
        ],
    )


def counted(spark, t):
    """The tables with logs that add up how many of their rows were read."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return replace(t, logs=t.logs.coalesce(1).mapInArrow(count, t.logs.schema)), read


def test_scorecard_reads_logs_twice_and_equals_its_parts(spark):
    t = fixture(spark)
    watched, read = counted(spark, t)
    got = {r.edge_case: r["count"] for r in edge_cases.edge_case_scorecard(watched).collect()}
    assert read.value <= 2 * t.logs.count()
    assert got == {
        "spike_drop_accounts": edge_cases.spike_drop_accounts(t).count(),
        "shelfware_accounts": 0,
        "orphaned_usage": 2,
        "out_of_contract_usage": quality.out_of_contract(t).first().row_count,
        "accounts_with_overlap": 0,
    }


def test_scorecard_of_empty_tables(spark):
    t = fixture(spark)
    none = replace(t, logs=t.logs.limit(0), accounts=t.accounts.limit(0), contracts=t.contracts.limit(0))
    assert {r["count"] for r in edge_cases.edge_case_scorecard(none).collect()} == {0}
    idle = replace(t, logs=t.logs.limit(0))
    got = {r.edge_case: r["count"] for r in edge_cases.edge_case_scorecard(idle).collect()}
    assert got["shelfware_accounts"] == t.accounts.count() and got["orphaned_usage"] == 0


def test_scorecard_keeps_null_ids(spark):
    t = fixture(spark)
    stray = t.logs.limit(1).withColumn("account_id", F.lit(None).cast("long"))
    got = {r.edge_case: r["count"] for r in edge_cases.edge_case_scorecard(replace(t, logs=t.logs.unionByName(stray))).collect()}
    assert got["orphaned_usage"] == 3


def test_rolling_rates_since_equal_the_whole_grain(spark):
    t = fixture(spark)
    every = rates.rolling_rates_daily(usage.daily_consumption(t, AS_OF))
    for since in (date(2025, 6, 1), date(2025, 6, 30), date(2024, 1, 1)):
        some = rates.rolling_rates_since(t, AS_OF, since)
        assert sorted(some.collect()) == sorted(every.filter(F.col("date") >= F.lit(since)).collect())
    assert rates.rolling_rates_since(t, AS_OF, date(2025, 7, 1)).collect() == []


def test_stall_reads_the_ramp_only(spark):
    t = fixture(spark)
    got = rates.onboarding_stall(t, AS_OF).collect()
    assert [(r.account_id, r.weeks) for r in got] == [(2, 8)]
    plan = rates.onboarding_stall(t, AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    assert "2025-03-31" in plan or "20178" in plan  # the day before the longest ramp began


def test_portfolio_without_ranks_writes_nothing(spark, monkeypatch):
    t = fixture(spark)
    from drawdown.operators.metrics import account_fact

    fact = account_fact(t, AS_OF)
    ranked = rollups.rep_portfolio(fact, t.reps)
    monkeypatch.setattr(rollups, "materialise", None)
    plain = rollups.rep_portfolio(fact, t.reps, ranked=False)
    assert views.extract_comp(plain).collect() == views.extract_comp(ranked).collect()


def test_presentation_orders(spark):
    reps = spark.createDataFrame([(1, 5.0, AS_OF), (2, None, AS_OF), (3, 9.0, AS_OF), (4, 5.0, AS_OF)], "employee_id INT, total_cacv DOUBLE, as_of_date DATE")
    assert [r.employee_id for r in rollups.in_value_order(reps).collect()] == [3, 1, 4, 2]
    later = date(2025, 7, 31)
    comp = spark.createDataFrame([(1, 0.5, AS_OF), (2, 0.7, AS_OF), (1, None, later), (3, 0.1, later)], "employee_id INT, cacv_attainment_rate DOUBLE, as_of_date DATE")
    assert [(r.employee_id, r.as_of_date) for r in rollups.in_attainment_order(comp).collect()] == [(3, later), (1, later), (2, AS_OF), (1, AS_OF)]
    org = spark.createDataFrame([("region", "b", 0.4, AS_OF), ("org_total", "All Regions", 0.5, AS_OF), ("region", "a", 0.9, AS_OF)], "rollup_level STRING, region STRING, attainment_rate DOUBLE, as_of_date DATE")
    assert [r.region for r in rollups.in_level_order(org).collect()] == ["All Regions", "a", "b"]
    detail = spark.createDataFrame([(1, None, AS_OF), (2, 3.0, AS_OF), (3, 8.0, AS_OF)], "account_id INT, acv_at_risk DOUBLE, as_of_date DATE")
    assert [r.account_id for r in views.in_risk_order(detail).collect()] == [3, 2, 1]


def test_old_snapshots_are_stale(spark):
    detail = spark.createDataFrame(
        [(1, "Healthy", 0.9, 5, False, date(2025, 6, 28)), (2, "Healthy", 0.9, 5, False, date(2025, 6, 27)), (3, "Ramping", None, 1, True, date(2025, 6, 1))],
        "account_id INT, health_tier STRING, trailing_90d_avg_rate DOUBLE, months_of_data INT, is_new_account BOOLEAN, as_of_date DATE",
    ).selectExpr("*", "false AS early_shelfware_flag", "false AS onboarding_stall_flag", "false AS spike_drop_early_flag")
    streaks = spark.createDataFrame([], "account_id INT, current_zero_streak BIGINT")
    got = views.extract_cs(detail, streaks, F.datediff(F.lit(AS_OF), F.col("as_of_date"))).orderBy("account_id").collect()
    assert [r.confidence for r in got] == ["High", "Stale", "Stale"]


def test_days_are_spread_after_accounts_meet_their_usage(spark):
    """The join is by month; days without usage only come after it."""
    t = fixture(spark)
    twice = replace(t, accounts=t.accounts.unionByName(t.accounts.filter("account_id = 1")))
    got = usage.daily_consumption(twice, AS_OF)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    outer = [line for line in plan.splitlines() if "Join LeftOuter" in line and "_known" not in line]
    assert any("_month" in line for line in outer) and not any("date#" in line for line in outer)
    one = [r for r in got.collect() if r.account_id == 1]
    # A repeated account repeats its days, and its usage days once more.
    assert len(one) == 181 * 2 + 3 * 2 and len({r.date for r in one}) == 181


def test_run_log_computes_the_fact_once(spark, monkeypatch):
    from drawdown.plans import catalog

    t, calls, real = fixture(spark), [], catalog.account_fact
    monkeypatch.setattr(catalog, "account_fact", lambda *a, **kw: calls.append(a) or real(*a, **kw))
    rows = {r.run_id: r.rows_written_fact for r in catalog._run_logs(t).collect()}
    assert len(calls) == 1 and len(rows) == 3 and len(set(rows.values())) == 1
