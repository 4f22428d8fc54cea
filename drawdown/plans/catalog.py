"""Named queries over the star-schema tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drawdown.functions import from_units, round_half_up, utc_clock
from drawdown.model import ACCOUNT_FACT, Tables
from drawdown.operators import (
    calendar,
    comp,
    contracts,
    edge_cases,
    history,
    quality,
    rates,
    rollups,
    usage,
    views,
)
from drawdown.operators.metrics import account_fact, with_rep
from drawdown.plans import audit
from drawdown.session import materialise, state_store, work_dir
from drawdown.sources import dimension_store, fact_store, files, tpch, usage_store
from drawdown.streaming import jobs, low_use

AS_OF = tpch.AS_OF
RUN_TS = datetime(2000, 6, 30, 8, 0, 0)
SNAPSHOTS = [date(1999, 12, 31), date(2000, 3, 31), date(2000, 6, 30)]
#: The later part of the events' month is delivered first.
LATE_FROM = datetime(2024, 1, 16)
#: Columns of a stored snapshot without the run's time.
FACT = T.StructType([f for f in ACCOUNT_FACT.fields if f.name != "calculated_at"])
SOON = AS_OF - timedelta(days=90)
EARLIER = AS_OF - timedelta(days=180)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(build: Callable[[Tables], DataFrame], name: str) -> None:
    _QUERIES[name] = lambda spark, sf_dir: build(tpch.load(spark, sf_dir))


def _add(**builders: Callable[[Tables], DataFrame]) -> None:
    for name, build in builders.items():
        _query(build, name)


def _six(df: DataFrame, *names: str) -> DataFrame:
    """Rates to six digits, the precision results are compared at."""
    return df.withColumns({n: round_half_up(F.col(n), 6) for n in names})


def _fact(t: Tables, **kw) -> DataFrame:
    return account_fact(t, AS_OF, **kw)


def _owned(t: Tables, **kw) -> DataFrame:
    return with_rep(_fact(t, **kw), t.reps)


def _on_fact(build: Callable[[DataFrame, DataFrame], DataFrame]):
    return lambda t: build(_fact(t), t.reps)


def _monthly(t: Tables) -> DataFrame:
    return usage.monthly_consumption(t, before=AS_OF.replace(day=1))


_STATS = (
    "trailing_90d_avg_rate",
    "trailing_30d_avg_rate",
    "trailing_7d_avg_rate",
    "max_monthly_rate",
    "min_monthly_rate",
    "peak_rate",
)


def _stats(t: Tables, monthly: DataFrame, cutoff: str | None) -> DataFrame:
    return _six(rates.trailing_stats(monthly, AS_OF, cutoff=cutoff), *_STATS)


def _detail(t: Tables) -> DataFrame:
    return views.account_detail(_owned(t, with_rates=True))


def _aged_detail(t: Tables) -> DataFrame:
    """The account view as a refresh leaves it that reached accounts with an even number only; the others are a quarter old."""
    before = date(2000, 3, 31)
    fact = with_rep(account_fact(t, [AS_OF, before], with_rates=True), t.reps)
    day = F.when(F.pmod("account_id", F.lit(2)) == 0, F.lit(AS_OF)).otherwise(F.lit(before))
    return views.account_detail(fact.filter(F.col("as_of_date") == day))


# Contracts, usage and rates
_add(
    active_contracts=lambda t: contracts.active_contracts(t.contracts, t.accounts, AS_OF),
    orphan_guard=lambda t: usage.orphan_guard(t.logs, t.accounts),
    in_contract_logs=lambda t: usage.in_contract_logs(t.logs, t.accounts, t.contracts),
    orphaned_usage=lambda t: usage.orphaned_logs(t.logs, t.accounts),
    out_of_contract_usage=lambda t: usage.out_of_contract_usage(t.logs, t.accounts, t.contracts),
    contracts_missing_accounts=quality.contracts_missing_accounts_rows,
    accounts_missing_reps=quality.accounts_missing_reps_rows,
    overlapping_pairs=lambda t: contracts.overlapping_pairs(t.contracts),
    overlap_profile=lambda t: contracts.overlap_profile(t.contracts),
    monthly_usage=usage.monthly_usage,
    monthly_usage_fanout=usage.monthly_usage_fanout,
    monthly_consumption=lambda t: _six(usage.monthly_consumption(t), "consumption_rate"),
    fact_monthly=lambda t: _six(usage.fact_monthly(t, AS_OF), "consumption_rate"),
    daily_consumption=lambda t: _six(usage.daily_consumption(t, AS_OF), "daily_consumption_rate"),
    trailing_stats=lambda t: _stats(t, _monthly(t), "complete_months"),
    trailing_stats_nocut=lambda t: _stats(t, usage.monthly_consumption(t), None),
    rates_by_window=lambda t: _stats(t, _monthly(t), "complete_months").select(
        "account_id", *_STATS[:3]
    ),
    yoy_rate=lambda t: rates.yoy_rate(_monthly(t), AS_OF),
    expansion_consecutive=lambda t: rates.expansion_consecutive(_monthly(t), AS_OF),
    spike_drop=lambda t: rates.spike_drop(_monthly(t), AS_OF),
    rolling_rates=lambda t: _six(
        rates.rolling_rates(t, AS_OF), "rate_7d", "rate_30d", "rate_90d"
    ),
    rolling_rates_daily=lambda t: _six(
        rates.rolling_rates_daily(usage.daily_consumption(t, AS_OF)),
        "rate_7d",
        "rate_30d",
        "rate_90d",
    ),
    rolling_rates_since=lambda t: _six(
        rates.rolling_rates_since(t, AS_OF, AS_OF.replace(day=1)), "rate_7d", "rate_30d", "rate_90d"
    ),
    early_shelfware_streak=lambda t: rates.early_shelfware_streak(t, AS_OF),
    onboarding_stall=lambda t: rates.onboarding_stall(t, AS_OF),
    mom_drop=lambda t: rates.mom_drop(t, AS_OF),
    zero_streak=lambda t: rates.zero_streak(_monthly(t), AS_OF),
)

# Account fact and account views
_add(
    account_metrics=lambda t: _six(_fact(t), "trailing_90d_avg_rate", "max_monthly_rate"),
    health_tier=lambda t: views.health_tiers(_fact(t)),
    alert_flags=lambda t: views.alert_flags(_fact(t, with_rates=True)),
    confidence_level=lambda t: views.confidence(_fact(t), RUN_TS, RUN_TS + timedelta(hours=6)),
    cs_score_band=lambda t: views.cs_score_band(_fact(t)),
    activation_pace=lambda t: views.activation_pace(_owned(t)),
    activation_bonus=lambda t: views.activation_bonus(_fact(t)),
    account_detail=_detail,
    renewal_pipeline=lambda t: views.renewal_pipeline(_owned(t)),
    expansion_pipeline=lambda t: views.expansion_pipeline(_owned(t)),
    ramp_tracker=lambda t: views.ramp_tracker(_owned(t)),
    ramp_kpis=lambda t: views.ramp_kpis(_owned(t)),
    top_at_risk=lambda t: views.top_at_risk(_owned(t)),
    top_expansion=lambda t: views.top_expansion(_owned(t)),
    urgent_renewals=lambda t: views.urgent_renewals(_owned(t)),
    q_accounts=lambda t: views.q_accounts(
        _owned(t), health_tier="At Risk", region="asia", min_acv_at_risk=1000.0
    ),
    q_renewals=lambda t: views.q_renewals(_owned(t), AS_OF),
    q_rep=lambda t: views.q_rep(rollups.rep_rollup(_fact(t), t.reps), "supplier#000000007"),
    extract_crm=lambda t: views.extract_crm(_owned(t)),
    extract_cs=lambda t: views.extract_cs(_detail(t), rates.zero_streak(_monthly(t), AS_OF)),
    extract_cs_aged=lambda t: views.extract_cs(
        _aged_detail(t), rates.zero_streak(_monthly(t), AS_OF), F.datediff(F.lit(AS_OF), F.col("as_of_date"))
    ),
    extract_comp=lambda t: views.extract_comp(rollups.rep_portfolio(_fact(t), t.reps, ranked=False)),
)


def _portfolio_text(t: Tables) -> DataFrame:
    """Maps as JSON text, so that any engine can compare them."""
    row = views.q_portfolio(_owned(t))
    return row.withColumns(
        {c: F.to_json(c) for c in ("health_tier_counts", "health_tier_acv")}
    )


_add(q_portfolio=_portfolio_text)

# Roll-ups
_add(
    rep_rollup=_on_fact(rollups.rep_rollup),
    rep_leaderboard=_on_fact(rollups.rep_leaderboard),
    rep_portfolio=_on_fact(rollups.rep_portfolio),
    demo_rep_rollup=_on_fact(rollups.demo_rep_rollup),
    comp_input=_on_fact(rollups.comp_input),
    org_summary=_on_fact(rollups.org_summary),
    segment_summary=lambda t: rollups.summarise(_fact(t), t.reps, ["segment"]),
    cohort_summary=_on_fact(rollups.cohort_summary),
    attainment_cube=_on_fact(rollups.attainment_cube),
    region_page=_on_fact(rollups.region_page),
    tier_mix_region=_on_fact(rollups.tier_mix_region),
    expansion_by_region=_on_fact(rollups.expansion_by_region),
    tier_distribution=lambda t: rollups.tier_distribution(_fact(t)),
    renewal_bucket_exposure=lambda t: rollups.renewal_bucket_exposure(_owned(t)),
    portfolio_kpis=_on_fact(rollups.portfolio_kpis),
    renewal_kpis=_on_fact(rollups.renewal_kpis),
    near_risk_renewals=_on_fact(rollups.near_risk_renewals),
    lagging_region=_on_fact(rollups.lagging_region),
    nrr_band=_on_fact(rollups.nrr_forecast),
    attainment_band=_on_fact(rollups.attainment_bands),
    top_reps=_on_fact(rollups.top_reps),
    gap_reps=_on_fact(rollups.gap_reps),
    coaching_reps=_on_fact(rollups.coaching_reps),
    top20_reps=_on_fact(rollups.top20_reps),
    data_coverage=_on_fact(rollups.data_coverage),
)


# Quality
def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("sample_rows", F.array_join("sample_rows", " "))


_add(
    dq_null_pk=lambda t: _flat(quality.null_primary_keys(t)),
    dq_negative_credits=lambda t: _flat(quality.negative_credits(t)),
    dq_malformed_contracts=lambda t: _flat(quality.malformed_contracts(t)),
    dq_duplicate_log_ids=lambda t: _flat(quality.duplicate_log_ids(t)),
    dq_contracts_missing_accounts=lambda t: _flat(quality.contracts_missing_accounts(t)),
    dq_accounts_missing_reps=lambda t: _flat(quality.accounts_missing_reps(t)),
    dq_orphaned_usage=lambda t: _flat(quality.orphaned_usage(t)),
    dq_out_of_contract=lambda t: _flat(quality.out_of_contract(t)),
    dq_shelfware_rate=lambda t: _flat(quality.shelfware_rate(t, AS_OF)),
    dq_overlapping_contracts=lambda t: _flat(quality.overlapping_contracts(t, AS_OF)),
    dq_new_account_rate=lambda t: _flat(quality.new_account_rate(t, AS_OF)),
    dq_report=lambda t: _flat(quality.dq_report(t, AS_OF)),
    dq_gate=lambda t: quality.dq_gate(quality.dq_report(t, AS_OF)),
    snapshot_checks=lambda t: quality.snapshot_checks(_fact(t), t.reps),
    metric_invariants=lambda t: quality.metric_invariants(_fact(t), t),
    spike_drop_accounts=edge_cases.spike_drop_accounts,
    shelfware_accounts=edge_cases.shelfware_accounts,
    consistent_overage=edge_cases.consistent_overage,
    orphan_profile=edge_cases.orphan_profile,
    edge_case_scorecard=edge_cases.edge_case_scorecard,
)


def _view_checks(t: Tables) -> DataFrame:
    # Five views read the fact; it is computed once.
    fact = materialise(_fact(t, with_rates=True), "view-checks")
    owned = with_rep(fact, t.reps)
    return quality.view_checks(
        views.account_detail(owned),
        rollups.rep_portfolio(fact, t.reps),
        rollups.comp_input(fact, t.reps),
        views.renewal_pipeline(owned),
        rollups.org_summary(fact, t.reps),
        fact,
        t.reps,
    )


_add(view_checks=_view_checks)

# Compensation
_add(
    comp_deal_economics=lambda t: comp.deal_economics(t.contracts),
    comp_bookings_attainment=lambda t: comp.bookings_attainment(t.contracts),
    comp_yearly=lambda t: comp.comp_yearly(t, AS_OF),
    comp_sensitivity=lambda t: comp.sensitivity(t.contracts),
    comp_ae_summary=lambda t: comp.ae_summary(t, AS_OF),
    comp_am_yearly=lambda t: comp.am_yearly(t, AS_OF),
    comp_am_renewal=lambda t: comp.renewal_credit(t.contracts),
)


# History
def _snapshots(t: Tables) -> DataFrame:
    return account_fact(t, SNAPSHOTS)


def _stored_snapshots(t: Tables) -> str:
    """Three snapshots as a table of partitions, the last one written twice."""
    path = work_dir(t.logs.sparkSession, "snapshots")
    facts = materialise(_snapshots(t), "snapshot-facts")
    for day in (*SNAPSHOTS, SNAPSHOTS[-1]):
        files.write_snapshot(facts.filter(F.col("as_of_date") == F.lit(day)), path)
    return path


def _snapshot_latest(t: Tables) -> DataFrame:
    """The newest of three stored snapshots, asked for on a later day than any."""
    found = files.read_latest(t.logs.sparkSession, _stored_snapshots(t), FACT, date(2000, 7, 15))
    return _six(found, "trailing_90d_avg_rate", "max_monthly_rate")


def _snapshot_as_of(t: Tables) -> DataFrame:
    """Between two stored dates the earlier one counts."""
    found = files.read_latest(t.logs.sparkSession, _stored_snapshots(t), FACT, date(2000, 5, 15))
    return _six(found, "trailing_90d_avg_rate", "max_monthly_rate")


def _snapshot_dates(t: Tables) -> DataFrame:
    return files.stored_dates(t.logs.sparkSession, _stored_snapshots(t))


def _usage_store(t: Tables) -> tuple[str, str]:
    """The usage layer after three deliveries of log files; returns the log folder and the store."""
    spark = t.logs.sparkSession
    logs, store = work_dir(spark, "log-files"), work_dir(spark, "usage-store")
    part = F.pmod(F.xxhash64("log_id"), F.lit(3))
    rows = materialise(t.logs.withColumn("_part", part), "log-rows")
    for k in range(3):
        delivered = rows.filter(F.col("_part") == k).drop("_part")
        delivered.repartitionByRange("date", "log_id").write.parquet(f"{logs}/delivery={k}")
        usage_store.refresh(spark, logs, store)
    return logs, store


def _usage_layer(t: Tables) -> DataFrame:
    spark = t.logs.sparkSession
    stored = usage_store.read(spark, _usage_store(t)[1])
    return stored.select(
        "account_id", "date", from_units(F.col("units")).alias("credits_consumed"), "log_count"
    )


def _fact_from_layer(t: Tables) -> DataFrame:
    """The account fact from the stored usage layer instead of the raw logs."""
    stored = usage_store.read(t.logs.sparkSession, _usage_store(t)[1])
    return _six(_fact(replace(t, logs=stored)), "trailing_90d_avg_rate", "max_monthly_rate")


def _run_logs(t: Tables) -> DataFrame:
    """A run, a run whose second dimension fails, and a correction, as their writes logged them."""
    spark = t.logs.sparkSession
    root = work_dir(spark, "runs")
    # Each run writes the fact, which is the same for all; it is computed once.
    fact = materialise(_fact(t), "run-fact")
    broken = t.reps.withColumn("name", F.raise_error(F.lit("no such rep")))
    for run_id, reps, kind, note, approver in (
        ("run", t.reps, "manual", None, None),
        ("broken", broken, "scheduled", None, None),
        ("again", t.reps, "correction", "late amendment", "finance"),
    ):
        layers = {
            "account_fact": (fact, "fact"),
            "dim_accounts": (history.dim_accounts(t.accounts), "dim"),
            "dim_reps": (history.dim_reps(reps), "dim"),
            "dim_contracts": (contracts.valid_contracts(t.contracts), "dim"),
        }
        run = audit.AuditedRun(
            spark, f"{root}/run_log", run_id, AS_OF, RUN_TS, triggered_by=kind, note=note, approved_by=approver
        )
        try:
            with run:
                for name, (df, layer) in layers.items():
                    run.write(name, df, lambda out: files.write_table(out, f"{root}/{name}"), layer)
        except Exception:
            if run_id != "broken":
                raise
    return audit.read_run_log(spark, f"{root}/run_log")


def _owner_days(t: Tables) -> DataFrame:
    days = usage.guarded_daily(t).select("account_id", "date")
    return contracts.owner_as_of(days, contracts.owner_history(t.contracts), "date")


_add(
    dim_accounts=lambda t: history.dim_accounts(t.accounts),
    dim_reps=lambda t: history.dim_reps(t.reps),
    dim_contracts=lambda t: history.dim_contracts(contracts.contract_types(t.contracts)),
    dim_dates=lambda t: calendar.with_calendar(
        t.logs.groupBy("date").agg(F.count(F.lit(1)).alias("usage_logs"))
    ),
    owner_as_of=_owner_days,
    snapshot_latest=_snapshot_latest,
    snapshot_as_of=_snapshot_as_of,
    snapshot_dates=_snapshot_dates,
    usage_layer=_usage_layer,
    account_metrics_stored=_fact_from_layer,
    retention_metrics=lambda t: history.retention_metrics(t.contracts, date(1999, 6, 30), AS_OF),
    success_kpis=lambda t: history.success_kpis(
        account_fact(t, [EARLIER, SOON, AS_OF]), AS_OF, SOON, EARLIER
    ),
    run_log=lambda t: _run_logs(t).filter("run_id = 'run-20000630'").drop(
        "run_timestamp", "correction_note", "correction_approved_by", "failed_layer"
    ),
    run_log_all=lambda t: _run_logs(t).drop("run_timestamp"),
    key_remap=lambda t: history.key_remap(
        t.reps.select(
            (-1 - F.col("employee_id")).alias("employee_id"),
            F.col("name").alias("rep_name"),
            "region",
            # Half a segment's worth of targets is missing, so positions cycle.
            F.when(F.col("employee_id") % 2 == 0, "Enterprise").otherwise(F.col("segment")).alias("segment"),
        ),
        t.reps,
        ["region", "segment"],
        "rep_name",
    ),
)


def _with_amendments(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tpch.load(spark, sf_dir)
    return history.contracts_as_of(t.contracts, tpch.amendments(spark, sf_dir), AS_OF)


def _corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tpch.load(spark, sf_dir)
    amended = Tables(t.reps, t.accounts, _with_amendments(spark, sf_dir), t.logs)
    return history.snapshot_corrections(_fact(t), _fact(amended))


def _contract_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.scd2_contracts(
        tpch.contracts(spark, sf_dir), tpch.amendments(spark, sf_dir)
    )


_QUERIES["contracts_as_of"] = _with_amendments
_QUERIES["snapshot_corrections"] = _corrections
_QUERIES["scd2_contracts"] = _contract_versions
_QUERIES["scd2_reps"] = lambda spark, sf_dir: history.scd2(
    tpch.rep_changes(spark, sf_dir), "employee_id", "observed_on", ["segment"]
)


def _rep_dimension(spark: SparkSession, sf_dir: str) -> dimension_store.Dimension:
    """Rep versions after four deliveries; the last one has days that the others had passed."""
    dim = dimension_store.Dimension(
        work_dir(spark, "dim-reps"), "employee_id", {"segment": "string"}, {"segment": "territory_reassignment"}, buckets=8
    )
    late = (F.col("employee_id") % 7 == 3) & (F.month("observed_on") == 4)
    year = F.year("observed_on")
    part = F.when(late, 3).when(year < 1997, 0).when(year < 1999, 1).otherwise(2)
    rows = materialise(tpch.rep_changes(spark, sf_dir).withColumn("_part", part), "rep-changes")
    for k in range(4):
        dimension_store.merge(dim, rows.filter(F.col("_part") == k), "observed_on", RUN_TS)
    return dim


def _stored_reps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension_store.read(spark, _rep_dimension(spark, sf_dir)).drop("dw_created_at")


def _stored_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract versions after two deliveries of what was known up to a date."""
    dim = dimension_store.Dimension(
        work_dir(spark, "dim-contracts"),
        "contract_id",
        dict(history.AMENDABLE),
        dict.fromkeys(history.AMENDABLE, "contract_amendment"),
        buckets=8,
    )
    rows = materialise(
        history.contract_observations(tpch.contracts(spark, sf_dir), tpch.amendments(spark, sf_dir)), "contract-days"
    )
    before = F.year("observed_on") < 1998
    for part in (before, ~before):
        dimension_store.merge(dim, rows.filter(part), "observed_on", RUN_TS)
    return dimension_store.read(spark, dim).drop("dw_created_at")


def _bound_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account fact bound to the version of its rep that held on the snapshot's day."""
    fact = _fact(tpch.load(spark, sf_dir))
    bound = dimension_store.bind(
        fact, spark, _rep_dimension(spark, sf_dir), "employee_id", "as_of_date", "rep_surrogate_key", ["account_id"]
    )
    return bound.select("account_id", "as_of_date", "employee_id", "rep_surrogate_key", "health_tier", "cacv")


def _corrected(spark: SparkSession, sf_dir: str) -> str:
    """Three stored snapshots, then a correction of the last one for amendments that became known later."""
    t = tpch.load(spark, sf_dir)
    store = work_dir(spark, "fact-store")
    fact_store.write(spark, store, _snapshots(t), "first", buckets=8)
    amended = replace(t, contracts=_with_amendments(spark, sf_dir))
    why = fact_store.Correction("amendments signed late", "revops", "cfo", paid_through=AS_OF, at=RUN_TS)
    fact_store.write(spark, store, _fact(amended), "second", why, buckets=8)
    return store


def _fact_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_store.corrections(spark, _corrected(spark, sf_dir)).drop("corrected_at")


def _fact_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_store.read(spark, _corrected(spark, sf_dir)).select(
        "account_id", "as_of_date", "health_tier", "cacv", "pipeline_run_id", "is_correction"
    )


_QUERIES["scd2_reps_stored"] = _stored_reps
_QUERIES["scd2_contracts_stored"] = _stored_contracts
_QUERIES["fact_bound"] = _bound_fact
_QUERIES["fact_corrections"] = _fact_corrections
_QUERIES["fact_provenance"] = _fact_provenance


# Streams, each driven over the whole events table
def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.event_stream(spark, sf_dir, tpch.raw_schema("events"))


def _stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = jobs.run_available(spark, jobs.daily_usage(_events(spark, sf_dir)), "daily")
    return spark.read.schema(
        "account_id BIGINT, date DATE, credits_consumed DOUBLE, log_count BIGINT"
    ).parquet(path)


def _stream_daily_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day, also those the watermark has not passed yet."""
    path = work_dir(spark, "daily-updates")
    updates = jobs.daily_updates(_events(spark, sf_dir))
    jobs.run_available(spark, updates, "daily-log", foreach=jobs.daily_upsert(path), mode="update")
    return jobs.daily_table(spark, path)


def _stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums and late rows of the events in two deliveries, the later half of the month first.

    What the second delivery brings for days already final is late.
    """
    root = work_dir(spark, "late")
    events = tpch.raw(spark, sf_dir, "events")
    later = F.coalesce(F.col("ts") >= F.lit(LATE_FROM), F.lit(False))
    write = jobs.daily_with_late(f"{root}/daily", f"{root}/late")
    for kept in (later, ~later):
        events.filter(kept).write.mode("append").parquet(f"{root}/events")
        source = spark.readStream.schema(events.schema).parquet(f"{root}/events")
        query = (
            jobs.usage_events(source)
            .writeStream.trigger(availableNow=True)
            .option("checkpointLocation", f"{root}/checkpoint")
            .foreachBatch(write)
            .start()
        )
        query.awaitTermination()
    daily = jobs.daily_sums(spark, f"{root}/daily").withColumn("route", F.lit("daily"))
    late = (
        jobs.late_rows(spark, f"{root}/late")
        .groupBy("account_id", "date")
        .agg(
            F.sum(F.col("credits").cast("decimal(28,12)")).cast("double").alias("credits_consumed"),
            F.count(F.lit(1)).alias("log_count"),
        )
        .withColumn("route", F.lit("late"))
    )
    return daily.unionByName(late)


def _stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event arrives twice; one of each remains."""
    twice = _events(spark, sf_dir).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2))))
    path = jobs.run_available(spark, jobs.dedup(twice.drop("_copy")), "dedup")
    rows = spark.read.schema(
        "log_id BIGINT, account_id BIGINT, ts TIMESTAMP, credits DOUBLE"
    ).parquet(path)
    return rows.select("log_id", "account_id", utc_clock(F.col("ts")).cast("date").alias("date"), "credits")


def event_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contract per known customer that covers part of the events' month."""
    key = F.col("c_custkey")
    start = F.date_add(F.lit(date(2023, 12, 25)), (key % 20).cast("int"))
    return tpch.raw(spark, sf_dir, "customer").select(
        key.alias("contract_id"),
        key.alias("account_id"),
        start.alias("start_date"),
        F.date_add(start, 15).alias("end_date"),
    )


def _routed(spark: SparkSession, root: str) -> DataFrame:
    schema = "log_id BIGINT, account_id BIGINT, ts TIMESTAMP, credits DOUBLE, date DATE, batch_id BIGINT"

    def read(kind: str) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{root}/{kind}").select(
            "log_id", "account_id", "date", "credits", F.lit(kind).alias("route")
        )

    return read("accepted").unionByName(read("rejected"))


def _stream_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "guarded")
    accounts = tpch.accounts(spark, sf_dir).select("account_id")
    sink = jobs.guarded(
        accounts, event_contracts(spark, sf_dir), f"{root}/accepted", f"{root}/rejected"
    )
    jobs.run_available(spark, _events(spark, sf_dir), "guarded-log", foreach=sink)
    return _routed(spark, root)


def _stream_guarded_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in two deliveries; before the second one every contract is extended by ten days."""
    root = work_dir(spark, "guarded-versions")
    known = event_contracts(spark, sf_dir)
    state = {"version": "signed", "contracts": known}
    sink = jobs.guarded(
        tpch.accounts(spark, sf_dir).select("account_id"),
        lambda: state["contracts"],
        f"{root}/accepted",
        f"{root}/rejected",
        version=lambda: state["version"],
    )
    events = tpch.raw(spark, sf_dir, "events")
    for part in (0, 1):
        if part:
            state |= {"version": "extended", "contracts": known.withColumn("end_date", F.date_add("end_date", 10))}
        events.filter(F.col("event_id") % 2 == part).write.mode("append").parquet(f"{root}/events")
        stream = jobs.usage_events(spark.readStream.schema(events.schema).parquet(f"{root}/events"))
        query = (
            stream.writeStream.trigger(availableNow=True)
            .option("checkpointLocation", f"{root}/checkpoint")
            .foreachBatch(sink)
            .start()
        )
        query.awaitTermination()
    return _routed(spark, root)


def _stream_inactivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-day silences; the events span one month."""
    stream = jobs.inactivity(_events(spark, sf_dir), quiet="12 hours")
    path = jobs.run_available(spark, stream, "silence")
    alerts = spark.read.schema(
        "account_id BIGINT, silent_since TIMESTAMP_NTZ, alerted_at TIMESTAMP_NTZ, events_before BIGINT"
    ).parquet(path)
    return alerts.select(
        "account_id", F.date_format("silent_since", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("silent_since"), "events_before"
    )


def event_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of one 40-day contract per customer; twenty allowances."""
    reader = spark.readStream.schema(tpch.raw_schema("customer")).option("pathGlobFilter", "customer.parquet")
    key = F.col("c_custkey")
    start = F.date_add(F.lit(date(2023, 12, 25)), (key % 20).cast("int"))
    return reader.parquet(sf_dir).select(
        key.alias("account_id"),
        start.alias("start_date"),
        F.date_add(start, 39).alias("end_date"),
        (18000 + 6000 * (key % 4)).alias("included_monthly_compute_credits"),
    )


def _stream_low_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days in a row under 5% of the allowance; the events span one month."""
    with state_store(spark):
        stream = low_use.low_use_alerts(_events(spark, sf_dir), event_terms(spark, sf_dir), days=3)
        path = jobs.run_available(spark, stream, "low-use")
    alerts = spark.read.schema(low_use.ALERTS).parquet(path)
    return alerts.withColumn("credits_in_run", F.col("credits_in_run").cast("double"))


_QUERIES["stream_daily_usage"] = _stream_daily_all
_QUERIES["stream_daily_usage_final"] = _stream_daily
_QUERIES["stream_daily_usage_all"] = _stream_daily_all
_QUERIES["stream_late_usage"] = _stream_late
_QUERIES["stream_dedup"] = _stream_dedup
_QUERIES["stream_guarded"] = _stream_guarded
_QUERIES["stream_guarded_versions"] = _stream_guarded_versions
_QUERIES["stream_silence"] = _stream_inactivity
_QUERIES["stream_inactivity"] = _stream_low_use


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
