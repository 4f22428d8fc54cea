from __future__ import annotations

import json
import re
from dataclasses import replace
from datetime import date, datetime
from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import functions as F

from drawdown.model import ACCOUNT_FACT
from drawdown.operators.calendar import dim_dates
from drawdown.operators.metrics import account_fact
from drawdown.plans import catalog
from drawdown.plans.batch_run import build_all
from drawdown.session import materialise, state_store, work_dir
from drawdown.sources import files, tpch
from drawdown.streaming import jobs, low_use
from tests.build import AS_OF, contract, d, log, rows, tables


@pytest.fixture(scope="module")
def small(spark):
    return tables(
        spark,
        [contract(1, 1, "2024-07-01", "2025-12-31"), contract(2, 2, "2024-07-01", "2025-08-31")],
        [log(i, 1, f"2025-0{m}-10", 90) for i, m in enumerate((3, 4, 5))],
    )


def test_tables_round_trip(spark, small, tmp_path):
    for name, df in zip(files.RAW_SCHEMAS, (small.reps, small.accounts, small.contracts)):
        files.write_table(df, f"{tmp_path}/{name}")
    files.write_usage(small.logs, f"{tmp_path}/daily_usage_logs")
    again = files.load(spark, str(tmp_path))
    assert sorted(account_fact(again, AS_OF).collect()) == sorted(account_fact(small, AS_OF).collect())
    files.write_table(small.accounts, f"{tmp_path}/accounts")
    assert files.load(spark, str(tmp_path)).accounts.count() == 2


def test_usage_scan_is_pruned_to_its_months(spark, small, tmp_path):
    files.write_usage(small.logs, f"{tmp_path}/u")
    scan = spark.read.parquet(f"{tmp_path}/u").filter("usage_month < date'2025-04-01'")
    assert scan.count() == 1
    assert "PartitionFilters: [isnotnull(usage_month" in _plan(scan)


def test_snapshot_rerun_replaces_only_its_date(spark, small, tmp_path):
    path = f"{tmp_path}/fact"
    run = datetime(2025, 7, 1)
    for day in (date(2025, 3, 31), AS_OF, AS_OF):
        files.write_snapshot(account_fact(small, day, run_ts=run), path)
    got = files.read_snapshots(spark, path, ACCOUNT_FACT)
    assert {r.as_of_date: r["count"] for r in got.groupBy("as_of_date").count().collect()} == {
        date(2025, 3, 31): 2, AS_OF: 2
    }
    assert "PartitionFilters" in _plan(got.filter(F.col("as_of_date") == F.lit(AS_OF)))


def test_csv_and_json_exports(spark, small, tmp_path):
    fact = account_fact(small, AS_OF)
    files.export_csv(fact, f"{tmp_path}/csv")
    back = files.read_csv_snapshot(spark, f"{tmp_path}/csv", fact.schema)
    assert sorted(back.collect()) == sorted(fact.collect())
    files.export_json(fact.select("account_id", "cacv"), f"{tmp_path}/json")
    lines = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/json").collect()]
    assert {x["account_id"] for x in lines} == {1, 2}


def test_build_all_writes_every_layer(spark, small, tmp_path):
    run = build_all(spark, small, AS_OF, str(tmp_path), datetime(2025, 7, 1, 8))
    assert run.fact.count() == 2
    assert {n for n, df in run.outputs.items() if df.count() == 0} == set()
    assert spark.table("org_summary").count() == 2
    assert run.outputs["run_log"].first().rows_written_fact == 2


def test_work_dir_follows_the_session(spark):
    assert materialise(spark.range(3), "t").count() == 3
    conf = SimpleNamespace(get={"spark.checkpoint.dir": "/shared/place/"}.get)
    assert work_dir(SimpleNamespace(conf=conf), "x").startswith("/shared/place/x-")


def test_calendar_edges(spark):
    got = rows(dim_dates(spark), "date")
    assert len(got) == 11323 and len(got[d("2025-07-31")]) == 31
    assert got[d("2025-07-31")]["fiscal_year_quarter"] == "FY2025-Q4"
    assert got[d("2025-08-01")]["fiscal_year_quarter"] == "FY2026-Q1"
    assert (got[d("2025-08-01")]["fiscal_month"], got[d("2025-07-31")]["fiscal_month"]) == (1, 12)
    assert [got[d(f"2025-01-0{n}")]["week_of_year"] for n in (1, 4, 5)] == [0, 0, 1]
    leap = got[d("2024-02-29")]
    assert leap["is_month_end"] and leap["date_id"] == 20240229 and leap["day_of_week"] == 5
    january = dim_dates(spark, "2025-01-01", "2025-01-31", fy_start_month=1)
    assert january.first().fiscal_year_quarter == "FY2025-Q1"


def _stream(spark, tmp_path, batches, name):
    """One file, and so one micro-batch, per list of (id, account, clock, credits)."""
    schema = "event_id long, user_id long, ts timestamp_ntz, value double"
    for i, batch in enumerate(batches):
        data = [(e, u, datetime.fromisoformat(ts), v) for e, u, ts, v in batch]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(
            f"{tmp_path}/{name}/part={i}"
        )
    source = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(*[f"{tmp_path}/{name}/part=*"])
    )
    return jobs.usage_events(source)


def test_daily_usage_drops_what_comes_after_the_watermark(spark, tmp_path):
    batches = [
        [(1, 1, "2024-01-01T10:00", 5.0), (2, 1, "2024-01-10T10:00", 1.0)],
        [(3, 1, "2024-01-12T10:00", 2.0)],
        # Two batches on, the watermark has long passed the second of January.
        [(4, 1, "2024-01-02T10:00", 7.0), (5, 1, "2024-01-20T00:00", 1.0)],
    ]
    path = jobs.run_available(spark, jobs.daily_usage(_stream(spark, tmp_path, batches, "late")), "t")
    got = {(r.date, r.credits_consumed) for r in spark.read.parquet(path).collect()}
    assert got == {(d("2024-01-01"), 5.0), (d("2024-01-10"), 1.0), (d("2024-01-12"), 2.0)}


def test_daily_updates_hold_the_last_days_and_survive_a_replay(spark, tmp_path):
    batches = [
        [(1, 1, "2024-01-01T10:00", 5.0), (2, 2, "2024-01-02T10:00", 1.0)],
        [(3, 1, "2024-01-01T12:00", 2.0), (4, 1, "2024-01-04T00:00", 3.0)],
    ]
    table = f"{tmp_path}/daily"
    write = jobs.daily_upsert(table)
    updates = jobs.daily_updates(_stream(spark, tmp_path, batches, "updates"))
    jobs.run_available(spark, updates, "t", foreach=write, mode="update")
    want = {
        (1, d("2024-01-01"), 7.0, 2, True),
        (2, d("2024-01-02"), 1.0, 1, False),
        (1, d("2024-01-04"), 3.0, 1, False),
    }

    def got():
        return [tuple(r) for r in jobs.daily_table(spark, table).collect()]

    assert set(got()) == want and len(got()) == len(want)
    newest = spark.read.parquet(table).agg(F.max("batch_id")).first()[0]
    again = spark.read.schema(jobs.DAILY).parquet(table).filter(F.col("batch_id") == newest).drop("batch_id")
    again = spark.createDataFrame(again.collect(), again.schema)
    write(again, newest)
    assert set(got()) == want and len(got()) == len(want)


def test_dedup_across_batches(spark, tmp_path):
    batches = [
        [(1, 1, "2024-01-01T10:00", 5.0), (1, 1, "2024-01-01T10:00", 5.0)],
        [(1, 1, "2024-01-01T10:00", 5.0), (2, 1, "2024-01-01T11:00", 6.0)],
    ]
    path = jobs.run_available(spark, jobs.dedup(_stream(spark, tmp_path, batches, "twice")), "t")
    assert sorted(r.log_id for r in spark.read.parquet(path).collect()) == [1, 2]


def test_guarded_stream_equals_batch_and_survives_a_replay(spark, tmp_path, small):
    batches = [
        [(1, 1, "2025-03-01T00:00", 1.0), (2, 9, "2025-03-01T00:00", 1.0)],
        [(3, 2, "2025-08-31T23:59", 1.0), (4, 2, "2025-09-01T00:00", 1.0)],
    ]
    sinks = f"{tmp_path}/ok", f"{tmp_path}/no"
    write = jobs.guarded(small.accounts, small.contracts, *sinks)
    jobs.run_available(spark, _stream(spark, tmp_path, batches, "guard"), "t", foreach=write)

    def ids():
        return [sorted(r.log_id for r in spark.read.parquet(p).collect()) for p in sinks]

    assert ids() == [[1, 3], [2, 4]]
    again = spark.createDataFrame(
        [(3, 2, datetime(2025, 8, 31, 23), 1.0)], "log_id long, account_id long, ts timestamp, credits double"
    )
    write(again, 1)
    write(again, 1)
    assert ids()[0] == [1, 3]


def test_inactivity_reports_each_quiet_spell(spark, tmp_path):
    batches = [
        [(1, 1, "2024-01-01T00:00", 1.0), (2, 1, "2024-01-01T20:00", 1.0)],
        [(3, 1, "2024-01-05T00:00", 1.0), (4, 2, "2024-01-09T00:00", 1.0)],
    ]
    stream = jobs.inactivity(_stream(spark, tmp_path, batches, "quiet"), "1 day")
    got = spark.read.parquet(jobs.run_available(spark, stream, "t")).collect()
    assert {(r.account_id, r.silent_since.day, r.events_before) for r in got} == {(1, 1, 2), (1, 5, 1)}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


PLANNED = [
    "active_contracts", "orphan_guard", "in_contract_logs", "out_of_contract_usage",
    "overlapping_pairs", "overlap_profile", "monthly_usage_fanout", "rolling_rates_daily",
    "onboarding_stall", "account_metrics", "account_detail", "org_summary", "attainment_cube",
    "dq_orphaned_usage", "dq_out_of_contract", "metric_invariants", "consistent_overage",
    "comp_am_yearly", "owner_as_of", "scd2_contracts", "snapshot_latest", "key_remap",
]


def test_no_plan_multiplies_tables_or_leaves_the_jvm(spark, sf_dir):
    """Also with broadcasts off, as for sides too large for one."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in PLANNED:
            plan = _plan(catalog.queries()[name](spark, sf_dir))
            found = re.findall(r"CartesianProduct|BroadcastNestedLoopJoin|\w*Python\w*|\w*Pandas\w*", plan)
            assert not found, (name, found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scans_read_only_what_they_need(spark, sf_dir):
    plan = _plan(account_fact(tpch.load(spark, sf_dir), tpch.AS_OF))
    scans = set(re.findall(r"FileScan parquet \[(l_orderkey[^\]]*)\]", plan))
    assert {re.sub(r"#\d+L?", "", s) for s in scans} == {"l_orderkey,l_quantity,l_shipdate"}


def test_native_logs_push_the_date_bound_down(spark, small, tmp_path):
    files.write_table(small.logs, f"{tmp_path}/logs")
    schema = small.logs.schema
    logs = spark.read.schema(schema).parquet(f"{tmp_path}/logs")
    plan = _plan(account_fact(replace(small, logs=logs), AS_OF))
    assert "LessThan(date,2025-06-01)" in plan
    # The lower bound is a value the contracts give when the query runs.
    assert re.search(r"DataFilters: \[[^\]]*\(date#\d+ >= Subquery", plan)


# The whole catalog is compared with DuckDB by the driver; here a cross-section.
COMPARED = [
    "account_metrics", "rep_rollup", "org_summary", "overlapping_pairs", "onboarding_stall",
    "dq_report", "comp_am_yearly", "scd2_contracts", "stream_daily_usage", "stream_inactivity",
]


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_oracle(spark, sf_dir, name):
    import __spark_entry__ as entry

    con = duckdb.connect()
    for table in ("region", "nation", "customer", "supplier", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = [tuple(r[c] for c in columns) for r in df.collect()]
    relation = con.sql(entry.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    theirs = con.sql(entry.oracle_sql()[name]).select(
        *[duckdb.ColumnExpression(c) for c in columns]
    ).fetchall()
    assert sorted(ours, key=str) == sorted(theirs, key=str)


def test_every_query_has_an_oracle(spark):
    import __spark_entry__ as entry
    from drawdown.plans import oracles

    assert set(catalog.queries()) == set(oracles.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_daily_updates_equal_the_oracle_over_all_days(spark, sf_dir):
    test_query_equals_oracle(spark, sf_dir, "stream_daily_usage_all")


def _terms(spark, tmp_path, deliveries):
    schema = "account_id long, start_date date, end_date date, included_monthly_compute_credits double"
    for i, rows_ in enumerate(deliveries):
        data = [(a, d(s), d(e), c) for a, s, e, c in rows_]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/terms/part={i}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/terms/part=*")


def test_low_use_fires_on_low_use_and_on_silence_and_once_per_run(spark, tmp_path):
    """Allowance 300 a month, 10 a day: a day under 0.5 is low; three in a row raise an alert."""
    batches = [
        [(1, 1, "2024-01-01T10:00", 9.0), (2, 1, "2024-01-02T10:00", 0.25), (3, 1, "2024-01-02T11:00", 0.125)],
        [(4, 1, "2024-01-04T10:00", 0.0625), (5, 3, "2024-01-04T10:00", 5.0)],
        [(6, 1, "2024-01-07T10:00", 9.0)],
        [(8, 3, "2024-01-20T00:00", 5.0), (7, 1, "2024-01-02T00:00", 9.0)],  # the last is late and dropped
    ]
    deliveries = [
        [(1, "2024-01-01", "2024-01-31", 300.0), (2, "2024-01-03", "2024-01-05", 300.0)],
        [(4, "2024-01-05", "2024-01-06", 300.0)],
        [(3, "2024-01-02", "2024-01-31", 0.0)],
    ]
    with state_store(spark):
        stream = low_use.low_use_alerts(
            _stream(spark, tmp_path, batches, "low"), _terms(spark, tmp_path, deliveries), days=3, lateness="1 day"
        )
        got = spark.read.schema(low_use.ALERTS).parquet(jobs.run_available(spark, stream, "t")).collect()
    assert sorted((r.account_id, r.quiet_since, r.flagged_on, float(r.credits_in_run)) for r in got) == [
        (1, d("2024-01-02"), d("2024-01-04"), 0.4375),  # low use, not silence; longer runs say nothing new
        (1, d("2024-01-08"), d("2024-01-10"), 0.0),
        (2, d("2024-01-03"), d("2024-01-05"), 0.0),  # never sent an event; account 4's term is too short, 3 has no allowance
    ]


def test_low_use_accounts_that_share_a_state_row_stay_apart(spark, tmp_path):
    """Accounts of one group, one of them null, alert each by itself."""
    terms = [(a, f"2024-01-0{n}", "2024-01-31", 300.0) for a, n in ((1, 1), (2, 2), (None, 3))]
    events = [[(1, 2, "2024-01-03T10:00", 9.0)], [(2, 9, "2024-01-09T12:00", 1.0)]]
    with state_store(spark):
        stream = low_use.low_use_alerts(
            _stream(spark, tmp_path, events, "shared"), _terms(spark, tmp_path, [terms]), days=3, lateness="0 seconds", groups=1
        )
        got = spark.read.schema(low_use.ALERTS).parquet(jobs.run_available(spark, stream, "t")).collect()
    assert sorted(((r.account_id, r.quiet_since, r.flagged_on) for r in got), key=str) == [
        (1, d("2024-01-01"), d("2024-01-03")),
        (2, d("2024-01-04"), d("2024-01-06")),
        (None, d("2024-01-03"), d("2024-01-05")),
    ]


def test_low_use_goes_on_from_its_checkpoint(spark, tmp_path):
    """A restart with the same checkpoint repeats nothing and forgets nothing."""
    term = [(1, "2024-01-01", "2024-01-31", 300.0)]
    parts = [[(1, 1, "2024-01-01T10:00", 9.0), (2, 9, "2024-01-04T12:00", 1.0)], [(3, 9, "2024-01-06T12:00", 1.0)]]
    with state_store(spark):
        for n in (1, 2, 2):
            if n == 1 or not (tmp_path / "again/part=1").exists():
                batch = [(e, u, datetime.fromisoformat(t), v) for e, u, t, v in parts[n - 1]]
                frame = spark.createDataFrame(batch, "event_id long, user_id long, ts timestamp_ntz, value double")
                frame.coalesce(1).write.parquet(f"{tmp_path}/again/part={n - 1}")
            source = spark.readStream.schema(frame.schema).parquet(f"{tmp_path}/again/part=*")
            terms = _terms(spark, tmp_path, [term] if n == 1 and not (tmp_path / "terms").exists() else [])
            alerts = low_use.low_use_alerts(jobs.usage_events(source), terms, days=3, lateness="0 seconds")
            query = (
                alerts.writeStream.trigger(availableNow=True)
                .option("checkpointLocation", f"{tmp_path}/checkpoint")
                .format("parquet").option("path", f"{tmp_path}/alerts").start()
            )
            query.awaitTermination()
            got = [r.quiet_since for r in spark.read.schema(low_use.ALERTS).parquet(f"{tmp_path}/alerts").collect()]
            assert got == ([] if n == 1 else [d("2024-01-02")])


def test_late_rows_and_daily_sums_hold_every_event_once_and_survive_a_replay(spark, tmp_path):
    batches = [
        [(1, 1, "2024-01-05T10:00", 5.0), (2, 1, "2024-01-01T10:00", 0.1)],  # nothing is final in the first batch
        [(3, 1, "2024-01-05T11:00", 2.0), (4, 1, "2024-01-03T23:00", 3.0), (5, 2, "2024-01-02T23:59", 7.0)],
        [(6, 2, "2024-01-09T00:00", 1.0), (7, 1, "2024-01-03T05:00", 1.0)],
        [(8, 1, "2024-01-06T23:00", 4.0), (9, 1, "2024-01-07T00:00", 4.0), (10, 1, "2024-01-03T05:00", 1.0)],
    ]
    daily, late = f"{tmp_path}/daily", f"{tmp_path}/late"
    write = jobs.daily_with_late(daily, late)
    kept = []

    def keep(batch, batch_id):
        kept.append((spark.createDataFrame(batch.collect(), batch.schema), batch_id))
        write(batch, batch_id)

    jobs.run_available(spark, _stream(spark, tmp_path, batches, "late-rows"), "t", foreach=keep)

    def got():
        sums = {(r.account_id, r.date): (r.credits_consumed, r.log_count) for r in jobs.daily_sums(spark, daily).collect()}
        return sums, sorted(r.log_id for r in jobs.late_rows(spark, late).collect())

    want = {
        (1, d("2024-01-05")): (7.0, 2), (1, d("2024-01-01")): (0.1, 1), (1, d("2024-01-03")): (4.0, 2),
        (2, d("2024-01-09")): (1.0, 1), (1, d("2024-01-07")): (4.0, 1),
    }
    assert got() == (want, [5, 8, 10])
    for batch, batch_id in (kept[1], kept[3], kept[3]):
        write(batch, batch_id)
    assert got() == (want, [5, 8, 10])
