"""Scans cut to what a fact needs, the incremental usage layer, and stored snapshots."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from drawdown.model import ACCOUNT_FACT
from drawdown.operators import rates, usage
from drawdown.operators.contracts import active_contracts
from drawdown.operators.metrics import account_fact, account_metrics
from drawdown.plans import audit
from drawdown.plans.batch_run import build_all
from drawdown.sources import files, usage_store
from tests.build import AS_OF, contract, d, log, tables


def whole_history(t, as_of):
    """The fact from every month of the grid and every log before as-of."""
    newest = max(as_of) if isinstance(as_of, list) else as_of
    stats = rates.trailing_stats(usage.monthly_consumption(t, before=newest.replace(day=1)), as_of)
    return account_metrics(active_contracts(t.contracts, t.accounts, as_of), stats)


@pytest.fixture(scope="module")
def gaps(spark):
    """Accounts with long and short gaps, short contracts, overlaps, open months and unknown accounts."""
    rng = random.Random(8)
    contracts, logs = [], []
    for account in range(40):
        day = date(2022, 1, 1) + timedelta(days=rng.randint(0, 400))
        while day < date(2025, 12, 1):
            end = day + timedelta(days=rng.choice([10, 20, 45, 70, 200, 364]))
            contracts.append((len(contracts), account, 1, day, end, 1200, rng.choice([0, 50, 100]), 12))
            day = end + timedelta(days=rng.choice([-30, 1, 5, 40, 90, 200]))
        logs += [(account, date(2022, 1, 1) + timedelta(days=rng.randint(0, 1300)), rng.random() * 40) for _ in range(150)]
    # Renewed after two years, with one month of three in the window.
    contracts += [(900, 50, 1, d("2022-03-10"), d("2022-04-20"), 1200, 100, 12), (901, 50, 1, d("2025-05-02"), d("2025-12-31"), 900, 80, 12)]
    logs += [(50, d("2022-03-15"), 70.0), (50, d("2022-04-20"), 30.0), (50, d("2022-04-21"), 500.0), (50, d("2025-05-05"), 8.0)]
    accounts = [(a, f"c{a}", "x", 1) for a in (*range(38), 50)]
    rows = [(i, a, day, c) for i, (a, day, c) in enumerate(logs)]
    return tables(spark, contracts, rows, accounts)


@pytest.mark.parametrize("as_of", [AS_OF, [d("2024-12-31"), d("2025-03-31"), AS_OF], [d("2023-02-14"), d("2025-05-01")]])
def test_pruned_fact_equals_the_whole_history(gaps, as_of):
    got = account_fact(gaps, as_of).collect()
    assert sorted(got, key=str) == sorted(whole_history(gaps, as_of).collect(), key=str) and len(got) > 15


def test_older_months_are_those_of_gap_accounts(gaps):
    recent, older, short = usage.recent_months(gaps, AS_OF, 3)
    got = {(r.account_id, r._month) for r in older.collect()}
    assert (50, 2022 * 12 + 3) in got and (50, 2022 * 12 + 2) in got
    low = {r.account_id: r._bound for r in short.collect()}
    assert all(month >= low[account] for account, month in got)
    assert {r._month for r in recent.collect()} <= {2025 * 12 + m for m in (2, 3, 4)}


def test_months_nobody_needs_are_not_opened(spark, gaps, tmp_path):
    """A month's only file is broken: whoever opens it fails."""
    whole = f"{tmp_path}/logs"
    files.write_usage(gaps.logs, whole)
    for file in Path(whole).glob("usage_month=2021-*/*.parquet"):
        raise AssertionError(file)
    for month in ("2022-01-01", "2022-02-01"):
        for file in Path(f"{whole}/usage_month={month}").glob("*.parquet"):
            file.write_bytes(b"not parquet")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    stored = spark.read.schema("log_id LONG, account_id LONG, date DATE, compute_credits_consumed DOUBLE, usage_month DATE").parquet(whole)
    few = replace(gaps, contracts=gaps.contracts.filter("account_id = 50"), logs=stored)
    assert account_fact(few, AS_OF).first().months_of_data == 3
    with pytest.raises(Exception):  # noqa: B017 - whatever the reader raises
        whole_history(few, AS_OF).collect()


def plain(spark, store):
    return sorted((r.account_id, r.date, r.units, r.log_count) for r in usage_store.read(spark, store).collect())


def full(spark, folder):
    logs = spark.read.schema("log_id LONG, account_id LONG, date DATE, compute_credits_consumed DOUBLE").parquet(folder)
    return sorted((r.account_id, r.date, r.units, r.log_count) for r in usage.daily_totals(logs).collect())


def deliver(spark, folder, name, logs):
    """One log file under a name of its own."""
    there = f"{folder}-{name}-{len(logs)}"
    spark.createDataFrame([log(*x) for x in logs], "log_id LONG, account_id LONG, date DATE, compute_credits_consumed DOUBLE").coalesce(1).write.parquet(there)
    (file,) = Path(there).glob("*.parquet")
    Path(folder).mkdir(exist_ok=True)
    file.rename(f"{folder}/{name}.parquet")
    return Path(f"{folder}/{name}.parquet")


@pytest.fixture
def delivered(spark, tmp_path):
    folder, store = f"{tmp_path}/logs", f"{tmp_path}/store"
    a = deliver(spark, folder, "a", [(1, 1, "2025-01-05", 2), (2, 1, "2025-01-05", 0.5), (3, 2, "2025-02-01", 1)])
    b = deliver(spark, folder, "b", [(4, 1, "2025-03-05", 4), (5, 2, "2025-02-01", 8)])
    assert usage_store.refresh(spark, folder, store) == 1
    return folder, store, a, b


def test_refresh_reads_new_files_only(spark, delivered):
    folder, store, a, b = delivered
    assert plain(spark, store) == full(spark, folder)
    content = a.read_bytes()
    stat = a.stat()
    a.write_bytes(b"x" * len(content))  # the same length and time: not looked at again
    import os

    os.utime(a, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    (a.parent / f".{a.name}.crc").unlink(missing_ok=True)
    deliver(spark, folder, "c", [(6, 1, "2025-01-05", 16), (7, 9, "2025-03-31", 1)])
    assert usage_store.refresh(spark, folder, store) == 2
    a.write_bytes(content)
    assert plain(spark, store) == full(spark, folder)
    # February was touched by no new file, so its rows are still those of the first run.
    assert usage_store._current(spark, store, [1, 2]) == {d("2025-01-01"): 2, d("2025-02-01"): 1, d("2025-03-01"): 2}
    assert not Path(f"{store}/daily/run=2/usage_month=2025-02-01").exists()


def test_replay_changes_nothing_and_a_failed_run_leaves_no_trace(spark, delivered, monkeypatch):
    folder, store, _, _ = delivered
    before = plain(spark, store)
    assert usage_store.refresh(spark, folder, store) is None
    deliver(spark, folder, "c", [(6, 1, "2025-01-05", 16)])
    write = usage_store._write

    def broken(df, path, *rest):
        if path.endswith("/commits"):
            raise RuntimeError("lost")
        write(df, path, *rest)

    monkeypatch.setattr(usage_store, "_write", broken)
    with pytest.raises(RuntimeError):
        usage_store.refresh(spark, folder, store)
    assert plain(spark, store) == before
    monkeypatch.setattr(usage_store, "_write", write)
    assert usage_store.refresh(spark, folder, store) == 2
    assert plain(spark, store) == full(spark, folder) != before
    assert usage_store.refresh(spark, folder, store) is None


def test_replaced_and_removed_files_are_summed_again(spark, delivered):
    folder, store, a, b = delivered
    a.unlink()
    b.unlink()
    deliver(spark, folder, "b", [(4, 1, "2025-03-05", 5), (5, 2, "2025-04-01", 8), (8, 2, "2025-04-01", 8)])
    deliver(spark, folder, "c", [(9, 3, "2025-01-09", 1)])
    assert usage_store.refresh(spark, folder, store) == 2
    assert plain(spark, store) == full(spark, folder)
    assert {r.path.rsplit("/")[-1] for r in usage_store.manifest(spark, store).collect()} == {"b.parquet", "c.parquet"}


def test_fact_reads_the_stored_layer(spark, gaps, tmp_path):
    files.write_usage(gaps.logs, f"{tmp_path}/logs")
    assert usage_store.refresh(spark, f"{tmp_path}/logs", f"{tmp_path}/store") == 1
    stored = replace(gaps, logs=usage_store.read(spark, f"{tmp_path}/store"))
    assert sorted(account_fact(stored, AS_OF).collect(), key=str) == sorted(account_fact(gaps, AS_OF).collect(), key=str)


def test_empty_folders(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    assert usage_store.refresh(spark, f"{tmp_path}/logs", f"{tmp_path}/store") is None
    assert plain(spark, f"{tmp_path}/store") == []


def test_latest_snapshot_opens_one_partition(spark, gaps, tmp_path):
    path, days = f"{tmp_path}/fact", [d("2024-12-31"), d("2025-03-31"), AS_OF]
    files.write_snapshot(account_fact(gaps, days), path)
    schema = ACCOUNT_FACT
    assert [r.as_of_date for r in files.stored_dates(spark, path).collect()] == days[::-1]
    assert [r.as_of_date for r in files.stored_dates(spark, path, 2).collect()] == days[:0:-1]

    def found(day, fallback="latest"):
        return {r.as_of_date for r in files.read_latest(spark, path, schema, day, fallback).collect()}

    assert found(d("2025-05-15")) == {days[1]} and found(AS_OF) == {AS_OF} and found(d("2030-01-01")) == {AS_OF}
    assert found(d("2020-01-01")) == {AS_OF} and found(d("2020-01-01"), "none") == set()
    assert found(d("2025-05-15"), "none") == {days[1]} and found(d("2025-05-15"), "exact") == set()
    assert found(d("2025-05-15"), "all") == set(days) and found(days[0], "all") == {days[0]}
    one = files.read_latest(spark, path, schema, d("2025-05-15"))
    for day in (days[0], days[2]):  # the other partitions' files are broken and nobody notices
        for file in Path(f"{path}/as_of_date={day}").glob("*.parquet"):
            file.write_bytes(b"not parquet")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    assert one.count() > 15 and found(d("2025-05-15")) == {days[1]}


def test_a_failing_layer_leaves_a_failed_run(spark, tmp_path):
    t = tables(spark, [contract(1, 1, "2024-07-01", "2025-12-31")], [log(1, 1, "2025-05-10", 90)])
    broken = replace(t, reps=t.reps.withColumn("region", F.raise_error(F.lit("no region"))))
    stamp = datetime(2025, 7, 1, 8)
    with pytest.raises(Exception, match="no region"):
        build_all(spark, broken, AS_OF, str(tmp_path), stamp, "first")
    failed = audit.read_run_log(spark, f"{tmp_path}/run_log").first()
    assert (failed.run_id, failed.status, failed.failed_layer) == ("first-20250630", "failed", "dim_reps")
    assert (failed.rows_written_fact, failed.rows_written_dims) == (1, 1)
    done = build_all(spark, t, AS_OF, str(tmp_path), stamp, "second").outputs["run_log"].collect()
    assert [(r.run_id, r.status, r.rows_written_fact, r.rows_written_dims) for r in done] == [("second-20250630", "success", 1, 3)]
    assert audit.read_run_log(spark, f"{tmp_path}/run_log").count() == 2


def test_a_correction_needs_a_note_and_an_approver(spark, tmp_path):
    with pytest.raises(ValueError):
        audit.AuditedRun(spark, str(tmp_path), "x", AS_OF, triggered_by="correction", note="why")
    with audit.AuditedRun(spark, str(tmp_path), "x", AS_OF, triggered_by="correction", note="why", approved_by="who"):
        assert audit.read_run_log(spark, str(tmp_path)).first().status == "running"
    row = audit.read_run_log(spark, str(tmp_path)).first()
    assert (row.status, row.is_correction, row.correction_note, row.correction_approved_by) == ("success", True, "why", "who")
