"""Stored dimension versions, stored snapshots with corrections, and the guard's stored index."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from drawdown.operators import history
from drawdown.sources import dimension_store, fact_store, runs
from drawdown.streaming import jobs
from tests.build import contract, d, tables

FIRST = date(2024, 1, 1)
SEEN = "rep long, on date, segment string, region string"
T1, T2 = datetime(2025, 1, 1), datetime(2025, 2, 1)


def dimension(tmp_path, name="dim", buckets=4):
    reasons = {"segment": "territory_reassignment", "region": "name_change"}
    return dimension_store.Dimension(f"{tmp_path}/{name}", "rep", {"segment": "string", "region": "string"}, reasons, buckets)


def merge(spark, dim, rows, at=T1):
    return dimension_store.merge(dim, spark.createDataFrame(rows, SEEN), "on", at)


def versions(spark, dim, *drop):
    return sorted((tuple(r) for r in dimension_store.read(spark, dim).drop("dw_created_at", *drop).collect()), key=str)


@pytest.fixture(scope="module")
def observed():
    rng = random.Random(3)
    rows = {}
    for rep in range(10):
        for _ in range(10):
            day = FIRST + timedelta(days=rng.randrange(30))
            rows[rep, day] = (rep, day, rng.choice(["a", "b", None]), rng.choice(["x", "y"]))
    return list(rows.values())


def test_day_by_day_and_shuffled_deliveries_equal_one_rebuild(spark, tmp_path, observed):
    whole, days, mixed = (dimension(tmp_path, n) for n in ("whole", "days", "mixed"))
    assert merge(spark, whole, observed) == 1
    for low in range(0, 30, 10):
        merge(spark, days, [o for o in observed if low <= (o[1] - FIRST).days < low + 10])
    shuffled = random.Random(1).sample(observed, len(observed))
    for k in range(3):
        merge(spark, mixed, shuffled[k::3])
    assert versions(spark, whole) == versions(spark, days) == versions(spark, mixed)
    plain = history.scd2(spark.createDataFrame(observed, SEEN), "rep", "on", ["segment", "region"])
    stored = dimension_store.read(spark, whole).select(plain.columns)
    assert sorted(map(str, plain.collect())) == sorted(map(str, stored.collect()))
    keys = [r.surrogate_key for r in dimension_store.read(spark, whole).collect()]
    assert len(set(keys)) == len(keys) > 40


def test_a_change_closes_the_open_version_and_keeps_its_key_and_time(spark, tmp_path):
    dim = dimension(tmp_path)
    merge(spark, dim, [(1, FIRST, "a", "x"), (2, FIRST, "a", "x")], T1)
    merge(spark, dim, [(1, d("2024-02-01"), "b", "x"), (2, d("2024-02-01"), "a", "x")], T2)
    got = {(r.rep, r.valid_from): r for r in dimension_store.read(spark, dim).collect()}
    old, new = got[1, FIRST], got[1, d("2024-02-01")]
    assert (old.valid_to, old.is_current, old.change_reason, old.dw_created_at) == (d("2024-01-31"), False, None, T1)
    assert (new.valid_to, new.is_current, new.change_reason, new.dw_created_at) == (None, True, "territory_reassignment", T2)
    assert old.surrogate_key == 65536 + 19723 and new.surrogate_key == 65536 + 19754
    assert len(got) == 3
    # Late news splits the closed version; what stays keeps key and time.
    merge(spark, dim, [(1, d("2024-01-11"), "a", "y")], datetime(2025, 3, 1))
    late = {r.valid_from: r for r in dimension_store.read(spark, dim).filter("rep = 1").collect()}
    assert [(k.day, late[k].segment, late[k].region, late[k].change_reason) for k in sorted(late)] == [
        (1, "a", "x", None), (11, "a", "y", "name_change"), (1, "b", "x", "territory_reassignment")
    ]
    assert (late[FIRST].surrogate_key, late[FIRST].dw_created_at) == (old.surrogate_key, T1)
    assert late[d("2024-02-01")].dw_created_at == T2
    assert {r.rep for r in dimension_store.read_current(spark, dim).collect()} == {1, 2}


def test_equal_observations_write_no_bucket_and_replays_change_nothing(spark, tmp_path, observed):
    dim = dimension(tmp_path)
    merge(spark, dim, observed)
    before = versions(spark, dim)
    open_rows = [(r.rep, d("2024-06-01"), r.segment, r.region) for r in dimension_store.read_current(spark, dim).collect()]
    assert merge(spark, dim, open_rows) == 2
    assert versions(spark, dim) == before and not Path(f"{dim.path}/current/run=2").exists()
    assert merge(spark, dim, observed) == 3
    assert versions(spark, dim) == before


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    dim = dimension(tmp_path, buckets=16)
    merge(spark, dim, [(rep, FIRST, "a", "x") for rep in range(40)])
    merge(spark, dim, [(7, d("2024-03-01"), "b", "x"), *[(rep, d("2024-03-01"), "a", "x") for rep in range(7)]])
    (one,) = Path(f"{dim.path}/current/run=2").glob("bucket=*")
    assert one.name in {p.name for p in Path(f"{dim.path}/current/run=1").glob("bucket=*")}
    assert len(versions(spark, dim)) == 41
    for file in Path(f"{dim.path}/closed").glob("run=*/*/*.parquet"):  # open versions need no closed ones
        file.write_bytes(b"not parquet")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    assert dimension_store.read_current(spark, dim).count() == 40


def test_a_merge_that_fails_leaves_what_was_there(spark, tmp_path, monkeypatch):
    dim = dimension(tmp_path)
    merge(spark, dim, [(1, FIRST, "a", "x")])
    before = versions(spark, dim)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(runs, "commit", broken)
        with pytest.raises(RuntimeError):
            merge(spark, dim, [(1, d("2024-02-01"), "b", "x"), (2, FIRST, "a", "x")])
    assert versions(spark, dim) == before
    assert merge(spark, dim, [(1, d("2024-02-02"), "c", "x")]) == 2
    assert [v[2] for v in versions(spark, dim)] == ["a", "c"]


def test_odd_observations(spark, tmp_path):
    dim = dimension(tmp_path)
    assert merge(spark, dim, []) is None and versions(spark, dim) == []
    rows = [(None, FIRST, "a", "x"), (1, None, "a", "x"), (1, FIRST, "a", None), (1, FIRST, "b", "x"), (1, FIRST, "b", "x")]
    more = spark.createDataFrame(rows, SEEN).withColumns({"bucket": F.lit("clash"), "digest": F.lit(1), "day": F.lit(2)})
    assert dimension_store.merge(dim, more, "on", T1) == 1
    assert [v[1:4] for v in versions(spark, dim)] == [(1, "b", "x")]
    merge(spark, dim, [(1, d("2024-02-01"), None, None)])
    assert [v[2:4] for v in versions(spark, dim)] == [("b", "x"), (None, None)]
    with pytest.raises(ValueError):
        merge(spark, dimension(tmp_path, buckets=5), rows)
    with pytest.raises(Exception, match="no surrogate key"):
        merge(spark, dimension(tmp_path, "far"), [(1, d("1969-12-31"), "a", "x")])


def test_facts_are_bound_to_the_version_of_their_day(spark, tmp_path):
    dim = dimension(tmp_path)
    merge(spark, dim, [(1, FIRST, "a", "x"), (1, d("2024-03-01"), "b", "x")])
    fact = spark.createDataFrame(
        [(10, 1, d("2024-02-29")), (11, 1, d("2024-03-01")), (12, 1, d("2023-12-31")), (13, 2, FIRST), (14, None, FIRST)],
        "account_id long, rep long, day date",
    )
    bound = dimension_store.bind(fact, spark, dim, "rep", "day", "version", ["account_id"])
    found = {r.account_id: r.version for r in bound.collect()}
    assert found == {10: 65536 + 19723, 11: 65536 + 19783, 12: None, 13: None, 14: None}


# Stored snapshots

DAY, NEXT = d("2025-03-31"), d("2025-06-30")
WHY = fact_store.Correction("wrong usage", "ops", "cfo", paid_through=DAY, at=T1)


def facts(spark, rows):
    """Fact rows of which only key, date, tier and value are given."""
    given = spark.createDataFrame(rows, "account_id long, as_of_date date, health_tier string, cacv double")
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in fact_store.FACT.fields if f.name not in given.columns]
    return given.select("*", *absent)


def book(day=DAY, n=40):
    return [(a, day, "Healthy", 100.0 + a) for a in range(n)]


def test_corrections_and_provenance(spark, tmp_path):
    store = f"{tmp_path}/facts"
    assert fact_store.write(spark, store, facts(spark, book() + book(NEXT)), "first", buckets=8) == 1
    changed = [(a, day, t, v) for a, day, t, v in book() if a not in (3, 4, 5, 6)]
    changed += [(3, DAY, "Healthy", 90.5), (4, DAY, "At Risk", 104.0), (5, DAY, "Healthy", 200.0), (99, DAY, None, None)]
    assert fact_store.write(spark, store, facts(spark, changed), "second", WHY, buckets=8) == 2
    got = {r.account_id: r for r in fact_store.corrections(spark, store).collect()}
    assert {a: (r.old_cacv, r.new_cacv, r.clawback_triggered, r.clawback_amount) for a, r in got.items()} == {
        3: (103.0, 90.5, True, 12.5), 4: (104.0, 104.0, False, None), 5: (105.0, 200.0, False, None),
        6: (106.0, None, True, 106.0), 99: (None, None, False, None),
    }
    one = got[3]
    assert (one.pipeline_run_id, one.corrected_by, one.approved_by, one.correction_reason, one.comp_period_affected) == (
        "second", "ops", "cfo", "wrong usage", "FY2025-Q3"
    )
    assert len({r.correction_id for r in got.values()}) == 5
    rows = {r.account_id: (r.pipeline_run_id, r.is_correction) for r in fact_store.read(spark, store, DAY).collect()}
    assert {a: rows[a] for a in (3, 4, 5, 99)} == {3: ("second", True), 4: ("second", True), 5: ("second", True), 99: ("second", False)}
    assert len(rows) == 40 and 6 not in rows and sum(r == ("first", False) for r in rows.values()) == 36
    assert fact_store.read(spark, store, NEXT).filter("pipeline_run_id = 'first'").count() == 40
    # A later value of an unpaid date takes nothing back.
    lower = [(a, day, t, v - 1) for a, day, t, v in book(NEXT)]
    fact_store.write(spark, store, facts(spark, lower), "third", WHY, buckets=8)
    third = fact_store.corrections(spark, store).filter("pipeline_run_id = 'third'").collect()
    assert len(third) == 40 and not any(r.clawback_triggered for r in third)


def test_equal_buckets_are_neither_read_nor_written(spark, tmp_path):
    store = f"{tmp_path}/facts"
    fact_store.write(spark, store, facts(spark, book()), "first", buckets=8)
    same = facts(spark, book()[::-1]).repartition(3)
    assert fact_store.write(spark, store, same, "again", WHY, buckets=8) == 2
    assert not list(Path(f"{store}/rows/run=2").glob("as_of_date=*"))
    changed = facts(spark, [*book()[1:], (0, DAY, "Healthy", 1.0)])
    (place,) = fact_store.differing(spark, store, _sums(changed), 2)
    for file in Path(f"{store}/rows/run=1").glob("*/*/*.parquet"):  # whoever opens another bucket fails
        if file.parent.name != f"bucket={place.bucket}":
            file.write_bytes(b"not parquet")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    assert fact_store.write(spark, store, changed, "third", WHY, buckets=8) == 3
    assert [(r.account_id, r.old_cacv) for r in fact_store.corrections(spark, store).collect()] == [(0, 100.0)]
    assert [p.name for p in Path(f"{store}/rows/run=3/as_of_date={DAY}").iterdir()] == [f"bucket={place.bucket}"]


def _sums(fact):
    values = [f.name for f in fact_store.FACT.fields]
    return fact_store._checksums(
        fact.withColumn("digest", F.sha2(F.to_json(F.struct(*values)), 256)).withColumn(
            "bucket", F.pmod(F.xxhash64("account_id"), F.lit(8)).cast("int")
        )
    )


def test_a_bucket_can_lose_all_rows(spark, tmp_path):
    store = f"{tmp_path}/facts"
    fact_store.write(spark, store, facts(spark, book(n=2)), "first", buckets=64)
    fact_store.write(spark, store, facts(spark, book(n=1)), "second", buckets=64)
    assert [r.account_id for r in fact_store.read(spark, store).collect()] == [0]
    assert fact_store.write(spark, store, facts(spark, book(n=1)), "third", buckets=64) == 3
    fact_store.write(spark, store, facts(spark, book(n=2)), "fourth", WHY, buckets=64)
    back = fact_store.read(spark, store).filter("account_id = 1").first()
    assert (back.pipeline_run_id, back.is_correction) == ("fourth", False)
    assert [r.account_id for r in fact_store.corrections(spark, store).collect()] == [1]
    assert fact_store.write(spark, store, facts(spark, []), "none") is None


def test_a_snapshot_that_fails_leaves_what_was_there(spark, tmp_path, monkeypatch):
    store = f"{tmp_path}/facts"
    fact_store.write(spark, store, facts(spark, book()), "first")
    with monkeypatch.context() as patch:
        patch.setattr(runs, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            fact_store.write(spark, store, facts(spark, [(0, DAY, "x", 0.0)]), "lost", WHY)
    assert fact_store.read(spark, store).count() == 40 and fact_store.corrections(spark, store).count() == 0
    assert {r.pipeline_run_id for r in fact_store.read(spark, store).collect()} == {"first"}


def test_a_correction_names_reason_author_and_approver():
    for missing in range(3):
        given = ["why", "who", "cfo"]
        given[missing] = ""
        with pytest.raises(ValueError):
            fact_store.Correction(*given, paid_through=DAY)


# The guard's stored index

EVENT = "log_id long, account_id long, ts timestamp, credits double"


def batch(spark, *rows):
    return spark.createDataFrame([(i, a, ts and datetime.fromisoformat(ts), 1.0) for i, a, ts in rows], EVENT)


def test_index_is_built_once_a_version_and_replays_split_as_before(spark, tmp_path, monkeypatch):
    t = tables(spark, [contract(1, 1, "2025-03-10", "2025-03-20"), contract(2, 8, "2025-01-01", "2025-12-31")], accounts=[(1, "a", "x", 1)])
    longer = tables(spark, [contract(1, 1, "2025-03-10", "2025-04-02")], accounts=[(1, "a", "x", 1)]).contracts
    state, built = {"c": t.contracts}, []
    grid = jobs.contract_months
    monkeypatch.setattr(jobs, "contract_months", lambda *a: built.append(1) or grid(*a))
    ok, no = f"{tmp_path}/ok", f"{tmp_path}/no"
    write = jobs.guarded(t.accounts, lambda: state["c"], ok, no)

    def ids(path):
        return sorted(r.log_id for r in spark.read.parquet(path).collect())

    first = batch(spark, (1, 1, "2025-03-10T00:00"), (2, 1, "2025-03-21T00:00"), (3, 8, "2025-03-10T00:00"), (4, None, "2025-03-10T00:00"), (5, 1, None))
    write(first, 0)
    write(batch(spark, (6, 1, "2025-03-20T23:59"), (7, 1, "2025-03-09T23:59")), 1)
    assert (ids(ok), ids(no), len(built)) == ([1, 6], [2, 3, 4, 5, 7], 1)
    state["c"] = longer
    write(batch(spark, (8, 1, "2025-04-02T00:00"), (9, 1, "2025-04-03T00:00")), 2)
    assert (ids(ok), len(built)) == ([1, 6, 8], 2)
    write(first, 0)  # a replay: row 2 would pass now
    assert (ids(ok), ids(no), len(built)) == ([1, 6, 8], [2, 3, 4, 5, 7, 9], 2)


def test_checksum_of_the_static_sides(spark):
    def version(*spans):
        t = tables(spark, [contract(i, *s) for i, s in enumerate(spans)])
        return jobs.guard_version(t.accounts, t.contracts)

    a, b = (1, "2025-01-01", "2025-02-01"), (2, "2025-01-01", "2025-02-01")
    assert version(a, b) == version(b, a) != version(a, a)
    assert version() != version(a)
