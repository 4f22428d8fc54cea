"""Bounded-task helpers against brute force on random and skewed input."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from drawdown.operators import contracts, skew, usage
from tests.build import contract, log, tables


def _random_contracts(seed, n=300, hot=0.4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        account = 1 if rng.random() < hot else rng.randint(2, 20)
        start = date(2020, 1, 1) + timedelta(days=rng.randint(0, 900))
        length = rng.choice([-40, -1, 0, 1, 5, 30, 31, 200, 364])
        end = start + timedelta(days=length)
        out.append(
            contract(i, account, start.isoformat(), end.isoformat(), credits=rng.randint(0, 9))
        )
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_spans_and_month_masks_cover_the_same_days(spark, seed):
    rows = _random_contracts(seed)
    t = tables(spark, rows)
    want = set()
    for c in rows:
        day = c[3]
        while day <= c[4]:
            want.add((c[1], day))
            day += timedelta(days=1)
    got = set()
    for r in contracts.covered_spans(t.contracts).collect():
        for n in range((r.end_date - r.start_date).days + 1):
            pair = (r.account_id, r.start_date + timedelta(days=n))
            assert pair not in got
            got.add(pair)
    assert got == want
    masked = set()
    for r in contracts.contract_months(t.contracts).collect():
        first = date(r._month // 12, r._month % 12 + 1, 1)
        for bit in range(31):
            day = first + timedelta(days=bit)
            if r.covered_days >> bit & 1 and day.month == first.month:
                masked.add((r.account_id, day))
        assert r.covered_days >> 31 == 0
    assert masked == want


@pytest.mark.parametrize("seed", [3, 4])
def test_overlaps_against_all_pairs(spark, seed):
    rows = _random_contracts(seed, n=150)
    t = tables(spark, rows)
    want = {
        (a[0], b[0])
        for a in rows
        for b in rows
        if a[1] == b[1] and b[0] > a[0] and b[3] <= a[4] and b[4] >= a[3]
    }
    pairs = contracts.overlapping_pairs(t.contracts).collect()
    assert len(pairs) == len(want)
    assert {(r.contract_1, r.contract_2) for r in pairs} == want
    by_id = {c[0]: c for c in rows}
    accounts = {by_id[a][1] for a, _ in want}
    got = {r.account_id for r in contracts.accounts_with_overlap(t.contracts).collect()}
    assert got == accounts
    valid = {c[0] for c in rows if c[4] >= c[3]}
    profile = {r.contract_id: r.overlapping_contracts
               for r in contracts.overlap_profile(t.contracts).collect()}
    assert profile == {
        c: sum(1 for a, b in want if c in (a, b) and a in valid and b in valid) for c in valid
    }


def test_fanout_against_all_pairs(spark):
    rows = _random_contracts(5, n=120)
    rng = random.Random(5)
    logs = [
        log(i, rng.randint(1, 22), (date(2020, 1, 1) + timedelta(days=rng.randint(0, 1200))).isoformat(), rng.randint(1, 9))
        for i in range(600)
    ]
    t = tables(spark, rows, logs)
    known = {c[1] for c in rows}
    want: dict = {}
    for _, account, day, credits in logs:
        n = sum(1 for c in rows if c[1] == account and c[3] <= day <= c[4])
        if account in known and n:
            key = (account, day.replace(day=1))
            want[key] = want.get(key, 0.0) + n * credits
    got = {(r.account_id, r.usage_month): r.credits_consumed
           for r in usage.monthly_usage_fanout(t).collect()}
    assert got == want


def test_ranks_match_window_rank(spark):
    rng = random.Random(6)
    values = [None] * 40 + [0.0] * 30 + [round(rng.uniform(-5e6, 5e6), 2) for _ in range(200)]
    values += [123.45] * 25 + [0.01, -0.01, 9.99, 10.0, 99999.99, 100000.0]
    data = [(i, f"r{i % 3}", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "id long, region string, v double")
    ranked = skew.competition_ranks(df, "v", {"region_rank": ["region"], "all_rank": []})
    got = {r.id: (r.region_rank, r.all_rank) for r in ranked.collect()}
    df.createOrReplaceTempView("values_to_rank")
    want = {
        r.id: (r.a, r.b)
        for r in spark.sql(
            "select id, rank() over (partition by region order by v desc nulls last) a,"
            " rank() over (order by v desc nulls last) b from values_to_rank"
        ).collect()
    }
    assert got == want


@pytest.mark.parametrize("n", [0, 1, 500])
def test_ordinal_numbers_each_bucket_in_order(spark, n):
    names = [f"name-{i * 7919 % 10007:05d}" for i in range(n)]
    df = spark.createDataFrame([(x, i % 4) for i, x in enumerate(names)], "name string, bucket int")
    got = {(r.bucket, r.pos): r.name for r in skew.ordinal(df, ["bucket"], "name", "pos").collect()}
    want = {}
    for bucket in range(4):
        for pos, name in enumerate(sorted(x for i, x in enumerate(names) if i % 4 == bucket), 1):
            want[(bucket, pos)] = name
    assert got == want


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    big = spark.range(1000).select(
        F.when(F.col("id") < 400, 1).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v")
    )
    small = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    plain = sorted(big.join(small, "k", how).collect(), key=str)
    salted = skew.salted_join(big, small, ["k"], how, spread=["v"])
    assert sorted(salted.select(*big.join(small, "k", how).columns).collect(), key=str) == plain


def test_hot_key_is_split_over_salts(spark):
    big = spark.range(10000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    part = F.pmod(F.xxhash64("v"), F.lit(skew.SALTS))
    sizes = [r["count"] for r in big.groupBy(part).count().collect()]
    assert len(sizes) == skew.SALTS and max(sizes) < 2 * min(sizes)


def test_salted_join_does_not_broadcast_the_copies(spark, tmp_path):
    """A side that is small in its files is not broadcast once per part."""
    spark.range(0, 300_000, 1, 2).withColumn("k", F.xxhash64("id")).write.parquet(f"{tmp_path}/small")
    spark.range(0, 1000, 1, 2).select((F.xxhash64("id")).alias("k"), "id").write.parquet(f"{tmp_path}/big")
    small, big = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("small", "big"))
    joined = skew.salted_join(big, small.select("k"), ["k"], "left_anti", spread=["id"])
    assert joined.count() == 0
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_month_grid_does_not_broadcast_accounts(spark, tmp_path):
    """Accounts grow with the input, so they never go through the driver, however small their files are."""
    t = tables(spark, [(1, 5, 1, date(2025, 1, 10), date(2025, 2, 3), 0, 7, 12)])
    spark.range(0, 300_000, 1, 2).withColumnRenamed("id", "account_id").write.parquet(f"{tmp_path}/accounts")
    grid = contracts.contract_months(t.contracts, spark.read.parquet(f"{tmp_path}/accounts"))
    assert "BroadcastHashJoin" not in grid._jdf.queryExecution().sparkPlan().toString()
    assert sorted((r.account_id, r._month % 12) for r in grid.collect()) == [(5, 0), (5, 1)]


def test_guard_does_not_broadcast_months(spark, tmp_path):
    t = tables(spark, [contract(1, 5, "2025-01-10", "2025-02-03")], [log(1, 5, "2025-01-10", 2), log(2, 5, "2025-02-04", 2)])
    for name in ("accounts", "contracts", "logs"):
        getattr(t, name).write.parquet(f"{tmp_path}/{name}")
    stored = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("accounts", "contracts", "logs")}
    guarded = usage.guarded_daily(replace(t, **stored))
    assert "BroadcastHashJoin" not in guarded._jdf.queryExecution().sparkPlan().toString()
    assert [r.date for r in guarded.collect()] == [date(2025, 1, 10)]


def test_month_grid_of_repeated_unknown_and_null_accounts(spark):
    """An account's rows come once per copy of it; an unknown one keeps its allowance and covers no day."""
    rows = [(i, a, 1, date(2025, 1, 1), date(2025, 1, 2 + i), 0, 7, 12) for i, a in enumerate([1, 1, 2, 3, None])]
    t = tables(spark, rows, accounts=[])
    known = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,)], "account_id BIGINT")
    grid = contracts.contract_months(t.contracts, known)
    assert grid.columns == ["account_id", "_month", "included_monthly_compute_credits", "covered_days"]
    got = sorted((r.account_id or 0, r.included_monthly_compute_credits, r.covered_days) for r in grid.collect())
    assert got == [(0, 7, 0), (1, 14, 7), (1, 14, 7), (2, 7, 15), (3, 7, 0)]
