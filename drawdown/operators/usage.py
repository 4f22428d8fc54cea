"""Usage logs: guards, daily and monthly grain."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from drawdown.functions import (
    as_date,
    from_units,
    month_number,
    month_of,
    month_start,
    null_least,
    ratio,
    to_units,
)
from drawdown.model import RATE_CAP, Tables
from drawdown.operators.contracts import (
    active_contracts,
    contract_months,
    covered_spans,
    is_covered,
    valid_contracts,
)
from drawdown.operators.skew import salted_join

_LOG_SPREAD = ["log_id", "date", "compute_credits_consumed"]


def orphan_guard(logs: DataFrame, accounts: DataFrame) -> DataFrame:
    """Logs of known accounts, at row grain."""
    return salted_join(
        logs, accounts.select("account_id"), ["account_id"], "left_semi", _LOG_SPREAD
    )


def orphaned_logs(logs: DataFrame, accounts: DataFrame) -> DataFrame:
    return salted_join(
        logs, accounts.select("account_id"), ["account_id"], "left_anti", _LOG_SPREAD
    )


def _by_contract(logs: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    inside = F.col("date").between(F.col("start_date"), F.col("end_date"))
    return salted_join(logs, spans, ["account_id"], how, _LOG_SPREAD, residual=inside).select(
        *logs.columns
    )


def in_contract_logs(logs: DataFrame, accounts: DataFrame, contracts: DataFrame) -> DataFrame:
    """Logs of known accounts dated inside a valid contract, at row grain, once each."""
    spans = covered_spans(contracts).join(accounts.select("account_id"), "account_id", "left_semi")
    return _by_contract(logs, spans, "left_semi")


def out_of_contract_usage(
    logs: DataFrame, accounts: DataFrame, contracts: DataFrame
) -> DataFrame:
    """Logs of known accounts dated outside every valid contract, at row grain."""
    return _by_contract(orphan_guard(logs, accounts), covered_spans(contracts), "left_anti")


def daily_totals(logs: DataFrame) -> DataFrame:
    """Credits (in units) and log count per account and day.

    Every metric starts here: partial sums leave the scan, and a hot account is
    spread over its days before anything is joined to it. Rows of the stored
    usage layer are such sums already.
    """
    if "units" in logs.columns:
        return logs.select("account_id", "date", "units", "log_count")
    return logs.groupBy("account_id", "date").agg(
        F.sum(to_units(F.col("compute_credits_consumed"))).alias("units"),
        F.count(F.lit(1)).alias("log_count"),
    )


def guarded_daily(t: Tables, before: date | None = None) -> DataFrame:
    """Daily totals that pass both guards; ``_month`` is kept for grouping.

    ``before`` bounds the scan by a plain comparison on the log date, which
    Parquet and date-partitioned storage can prune on.
    """
    daily = _daily_before(t, before)
    months = contract_months(t.contracts, t.accounts).select(
        "account_id", "_month", "covered_days"
    )
    # Contracts may look small enough to broadcast, but not once spread over months.
    return (
        daily.join(months.hint("merge"), ["account_id", "_month"])
        .filter(is_covered(F.col("date"), F.col("covered_days")))
        .select("account_id", "_month", "date", "units", "log_count")
    )


def _daily_before(t: Tables, before: date | None) -> DataFrame:
    logs = t.logs if before is None else t.logs.filter(F.col("date") < as_date(before))
    return daily_totals(logs).withColumn("_month", month_number(F.col("date")))


def monthly_usage(t: Tables, before: date | None = None) -> DataFrame:
    """Credits and days with usage per account and month, guards applied."""
    return (
        guarded_daily(t, before)
        .groupBy("account_id", "_month")
        .agg(
            from_units(F.sum("units")).alias("credits_consumed"),
            F.count(F.lit(1)).alias("active_usage_days"),
        )
        .select(
            "account_id",
            month_start(F.col("_month")).alias("usage_month"),
            "credits_consumed",
            "active_usage_days",
        )
    )


def monthly_usage_fanout(t: Tables) -> DataFrame:
    """As ``monthly_usage``, but a day counts once per contract that covers it.

    The number of covering contracts per account and day comes from running
    start/end counts, so contracts never meet logs pairwise.
    """
    c = t.contracts.filter(F.col("end_date") >= F.col("start_date"))
    marks = (
        c.select(
            "account_id",
            F.explode(
                F.array(
                    F.struct(F.col("start_date").alias("day"), F.lit(1).alias("delta")),
                    F.struct(F.date_add("end_date", 1).alias("day"), F.lit(-1).alias("delta")),
                )
            ).alias("m"),
        )
        .groupBy("account_id", F.col("m.day").alias("date"))
        .agg(F.sum("m.delta").alias("delta"))
    )
    daily = daily_totals(t.logs).join(t.accounts.select("account_id"), "account_id", "left_semi")
    timeline = marks.select(
        "account_id", "date", "delta", F.lit(None).cast("long").alias("units")
    ).unionByName(
        daily.select("account_id", "date", F.lit(0).cast("long").alias("delta"), "units")
    )
    upto = W.partitionBy("account_id").orderBy("date").rangeBetween(W.unboundedPreceding, 0)
    covered = (
        timeline.withColumn("_covers", F.sum("delta").over(upto))
        .filter(F.col("units").isNotNull() & (F.col("_covers") > 0))
        .groupBy("account_id", month_of(F.col("date")).alias("usage_month"))
        .agg(
            from_units(F.sum(F.col("units") * F.col("_covers"))).alias("credits_consumed"),
            F.count(F.lit(1)).alias("active_usage_days"),
        )
    )
    return covered


def monthly_consumption(
    t: Tables, rate_cap: float = RATE_CAP, before: date | None = None
) -> DataFrame:
    """Zero-filled account-month grid with the capped consumption rate.

    Grid and daily totals meet once, on (account, month): the grid row carries
    the covered days, so the contract guard is a bit test and the sum after the
    join needs no further shuffle.

    ``before``, the first day of a month, leaves out that month and later ones.
    """
    grid = contract_months(t.contracts, t.accounts, before)
    return _consumed(grid, _daily_before(t, before), rate_cap)


def _consumed(grid: DataFrame, daily: DataFrame, rate_cap: float) -> DataFrame:
    daily = daily.select(
        F.col("account_id").alias("_acct"), F.col("_month").alias("_m"), "date", "units"
    )
    match = (
        (F.col("account_id") == F.col("_acct"))
        & (F.col("_month") == F.col("_m"))
        & is_covered(F.col("date"), F.col("covered_days"))
    )
    used = F.coalesce(from_units(F.sum("units")), F.lit(0.0))
    monthly = (
        grid.join(daily, match, "left")
        .groupBy("account_id", "_month", "included_monthly_compute_credits")
        .agg(used.alias("credits_consumed"), F.count("date").alias("active_usage_days"))
    )
    credits = F.col("credits_consumed")
    raw = ratio(credits, F.col("included_monthly_compute_credits"))
    return monthly.select(
        "account_id",
        month_start(F.col("_month")).alias("usage_month"),
        "included_monthly_compute_credits",
        "credits_consumed",
        "active_usage_days",
        null_least(raw, F.lit(float(rate_cap))).alias("consumption_rate"),
        (credits == 0).alias("is_zero_usage_month"),
    )


#: Bits of the account filter of ``recent_consumption``, as words of 64: at most 128 KB in any plan.
FILTER_WORDS = 1 << 14


def recent_months(
    t: Tables, as_of: date | list[date], k: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Grid rows among the last ``k`` complete months of accounts active at a snapshot date: recent ones, and older ones.

    Recent are months from the ``k``-th before the first date on. They are few
    and known, so one aggregate over contracts gives an account's row with all
    of them. Only accounts that lack ``k`` of them, after a gap between
    contracts, need older ones, and only their contracts are spread over months.
    Third come these accounts with ``_bound``, a month that none they need lies
    before. Only contracts are read; accounts are not looked up.
    """
    days = as_of if isinstance(as_of, (list, tuple)) else [as_of]
    floor, end = _number(months_back(min(days), k)), _number(max(days))
    valid = valid_contracts(t.contracts)
    first, last = month_number(F.col("start_date")), month_number(F.col("end_date"))
    inside = {m: (first <= m) & (last >= m) for m in range(floor, end)}
    one, every = F.lit(1).cast("long"), F.lit((1 << 31) - 1).cast("long")
    since = (-F.call_function("shiftleft", one, F.dayofmonth("start_date") - 1)).bitwiseAND(every)
    until = F.call_function("shiftleft", one, F.dayofmonth("end_date")) - 1
    columns = []
    for m, covers in inside.items():
        bits = F.when(first == m, since).otherwise(every).bitwiseAND(F.when(last == m, until).otherwise(every))
        columns.append(F.sum(F.when(covers, F.col("included_monthly_compute_credits"))).alias(f"_credits_{m}"))
        columns.append(F.bit_or(F.when(covers, bits)).alias(f"_days_{m}"))
    for i, day in enumerate(days):
        running = (F.col("start_date") <= as_date(day)) & (F.col("end_date") >= as_date(day))
        columns.append(F.max(running).alias(f"_active_{i}"))
    # A contract that ran k months before the floor has all that can be missing.
    past = F.least(last, F.lit(floor - 1))
    columns.append(F.max(F.when(past - first >= k - 1, past - k + 1)).alias("_full"))
    columns.append(F.min(first).alias("_first"))
    rows = valid.filter(F.col("start_date") <= as_date(max(days))).groupBy("account_id").agg(*columns)
    none = F.array().cast("array<struct<_month:int,included_monthly_compute_credits:bigint,covered_days:bigint>>")
    needed, missing = none, F.lit(0)
    for i, day in enumerate(days):
        months = F.array(
            *[
                F.struct(
                    F.lit(m).alias("_month"),
                    F.col(f"_credits_{m}").alias("included_monthly_compute_credits"),
                    F.col(f"_days_{m}").alias("covered_days"),
                )
                for m in range(floor, _number(day))
            ]
        )
        present = F.slice(F.reverse(F.filter(months, lambda x: x["covered_days"].isNotNull())), 1, k)
        active = F.col(f"_active_{i}")
        needed = F.array_union(needed, F.when(active, present).otherwise(none))
        missing = F.greatest(missing, F.when(active, k - F.size(present)).otherwise(0))
    rows = rows.filter(F.greatest(*[F.col(f"_active_{i}") for i in range(len(days))], F.lit(False)))
    bound = F.coalesce("_full", "_first").alias("_bound")
    rows = rows.select("account_id", needed.alias("_needed"), missing.alias("_missing"), bound)
    recent = rows.select("account_id", F.inline("_needed"))
    short = rows.filter((F.col("_missing") > 0) & (F.col("_bound") < floor)).drop("_needed")
    gapped = t.contracts.join(short.select("account_id"), "account_id", "left_semi")
    newest = W.partitionBy("account_id").orderBy(F.col("_month").desc())
    older = (
        contract_months(gapped, before=months_back(min(days), k))
        .join(short, "account_id")
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= F.col("_missing"))
        .select(*recent.columns)
    )
    return recent, older, short


def _number(day: date) -> int:
    return day.year * 12 + day.month - 1


def _account_bit(account: Column) -> tuple[Column, Column]:
    """Word and bit of an account in the account filter."""
    bit = F.pmod(F.xxhash64(account), F.lit(FILTER_WORDS * 64))
    return (bit / 64).cast("int"), (bit % 64).cast("int")


def needed_logs(t: Tables, short: DataFrame, floor: date, before: date) -> DataFrame:
    """Logs from ``floor`` on, and earlier ones of the accounts that need older months.

    The bounds on the log date are a literal and one value computed from the
    contracts, so both reach the Parquet filter (and the partitions, where logs
    are stored by month). Older logs pass a filter of hashed account bits of fixed
    size: it lets some through that nobody needs, which the join on (account,
    month) drops, and none of those needed is lost. Both values are subqueries,
    so nothing runs before the query does.
    """
    first = F.coalesce(F.min(month_start(F.col("_bound"))), as_date(floor))
    lower = short.agg(first.alias("first")).scalar()
    word, bit = _account_bit(F.col("account_id"))
    one = F.lit(1).cast("long")
    words = short.groupBy(word.alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", one, bit)).alias("bits")
    )
    bits = words.agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m")).select(
        F.transform(
            F.sequence(F.lit(0), F.lit(FILTER_WORDS - 1)),
            lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long")),
        ).alias("w")
    )
    listed = F.element_at(bits.scalar(), word + 1)
    needed = (F.col("date") >= as_date(floor)) | (F.call_function("getbit", listed, bit) == 1)
    return between(t.logs, lower, before).filter(needed)


def between(logs: DataFrame, first: Column, before: date) -> DataFrame:
    """Logs from a day on and before another; the months of the storage layout are bounded too."""
    day = F.col("date")
    inside = logs.filter((day >= first) & (day < as_date(before)))
    if "usage_month" in logs.columns:
        month = F.col("usage_month")
        inside = inside.filter((month >= F.trunc(first, "month")) & (month < as_date(before)))
    return inside


def recent_consumption(
    t: Tables, as_of: date | list[date], k: int, rate_cap: float = RATE_CAP
) -> DataFrame:
    """``monthly_consumption`` of the months that trailing rates of active accounts look at, and no others."""
    days = as_of if isinstance(as_of, (list, tuple)) else [as_of]
    before, floor = max(days).replace(day=1), months_back(min(days), k)
    recent, older, short = recent_months(t, days, k)
    daily = daily_totals(needed_logs(t, short, floor, before))
    daily = daily.withColumn("_month", month_number(F.col("date")))
    return _consumed(recent.unionByName(older), daily, rate_cap)


def months_back(day: date, k: int) -> date:
    """First day of the ``k``-th month before a day's."""
    number = _number(day) - k
    return date(number // 12, number % 12 + 1, 1)


def fact_monthly(t: Tables, as_of: date) -> DataFrame:
    """Account-month fact with the month's position since the first contract month."""
    past = monthly_consumption(t, before=as_of.replace(day=1))
    first = F.min("usage_month").over(W.partitionBy("account_id"))
    index = F.months_between("usage_month", first).cast("long")
    return past.withColumn("month_index", index)


def daily_consumption(t: Tables, as_of: date, since: date | None = None) -> DataFrame:
    """One row per active account and day from contract start (or ``since``, if later) to as-of, zero-filled.

    Accounts meet their usage by month; the days of a month are spread after the
    join, so no row of a single day without usage is shuffled or sorted.
    """
    active = active_contracts(t.contracts, t.accounts, as_of).select(
        "account_id", "contract_start_date", "included_monthly_compute_credits"
    )
    begin = F.col("contract_start_date")
    usage = guarded_daily(t, as_of + timedelta(days=1))
    if since is not None:
        begin = F.greatest(begin, as_date(since))
        usage = usage.filter(F.col("date") >= as_date(since))
        active = active.filter(begin <= as_date(as_of))
    used = usage.groupBy("account_id", "_month").agg(
        F.collect_list(F.struct("date", "units")).alias("_used")
    )
    months = F.sequence(month_number(begin), month_number(as_date(as_of)))
    spine = active.withColumn("_begin", begin).withColumn("_month", F.explode(months))
    first = F.greatest("_begin", month_start(F.col("_month")))
    last = F.least(as_date(as_of), F.last_day(month_start(F.col("_month"))))
    taken = F.coalesce("_used", F.array().cast("array<struct<date:date,units:bigint>>"))
    quiet = F.transform(
        F.array_except(F.sequence(first, last, F.expr("interval 1 day")), taken["date"]),
        lambda day: F.struct(day.alias("date"), F.lit(None).cast("bigint").alias("units")),
    )
    busy = F.filter(taken, lambda x: x["date"].between(first, last))
    days = spine.join(used, ["account_id", "_month"], "left").select(
        *active.columns, F.inline(F.concat(quiet, busy))
    )
    credits = F.coalesce(from_units(F.col("units")), F.lit(0.0))
    allowance = F.col("included_monthly_compute_credits") / F.lit(30.0)
    return days.select(
        "account_id",
        "date",
        "contract_start_date",
        "included_monthly_compute_credits",
        credits.alias("daily_credits_consumed"),
        ratio(credits, allowance).alias("daily_consumption_rate"),
    )


def active_daily_usage(t: Tables, as_of: date, days_back: int | None = None) -> DataFrame:
    """Active accounts left-joined to their guarded usage days since contract start.

    The sparse counterpart of ``daily_consumption``: days without usage are
    simply absent, which is all that sums over a window need.
    """
    active = active_contracts(t.contracts, t.accounts, as_of).drop("as_of_date")
    usage = guarded_daily(t, as_of + timedelta(days=1))
    if days_back is not None:
        usage = usage.filter(F.col("date") > F.date_sub(as_date(as_of), days_back))
    usage = usage.select(F.col("account_id").alias("_acct"), "date", "units")
    match = (F.col("account_id") == F.col("_acct")) & (
        F.col("date") >= F.col("contract_start_date")
    )
    return active.join(usage, match, "left").drop("_acct")
