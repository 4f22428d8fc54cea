"""Shelfware alerts from the usage stream: an account that stays under a share of its allowance for days on end.

Keyed state with an event-time timeout. An account's state is its contract terms,
the credits of days the watermark has not passed yet, and the run of low days
that ends with the last closed day. A day closes when the watermark passes its
end; it is low if its credits are under ``below`` of the day's allowance (the
monthly credits of all terms that cover it, over 30). The ``days``-th low day in
a row raises one alert; a day that is not low, or that no term covers, ends the
run. A timeout at the first moment an alert is possible closes silent days, so
accounts that never send an event are flagged too: terms are stream rows
themselves and open the state. A contract announced later joins in from the day
after the last closed one.

Accounts are dealt by hash to ``groups``; the state of a group is one row of all
its accounts, so what a call costs beyond its rows is shared by them. An account
is still closed only with its own rows or when its own time is due. Raise
``groups`` where a group would hold thousands of accounts. Days in the state are
numbers from 1970-01-01.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALERTS = "account_id BIGINT, quiet_since DATE, flagged_on DATE, credits_in_run DECIMAL(38,12)"
EXACT = "decimal(28,12)"
STATE = (
    "accounts ARRAY<STRUCT<account_id BIGINT, due BIGINT, next_day INT, since INT, alerted BOOLEAN, "
    f"credits DECIMAL(38,12), used ARRAY<STRUCT<day INT, credits {EXACT}>>, "
    "terms ARRAY<STRUCT<start INT, end INT, allowance DOUBLE>>>>"
)
GROUPS = 1 << 14
DAY_MS = 86_400_000


def _rows(events: DataFrame, terms: DataFrame) -> DataFrame:
    """Usage rows and contract rows as one stream; contract rows have no event time, so they never move the watermark."""
    blank = lambda kind: F.lit(None).cast(kind)
    usage = events.select(
        "account_id",
        "ts",
        F.unix_date(F.col("ts").cast("date")).alias("day"),
        F.col("credits").cast(EXACT).alias("credits"),
        blank("int").alias("start"),
        blank("int").alias("end"),
        blank("double").alias("allowance"),
    )
    announced = terms.select(
        "account_id",
        blank("timestamp").alias("ts"),
        blank("int").alias("day"),
        blank(EXACT).alias("credits"),
        F.unix_date("start_date").alias("start"),
        F.unix_date("end_date").alias("end"),
        F.col("included_monthly_compute_credits").cast("double").alias("allowance"),
    )
    return usage.unionByName(announced)


def low_use_alerts(
    events: DataFrame,
    terms: DataFrame,
    days: int = 30,
    below: float = 0.05,
    lateness: str = "2 days",
    groups: int = GROUPS,
) -> DataFrame:
    """account_id, quiet_since, flagged_on, credits_in_run: one row per run of ``days`` low days.

    ``events`` has account_id, ts, credits; ``terms`` is a stream of account_id, start_date, end_date,
    included_monthly_compute_credits. State is best kept in RocksDB.
    """
    return (
        _rows(events, terms)
        .withWatermark("ts", lateness)
        .withColumn("group", F.pmod(F.xxhash64("account_id"), F.lit(groups)))
        .groupBy("group")
        .applyInPandasWithState(_low_use(days, below), ALERTS, STATE, "append", "EventTimeTimeout")
    )


def _low_use(days: int, below: float) -> Callable:
    # Defined inside a function, so that it travels to executors with the query.
    day_ms = DAY_MS

    def low_use(key, frames, state):
        import datetime
        from decimal import Decimal

        import pandas as pd

        none, watermark = Decimal(0), state.getCurrentWatermarkMs()
        # Per account: due, next_day, since, alerted, credits, credits by day, terms.
        accounts, called = {}, set()
        for account, *run, used, terms in state.get[0] if state.exists else []:
            accounts[account] = [*run, {d: c for d, c in used}, [tuple(t) for t in terms]]
            if run[0] is not None and run[0] < watermark:
                called.add(account)
        for frame in frames:
            # Missing values are NaN, the only ones that differ from themselves.
            columns = ("account_id", "day", "credits", "start", "end", "allowance")
            for account, day, used, start, end, allowance in zip(*(frame[c].tolist() for c in columns)):
                account = int(account) if account == account and account is not None else None
                called.add(account)
                if account not in accounts:
                    accounts[account] = [None, None, None, False, none, {}, []]
                if start == start and end == end and allowance == allowance:
                    accounts[account][6].append((int(start), int(end), float(allowance)))
                if day == day:
                    open_days = accounts[account][5]
                    open_days[int(day)] = open_days.get(int(day), none) + (used or none)
        out = []
        for account in called:
            run, alerts = closed(accounts[account], watermark)
            accounts[account] = run
            out += [(account, *alert) for alert in alerts]
        waits = [run[0] for run in accounts.values() if run[0] is not None]
        if waits:
            state.setTimeoutTimestamp(max(min(waits), watermark))
        state.update(([(a, *run, list(used.items()), terms) for a, (*run, used, terms) in accounts.items()],))
        if out:
            first = datetime.date(1970, 1, 1)
            rows = [(a, first + datetime.timedelta(days=s), first + datetime.timedelta(days=e), c) for a, s, e, c in out]
            found = pd.DataFrame(rows, columns=["account_id", "quiet_since", "flagged_on", "credits_in_run"])
            yield found.astype({"account_id": "Int64"})

    def closed(account, watermark):
        """The account after the days closed since the last call, and its alerts."""
        from decimal import Decimal

        none = Decimal(0)
        _, next_day, since, alerted, credits, waiting, terms = account
        if not terms:
            return account, []
        if next_day is None:
            next_day = min(t[0] for t in terms)
        end, out = max(t[1] for t in terms), []
        for day in range(next_day, min(max(watermark, 0) // day_ms - 1, end) + 1):
            allowance = sum(t[2] for t in terms if t[0] <= day <= t[1])
            used = waiting.pop(day, none)
            if allowance > 0 and float(used) * 30 / allowance < below:
                if since is None:
                    since, alerted, credits = day, False, none
                credits += used if not alerted else 0
                if not alerted and day - since + 1 >= days:
                    alerted = True
                    out.append((since, day, credits))
            else:
                since, alerted = None, False
            next_day = day + 1
        waiting = {k: v for k, v in waiting.items() if k >= next_day}  # others lie before the first term
        # The first day at whose end an alert is possible.
        if since is None:
            due = next_day + days
        elif not alerted:
            due = since + days
        else:
            due = min(waiting) + days + 1 if waiting else None
        if due is not None and next_day <= end:
            at = due * day_ms
            at = at if at > watermark else (watermark // day_ms + 1) * day_ms
        else:
            at = None
        return [at, next_day, since, alerted, credits, waiting, terms], out

    return low_use
