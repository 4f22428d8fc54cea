"""Literal rows as logical tables."""

from __future__ import annotations

from datetime import date

from drawdown.model import ACCOUNTS, CONTRACTS, SALES_REPS, USAGE_LOGS, Tables

AS_OF = date(2025, 6, 30)


def d(text: str) -> date:
    return date.fromisoformat(text)


def contract(cid, account, start, end, commit=1200, credits=100, term=12, owner=1):
    return (cid, account, owner, d(start), d(end), commit, credits, term)


def log(lid, account, day, credits):
    return (lid, account, d(day), float(credits))


def tables(spark, contracts=(), logs=(), accounts=None, reps=None) -> Tables:
    """Accounts default to those the contracts name; one rep owns everything."""
    if accounts is None:
        accounts = [(a, f"Company {a}", "Tech", 1) for a in sorted({c[1] for c in contracts})]
    if reps is None:
        reps = [(1, "Rep One", "EMEA", "Enterprise", 7, "Boss")]
    loose = USAGE_LOGS.fromDDL(
        "log_id long, account_id long, date date, compute_credits_consumed double"
    )
    return Tables(
        reps=spark.createDataFrame(reps, SALES_REPS),
        accounts=spark.createDataFrame(accounts, ACCOUNTS),
        contracts=spark.createDataFrame(list(contracts), CONTRACTS),
        logs=spark.createDataFrame(list(logs), loose),
    )


def rows(df, *keys):
    """Rows as dicts, keyed by the given columns."""
    out = {}
    for row in df.collect():
        values = row.asDict()
        key = tuple(values[k] for k in keys)
        assert key not in out, f"duplicate key {key}"
        out[key[0] if len(keys) == 1 else key] = values
    return out
