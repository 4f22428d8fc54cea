"""The batch run: raw tables to fact, roll-ups, views and checks."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drawdown.model import Tables
from drawdown.operators import calendar, history, quality, rollups, views
from drawdown.operators.contracts import active_contracts
from drawdown.operators.metrics import account_metrics, with_rep
from drawdown.operators.rates import trailing_stats
from drawdown.operators.usage import monthly_consumption
from drawdown.plans.audit import AuditedRun, read_run_log
from drawdown.sources import files


@dataclass(frozen=True)
class Run:
    """What a run produced, each a lazily read table in ``root``."""

    fact: DataFrame
    outputs: dict[str, DataFrame]


def build_all(
    spark: SparkSession,
    t: Tables,
    as_of: date,
    root: str,
    run_ts: datetime,
    run_id: str = "run",
) -> Run:
    """Every layer for one date.

    Each layer is written once and the next reads it back: the metric scans the
    usage logs a single time (the quality checks have their own scans), and a
    lost executor never sends a view back to them. The run log has the run's
    state and the rows it wrote, also when a layer fails.
    """
    with AuditedRun(spark, f"{root}/run_log", run_id, as_of, run_ts) as run:
        made = _build(spark, t, as_of, root, run_ts, run)
    log = read_run_log(spark, f"{root}/run_log").filter(F.col("run_id") == run.run_id)
    return Run(fact=made.fact, outputs=made.outputs | {"run_log": files.register_view(log, "run_log")})


def _build(
    spark: SparkSession, t: Tables, as_of: date, root: str, run_ts: datetime, run: AuditedRun
) -> Run:
    def stored(df: DataFrame, name: str) -> DataFrame:
        kind = "dim" if name.startswith("dim_") and name != "dim_dates" else "view"
        run.write(name, df, lambda out: files.write_table(out, f"{root}/{name}"), kind)
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    active = stored(active_contracts(t.contracts, t.accounts, as_of), "active_contracts")
    monthly = stored(monthly_consumption(t, before=as_of.replace(day=1)), "monthly_consumption")
    snapshot = account_metrics(
        active, trailing_stats(monthly, as_of), with_rates=True, run_ts=run_ts
    )
    run.write("account_fact", snapshot, lambda out: files.write_snapshot(out, f"{root}/account_fact"), "fact")
    fact = files.read_snapshots(spark, f"{root}/account_fact", snapshot.schema).filter(
        f"as_of_date = date'{as_of.isoformat()}'"
    )
    owned = with_rep(fact, t.reps)
    outputs = {
        "dim_dates": calendar.dim_dates(spark),
        "dim_accounts": history.dim_accounts(t.accounts),
        "dim_reps": history.dim_reps(t.reps),
        "dim_contracts": history.dim_contracts(t.contracts),
        "rep_rollup": rollups.rep_rollup(fact, t.reps),
        "rep_portfolio": rollups.rep_portfolio(fact, t.reps),
        "account_detail": views.account_detail(owned),
        "comp_input": rollups.comp_input(fact, t.reps),
        "renewal_pipeline": views.renewal_pipeline(owned),
        "org_summary": rollups.org_summary(fact, t.reps),
        "dq_report": quality.dq_report(t, as_of),
    }
    written = {}
    for name, df in outputs.items():
        written[name] = files.register_view(stored(df, name), name)
    return Run(fact=fact, outputs=written)
