"""History and audit: corrections, versions, amendments, retention and run log."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from drawdown.functions import as_date, count_where, ratio, round_half_up, true_if
from drawdown.model import ATTAINMENT_TARGET, SHELFWARE_TARGET, Tables
from drawdown.operators.contracts import active_at, valid_contracts
from drawdown.operators.skew import ordinal, salted_join


def snapshot_corrections(before: DataFrame, after: DataFrame) -> DataFrame:
    """Old and new value and tier where two runs of a snapshot differ."""
    keys = ["account_id", "as_of_date"]
    old = before.select(
        *keys, F.col("cacv").alias("old_cacv"), F.col("health_tier").alias("old_health_tier")
    )
    new = after.select(
        *keys, F.col("cacv").alias("new_cacv"), F.col("health_tier").alias("new_health_tier")
    )
    same = F.col("old_cacv").eqNullSafe(F.col("new_cacv")) & F.col("old_health_tier").eqNullSafe(
        F.col("new_health_tier")
    )
    return old.join(new, keys, "full_outer").filter(~same)


def scd2(
    changes: DataFrame, key: str, day: str, attributes: list[str], valid_from: str = "valid_from"
) -> DataFrame:
    """Type-2 versions from dated observations: one row per real change.

    Observations are unique per (key, day), so a key's window is bounded by the
    calendar.
    """
    order = W.partitionBy(key).orderBy(day)
    previous = F.lag(F.struct(*attributes)).over(order)
    changed = changes.withColumn("_prev", previous).filter(
        F.col("_prev").isNull() | ~F.struct(*attributes).eqNullSafe(F.col("_prev"))
    )
    until = F.date_sub(F.lead(day).over(order), 1)
    return changed.withColumn("valid_to", until).select(
        key,
        *attributes,
        F.col(day).alias(valid_from),
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


# Fields an amendment may change, with their types.
AMENDABLE = {
    "annual_commit_dollars": "bigint",
    "end_date": "date",
    "included_monthly_compute_credits": "bigint",
}


def _latest(group: DataFrame, keys: list[str]) -> DataFrame:
    """Winning new value per amendable field, one column each.

    Later effective dates win, then later creation, then the larger id and value.
    """
    rank = F.struct("effective_date", "created_at", "amendment_id", "new_value")
    columns = [
        F.max(F.when(F.col("field_changed") == name, rank))["new_value"].alias(f"new_{name}")
        for name in AMENDABLE
    ]
    return group.groupBy(*keys).agg(*columns)


def contracts_as_of(contracts: DataFrame, amendments: DataFrame, as_of: date) -> DataFrame:
    """Contracts with every amendment effective by as-of applied, field by field."""
    due = amendments.filter(F.col("effective_date") <= as_date(as_of))
    amended = contracts.join(_latest(due, ["contract_id"]), "contract_id", "left")
    columns = []
    for name in contracts.columns:
        if name in AMENDABLE:
            new = F.col(f"new_{name}").try_cast(AMENDABLE[name])
            columns.append(F.coalesce(new, F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    return amended.select(*columns)


def contract_observations(contracts: DataFrame, amendments: DataFrame) -> DataFrame:
    """The amendable fields of each contract on its first day and on every day an amendment takes effect.

    Amendments are reduced to one row per contract and effective date before
    any window runs over them. Unique per (contract_id, observed_on).
    """
    dated = _latest(amendments, ["contract_id", "effective_date"]).join(
        contracts.select("contract_id", "start_date"), "contract_id"
    )
    # Changes effective before the start belong to the signed version's day.
    day = F.greatest("effective_date", "start_date")
    order = W.partitionBy("contract_id", "_day").orderBy(F.desc("effective_date"))
    merged = (
        dated.withColumn("_day", day)
        .select(
            "contract_id",
            "_day",
            *[
                F.first(f"new_{n}", ignorenulls=True)
                .over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
                .alias(f"new_{n}")
                for n in AMENDABLE
            ],
            F.row_number().over(order).alias("_rn"),
        )
        .filter(F.col("_rn") == 1)
        .drop("_rn")
    )
    opening = contracts.select("contract_id", F.col("start_date").alias("_day"), *AMENDABLE)
    values = [
        F.coalesce(F.col(f"new_{n}").try_cast(kind), F.col(n)).alias(n)
        for n, kind in AMENDABLE.items()
    ]
    points = opening.join(merged, ["contract_id", "_day"], "full_outer").select(
        "contract_id", "_day", *values
    )
    carried = W.partitionBy("contract_id").orderBy("_day").rowsBetween(W.unboundedPreceding, 0)
    return points.select(
        "contract_id",
        F.col("_day").alias("observed_on"),
        *[F.last(n, ignorenulls=True).over(carried).alias(n) for n in AMENDABLE],
    )


def scd2_contracts(contracts: DataFrame, amendments: DataFrame) -> DataFrame:
    """Versions of each contract: the signed one, then one per date that changed a field."""
    observed = contract_observations(contracts, amendments)
    return scd2(observed, "contract_id", "observed_on", list(AMENDABLE))


def retention_metrics(contracts: DataFrame, t0: date, t1: date) -> DataFrame:
    """NRR, GRR and logo churn of the accounts active at ``t0``, seen at ``t1``."""

    def commit_at(day: date, name: str) -> DataFrame:
        return active_at(contracts, day).groupBy("account_id").agg(
            F.sum("annual_commit_dollars").alias(name)
        )

    primary_end = active_at(contracts, t0).groupBy("account_id").agg(
        F.sum("annual_commit_dollars").alias("begin"),
        F.min_by("end_date", F.struct("start_date", "contract_id")).alias("primary_end"),
    )
    joined = primary_end.join(commit_at(t1, "end"), "account_id", "left").withColumn(
        "end", F.coalesce("end", F.lit(0))
    )
    change = F.col("end") - F.col("begin")
    lost = F.col("end") == 0
    up_for_renewal = (F.col("primary_end") > as_date(t0)) & (F.col("primary_end") <= as_date(t1))
    total = joined.agg(
        F.count(F.lit(1)).alias("accounts"),
        F.sum("begin").alias("begin_acv"),
        F.coalesce(F.sum(F.when(~lost & (change > 0), change)), F.lit(0)).alias("expansion_acv"),
        F.coalesce(F.sum(F.when(~lost & (change < 0), -change)), F.lit(0)).alias("contraction_acv"),
        F.coalesce(F.sum(F.when(lost, F.col("begin"))), F.lit(0)).alias("churned_acv"),
        count_where(up_for_renewal).alias("up_for_renewal"),
        count_where(up_for_renewal & lost).alias("lost_accounts"),
    )
    kept = F.col("begin_acv") - F.col("contraction_acv") - F.col("churned_acv")
    return total.select(
        "*",
        round_half_up(ratio(kept + F.col("expansion_acv"), F.col("begin_acv")), 4).alias("nrr"),
        round_half_up(ratio(kept, F.col("begin_acv")), 4).alias("grr"),
        round_half_up(ratio(F.col("lost_accounts"), F.col("up_for_renewal")), 4).alias(
            "logo_churn"
        ),
    )


def success_kpis(facts: DataFrame, as_of: date, ramp_from: date, flagged_from: date) -> DataFrame:
    """The four success targets from facts at three snapshot dates (one frame).

    Activation: ramping at ``ramp_from`` and Healthy or better at as-of.
    Conversion: flagged at ``flagged_from`` with a larger commit at as-of.
    """
    day = F.col("as_of_date")

    def at(when: date, value):
        return F.max(F.when(day == as_date(when), value))

    one = facts.groupBy("account_id").agg(
        at(as_of, F.col("annual_commit_dollars")).alias("commit"),
        at(as_of, F.col("cacv")).alias("cacv"),
        at(as_of, F.when(~F.col("is_new_account"), F.col("annual_commit_dollars"))).alias("mature"),
        at(as_of, F.col("health_tier")).alias("tier"),
        at(ramp_from, F.col("is_new_account")).alias("was_ramping"),
        at(flagged_from, F.col("expansion_flag")).alias("was_flagged"),
        at(flagged_from, F.col("annual_commit_dollars")).alias("old_commit"),
    )
    ramped, flagged = true_if(F.col("was_ramping")), true_if(F.col("was_flagged"))
    active = F.col("commit").isNotNull()
    healthy = F.col("tier").isin("Healthy", "Expansion")
    shelf = F.col("tier").isin("Shelfware", "Inactive")
    grew = F.col("commit") > F.col("old_commit")
    total = one.agg(
        F.sum(F.col("cacv").cast("decimal(18,2)")).alias("cacv"),
        F.sum("mature").alias("mature"),
        count_where(active & shelf).alias("shelf"),
        count_where(active).alias("active"),
        count_where(ramped).alias("ramped"),
        count_where(ramped & healthy).alias("activated"),
        count_where(flagged).alias("flagged"),
        count_where(flagged & grew).alias("converted"),
    )

    def kpi(name: str, value, target: float, at_least: bool):
        rate = round_half_up(value, 4)
        met = rate >= target if at_least else rate <= target
        return F.struct(
            F.lit(name).alias("kpi"),
            rate.alias("value"),
            F.lit(target).alias("target"),
            met.alias("met"),
        )

    rows = F.array(
        kpi("org attainment", ratio(F.col("cacv"), F.col("mature")), ATTAINMENT_TARGET, True),
        kpi("shelfware rate", ratio(F.col("shelf"), F.col("active")), SHELFWARE_TARGET, False),
        kpi("expansion conversion", ratio(F.col("converted"), F.col("flagged")), 0.30, True),
        kpi("new account activation", ratio(F.col("activated"), F.col("ramped")), 0.70, True),
    )
    return total.select(F.inline(rows))


def key_remap(
    source: DataFrame,
    target: DataFrame,
    bucket: list[str],
    source_order: str,
    key: str = "employee_id",
) -> DataFrame:
    """Map source keys to target keys by position inside a bucket, cycling.

    Both sides are numbered in bounded tasks. A bucket without targets keeps its
    source keys.
    """
    numbered = ordinal(source, bucket, source_order, "_pos")
    targets = ordinal(target.select(*bucket, F.col(key).alias("_new")), bucket, "_new", "_at")
    sizes = targets.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_size"))
    placed = salted_join(numbered, sizes, bucket, "left", spread=["_pos"]).withColumn(
        "_at", F.pmod(F.col("_pos") - 1, F.col("_size")) + 1
    )
    return placed.join(targets, [*bucket, "_at"], "left").select(
        F.col(key).alias("source_key"),
        *bucket,
        F.coalesce("_new", F.col(key)).alias("target_key"),
    )


def dim_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.select("account_id", "company_name", "industry").distinct()


def dim_reps(reps: DataFrame) -> DataFrame:
    return reps.select("employee_id", "name", "region", "segment").distinct()


def dim_contracts(contracts: DataFrame) -> DataFrame:
    return contracts.withColumnRenamed("owner_id", "signing_owner_id")
