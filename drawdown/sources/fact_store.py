"""Stored account snapshots with provenance, and the record of what later runs corrected.

``write`` stores the snapshots of one run. Rows are dealt to buckets by account,
and a bucket of a date has a checksum: the row count and four sums over the
SHA-256 of its rows, which no order of rows changes. Buckets whose checksum
is the stored one are neither read nor written; the others are compared row by
row with what is stored.

A row that is as it was keeps the run it came from. A row that is new or differs
carries this run as ``pipeline_run_id``, and ``is_correction`` where it replaced a
calculation of the same account and date. Where the value or the tier differs,
also because the row is gone or new on a date that had been stored, a run that
is a correction leaves a row in ``corrections``: old and new, the reason, who did and
approved it, the fiscal quarter paid for, and the clawback.

A clawback is triggered where a date up to ``paid_through`` loses value; its amount
is what the value lost, a missing row counting as zero. What share of it is paid back is the compensation plan's matter.

Layout under the store, one folder a run: ``rows/as_of_date=D/bucket=B``, ``parts``
(checksums of the buckets it wrote), ``corrections``, and ``commits``, written
last. A run that fails halfway leaves what was there.

Defined results: rows are unique per account and date; a date is always given
whole, so stored accounts it lacks are gone; dates a run does not name stay; a
run without rows changes nothing; nulls equal nulls.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drawdown.model import ACCOUNT_FACT
from drawdown.operators.calendar import fiscal_quarter_label
from drawdown.session import materialise
from drawdown.sources import runs

COMMITS = "pipeline_run_id STRING, buckets INT, changed_buckets BIGINT, corrections BIGINT"
PARTS = (
    "as_of_date DATE, bucket INT, n BIGINT, s0 DECIMAL(38,0), s1 DECIMAL(38,0), s2 DECIMAL(38,0), s3 DECIMAL(38,0)"
)
CORRECTIONS = (
    "correction_id STRING, pipeline_run_id STRING, account_id BIGINT, as_of_date DATE, corrected_at TIMESTAMP, "
    "corrected_by STRING, old_cacv DOUBLE, new_cacv DOUBLE, old_health_tier STRING, new_health_tier STRING, "
    "correction_reason STRING, comp_period_affected STRING, clawback_triggered BOOLEAN, clawback_amount DOUBLE, "
    "approved_by STRING"
)
_KEYS = ["account_id", "as_of_date"]
_SUMS = ["n", "s0", "s1", "s2", "s3"]
#: Stored columns: the fact without the time of the run, which is no part of a result.
FACT = T.StructType([f for f in ACCOUNT_FACT.fields if f.name not in ("calculated_at", "as_of_date")])
_STORED = ", ".join(
    [f"{f.name} {f.dataType.simpleString()}" for f in FACT.fields]
    + ["digest STRING", "pipeline_run_id STRING", "is_correction BOOLEAN"]
)


@dataclass(frozen=True)
class Correction:
    """Why a run replaces what was stored, who did it and who approved it; all three are required."""

    reason: str
    by: str
    approved_by: str
    paid_through: date
    at: datetime | None = None

    def __post_init__(self):
        if not (self.reason and self.by and self.approved_by):
            raise ValueError("a correction needs a reason, an author and an approver")


def _rows(spark: SparkSession, store: str) -> DataFrame:
    return runs.table(spark, f"{store}/rows", _STORED, "run INT, as_of_date DATE, bucket INT")


def _place(day: Column, bucket: Column) -> Column:
    return F.concat_ws("|", day.cast("string"), bucket.cast("string"))


def _checksums(rows: DataFrame) -> DataFrame:
    """Row count and sums of the four quarters of the digests, 60 bits each."""
    parts = [
        F.sum(F.conv(F.substring("digest", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)").alias(f"s{i}")
        for i in range(4)
    ]
    return rows.groupBy("as_of_date", "bucket").agg(F.count(F.lit(1)).alias("n"), *parts)


def _stored_parts(spark: SparkSession, store: str, upto: int) -> DataFrame:
    """The newest checksum of each bucket of each date, with the run that wrote it."""
    rows = runs.table(spark, f"{store}/parts", PARTS).filter(F.col("run") <= upto)
    newest = rows.groupBy("as_of_date", "bucket").agg(F.max_by(F.struct("run", *_SUMS), "run").alias("_top"))
    return newest.select("as_of_date", "bucket", "_top.*")


def _only(rows: DataFrame, places: dict[str, int]) -> DataFrame:
    """Rows of the named buckets, each from its run; the filter is on partition columns only."""
    pairs = [F.lit(x) for pair in sorted(places.items()) for x in pair]
    run = F.try_element_at(F.create_map(*pairs), _place(F.col("as_of_date"), F.col("bucket"))) if pairs else F.lit(None)
    return rows.filter(F.col("run") == run.cast("int"))


def differing(spark: SparkSession, store: str, new: DataFrame, upto: int) -> list:
    """Buckets whose checksum is not the stored one: as_of_date, bucket, the run stored (or None) and whether the date was.

    ``new`` has checksums of whole dates. At most dates times buckets rows come to the driver.
    """
    dates = new.select("as_of_date").distinct()
    old = _stored_parts(spark, store, upto).join(dates, "as_of_date", "left_semi")
    known = old.select("as_of_date").distinct().withColumn("known", F.lit(True))
    had = old.select("as_of_date", "bucket", "run", F.struct(*_SUMS).alias("_old"))
    got = new.select("as_of_date", "bucket", F.struct(*_SUMS).alias("_new"))
    both = had.join(got, ["as_of_date", "bucket"], "full_outer").join(known, "as_of_date", "left")
    nothing = F.col("_new").isNull() & (F.col("_old.n") == 0)
    return both.filter(~F.col("_old").eqNullSafe(F.col("_new")) & ~F.coalesce(nothing, F.lit(False))).select(
        "as_of_date", "bucket", "run", F.coalesce("known", F.lit(False)).alias("known")
    ).collect()


def write(
    spark: SparkSession, store: str, fact: DataFrame, pipeline_run_id: str, correction: Correction | None = None,
    buckets: int = 64,
) -> int | None:
    """Store a run's snapshots, all accounts of each date it names; the run's number, or None without rows.

    ``buckets`` is fixed by the first run.
    """
    last = runs.last_commit(spark, store, COMMITS)
    if last and last["buckets"] != buckets:
        raise ValueError(f"{store} has {last['buckets']} buckets, not {buckets}")
    upto = last["run"] if last else 0
    run = upto + 1
    values = [f.name for f in FACT.fields]
    new = materialise(
        fact.select(*values, "as_of_date")
        .withColumn("digest", F.sha2(F.to_json(F.struct(*values)), 256))
        .withColumn("bucket", F.pmod(F.xxhash64("account_id"), F.lit(buckets)).cast("int")),
        "fact-run",
    )
    sums = materialise(_checksums(new), "fact-checksums")
    if sums.isEmpty():
        return None
    changed = differing(spark, store, sums, upto)
    places = {f"{r['as_of_date']}|{r['bucket']}": r["run"] for r in changed}
    known = sorted({r["as_of_date"] for r in changed if r["known"]})
    here = _place(F.col("as_of_date"), F.col("bucket")).isin(sorted(places))
    old = _only(_rows(spark, store), {p: r for p, r in places.items() if r is not None}).select(
        *_KEYS, *[F.col(c).alias(f"_{c}") for c in ("cacv", "health_tier", "digest", "pipeline_run_id", "is_correction")]
    )
    fresh = new.filter(here).withColumn("_new", F.lit(True))
    met = fresh.join(old.withColumn("_old", F.lit(True)), _KEYS, "full_outer")
    same = F.coalesce(F.col("digest") == F.col("_digest"), F.lit(False))
    rows = met.filter("_new").select(
        *values,
        "digest",
        F.when(same, F.col("_pipeline_run_id")).otherwise(F.lit(pipeline_run_id)).alias("pipeline_run_id"),
        F.when(same, F.col("_is_correction")).otherwise(F.col("_old").isNotNull()).alias("is_correction"),
        "as_of_date",
        "bucket",
    )
    runs.write(rows.repartition("as_of_date", "bucket"), f"{store}/rows", run, "as_of_date", "bucket")
    found = 0
    if correction:
        was_stored = met.filter(F.col("as_of_date").isin(known))
        runs.write(_corrections(was_stored, pipeline_run_id, correction), f"{store}/corrections", run)
        found = runs.table(spark, f"{store}/corrections", CORRECTIONS).filter(F.col("run") == run).count()
    emptied = spark.createDataFrame([(r["as_of_date"], r["bucket"]) for r in changed], "as_of_date DATE, bucket INT")
    noted = emptied.join(sums, ["as_of_date", "bucket"], "left").fillna(0, ["n"])
    runs.write(noted.select("as_of_date", "bucket", *_SUMS), f"{store}/parts", run)
    runs.commit(spark, store, COMMITS, (pipeline_run_id, buckets, len(changed), found), run)
    return run


def _corrections(met: DataFrame, pipeline_run_id: str, why: Correction) -> DataFrame:
    """One row per account and date whose value or tier differs between the stored and the new row."""
    gone, came = F.col("_new").isNull(), F.col("_old").isNull()
    same = F.col("cacv").eqNullSafe(F.col("_cacv")) & F.col("health_tier").eqNullSafe(F.col("_health_tier"))
    lost = F.coalesce("_cacv", F.lit(0.0)) - F.coalesce("cacv", F.lit(0.0))
    back = (lost > 0) & (F.col("as_of_date") <= F.lit(why.paid_through))
    return met.filter(gone | came | ~same).select(
        F.md5(F.concat_ws("|", F.lit(pipeline_run_id), F.col("account_id").cast("string"), F.col("as_of_date").cast("string"))).alias(
            "correction_id"
        ),
        F.lit(pipeline_run_id).alias("pipeline_run_id"),
        *_KEYS,
        F.lit(why.at).cast("timestamp").alias("corrected_at"),
        F.lit(why.by).alias("corrected_by"),
        F.col("_cacv").alias("old_cacv"),
        F.col("cacv").alias("new_cacv"),
        F.col("_health_tier").alias("old_health_tier"),
        F.col("health_tier").alias("new_health_tier"),
        F.lit(why.reason).alias("correction_reason"),
        fiscal_quarter_label(F.col("as_of_date")).alias("comp_period_affected"),
        back.alias("clawback_triggered"),
        F.when(back, F.round(lost, 2)).alias("clawback_amount"),
        F.lit(why.approved_by).alias("approved_by"),
    )


def read(spark: SparkSession, store: str, as_of: date | None = None) -> DataFrame:
    """Stored snapshots as of the last committed run, with pipeline_run_id and is_correction; one date or all.

    One row per bucket and date comes to the driver; other runs' and dates' folders are not opened.
    """
    last = runs.last_commit(spark, store, COMMITS)
    parts = _stored_parts(spark, store, last["run"] if last else 0)
    if as_of is not None:
        parts = parts.filter(F.col("as_of_date") == F.lit(as_of))
    places = {f"{r['as_of_date']}|{r['bucket']}": r["run"] for r in parts.select("as_of_date", "bucket", "run").collect()}
    return _only(_rows(spark, store), places).select(
        *[f.name for f in FACT.fields], "as_of_date", "pipeline_run_id", "is_correction"
    )


def corrections(spark: SparkSession, store: str) -> DataFrame:
    """Every correction of committed runs."""
    last = runs.last_commit(spark, store, COMMITS)
    rows = runs.table(spark, f"{store}/corrections", CORRECTIONS)
    return rows.filter(F.col("run") <= (last["run"] if last else 0)).drop("run")
