"""Incremental usage layer: one row per account and day, kept up to date from the log files as they arrive.

``refresh`` compares the log folder with the manifest of files already read and
reads only what changed. New files are summed per account and day and added to
the stored rows of the months they touch. A file that was replaced or removed
can't be subtracted, so its months are summed again from all files that hold
rows of them. Other months are not read and not written.

Layout under the store: ``daily/run=N/usage_month=M`` has the rows of the months
that run N wrote, ``months/run=N`` names them, ``files/run=N`` lists the files it
read or dropped with their months, and ``commits/run=N`` is written last. Readers
look at committed runs only and take each month from the last one that wrote it,
so a run that fails halfway leaves what was there, and running it again, or
running without new files, changes nothing.

``read`` gives rows that stand in for raw logs in every job that starts from
daily totals: pass ``replace(tables, logs=read(spark, store))``.

One writer at a time. The driver holds the paths of files that changed and one
row per month; everything else stays in Spark.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drawdown.functions import to_units
from drawdown.model import USAGE_LOGS
from drawdown.session import materialise

DAILY = "account_id BIGINT, date DATE, units BIGINT, log_count BIGINT"
FILES = "path STRING, length BIGINT, modified TIMESTAMP, usage_month DATE, n_logs BIGINT, gone BOOLEAN"
COMMITS = "new_files BIGINT, gone_files BIGINT, months BIGINT, log_count BIGINT"


def _table(spark: SparkSession, path: str, schema: str, key: str = "run INT") -> DataFrame:
    """A table partitioned by run; empty before the first write."""
    whole = T.StructType.fromDDL(f"{schema}, {key}")
    if not _exists(spark, path):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _plain(path: Column) -> Column:
    """One spelling of a file's address; readers write the slashes after the scheme differently."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def listing(spark: SparkSession, logs: str) -> DataFrame:
    """path, length, modified of every Parquet file under a folder; no file is opened."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(logs)
    )
    return found.select(
        _plain(F.col("path")).alias("path"), "length", F.col("modificationTime").alias("modified")
    )


def committed(spark: SparkSession, store: str) -> list[int]:
    """Runs that ended, oldest first."""
    runs = _table(spark, f"{store}/commits", COMMITS).select("run").distinct().collect()
    return sorted(r["run"] for r in runs)


def manifest(spark: SparkSession, store: str, runs: list[int] | None = None) -> DataFrame:
    """The files the stored rows come from: path, length, modified, usage_month, n_logs, one row per file and month."""
    runs = committed(spark, store) if runs is None else runs
    rows = _table(spark, f"{store}/files", FILES).filter(F.col("run").isin(runs))
    last = rows.groupBy("path").agg(F.max("run").alias("run"))
    return rows.join(last, ["path", "run"]).filter(~F.col("gone")).drop("gone", "run")


def _current(spark: SparkSession, store: str, runs: list[int]) -> dict:
    """The run that wrote each month last."""
    rows = _table(spark, f"{store}/months", "usage_month DATE").filter(F.col("run").isin(runs))
    return dict(rows.groupBy("usage_month").agg(F.max("run")).collect())


def _stored(spark: SparkSession, store: str, months: dict) -> DataFrame:
    """Stored rows of some months, each from one run; the filter is on partitions only."""
    rows = _table(spark, f"{store}/daily", DAILY, "run INT, usage_month DATE")
    by_run: dict[int, list] = {}
    for month, run in months.items():
        by_run.setdefault(run, []).append(month)
    wanted = [(F.col("run") == run) & F.col("usage_month").isin(some) for run, some in sorted(by_run.items())]
    return rows.filter(reduce(lambda a, b: a | b, wanted, F.lit(False))).drop("run")


def read(spark: SparkSession, store: str) -> DataFrame:
    """account_id, date, units, log_count, usage_month as of the last committed run."""
    return _stored(spark, store, _current(spark, store, committed(spark, store)))


def _logs(spark: SparkSession, paths: list[str]) -> DataFrame:
    logs = spark.read.schema(USAGE_LOGS).parquet(*paths) if paths else spark.createDataFrame([], USAGE_LOGS)
    return logs.withColumn("usage_month", F.trunc("date", "month"))


def _summed(logs: DataFrame) -> DataFrame:
    return logs.groupBy("account_id", "date", "usage_month").agg(
        F.sum(to_units(F.col("compute_credits_consumed"))).alias("units"),
        F.count(F.lit(1)).alias("log_count"),
    )


def refresh(spark: SparkSession, logs: str, store: str) -> int | None:
    """Bring the store up to date; the new run's number, or None if no file changed."""
    runs = committed(spark, store)
    run = (runs[-1] if runs else 0) + 1
    known = materialise(manifest(spark, store, runs), "usage-manifest")
    there = listing(spark, logs)
    same = ["path", "length", "modified"]
    fresh = there.join(known.select(*same).distinct(), same, "left_anti").collect()
    lost = known.join(there, same, "left_anti").select("path", "usage_month").distinct()
    lost = [(r["path"], r["usage_month"]) for r in lost.collect()]
    if not fresh and not lost:
        return None
    paths = [r["path"] for r in fresh]
    gone = {path for path, _ in lost}
    again = sorted({month for _, month in lost if month is not None})

    new = _logs(spark, paths)
    held = (
        new.groupBy(_plain(F.col("_metadata.file_path")).alias("path"), "usage_month")
        .agg(F.count(F.lit(1)).alias("n_logs"))
        if paths
        else spark.createDataFrame([], "path STRING, usage_month DATE, n_logs BIGINT")
    )
    seen = spark.createDataFrame([tuple(r) for r in fresh], "path STRING, length BIGINT, modified TIMESTAMP")
    dropped = spark.createDataFrame([(p,) for p in sorted(gone - set(paths))], "path STRING")
    files = seen.join(held, "path", "left").withColumn("gone", F.lit(False)).unionByName(
        dropped.withColumn("gone", F.lit(True)), allowMissingColumns=True
    )
    _write(files.select(*[c.split()[0] for c in FILES.split(", ")]), f"{store}/files", run)

    listed = _table(spark, f"{store}/files", FILES).filter(F.col("run") == run)
    touched = sorted(
        {r[0] for r in listed.select("usage_month").distinct().collect() if r[0] is not None} | set(again)
    )
    whole = known.filter(F.col("usage_month").isin(again) & ~F.col("path").isin(sorted(gone))).select("path").distinct()
    kept = [r["path"] for r in whole.collect()] if again else []
    current = _current(spark, store, runs)
    added = {m: current[m] for m in touched if m in current and m not in again}
    rows = _stored(spark, store, added).unionByName(_summed(new))
    if kept:
        rows = rows.unionByName(_summed(_logs(spark, kept).filter(F.col("usage_month").isin(again))))
    merged = rows.groupBy("account_id", "date", "usage_month").agg(
        F.sum("units").alias("units"), F.sum("log_count").alias("log_count")
    )
    # Ranges over (month, account, day) give each writer one stretch of a month.
    dealt = merged.filter(F.col("usage_month").isNotNull()).repartitionByRange("usage_month", "account_id", "date")
    _write(dealt, f"{store}/daily", run, "usage_month")
    _write(spark.createDataFrame([(m,) for m in touched], "usage_month DATE"), f"{store}/months", run)
    total = listed.agg(F.coalesce(F.sum("n_logs"), F.lit(0))).first()[0]
    done = [(len(paths), len(gone), len(touched), int(total))]
    _write(spark.createDataFrame(done, COMMITS), f"{store}/commits", run)
    return run


def _write(df: DataFrame, path: str, run: int, *parts: str) -> None:
    """A run's rows; what a failed attempt at the same run left is replaced."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*parts)
        .parquet(f"{path}/run={run}")
        if parts
        else df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/run={run}")
    )
