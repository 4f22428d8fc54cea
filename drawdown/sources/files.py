"""Readers and writers: Parquet and CSV tables, snapshots, exports, views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drawdown.model import ACCOUNTS, CONTRACTS, SALES_REPS, USAGE_LOGS, Tables

RAW_SCHEMAS = {
    "sales_reps": SALES_REPS,
    "accounts": ACCOUNTS,
    "contracts": CONTRACTS,
    "daily_usage_logs": USAGE_LOGS,
}


def load(spark: SparkSession, root: str) -> Tables:
    """The four raw tables from one folder of Parquet tables, explicit schemas."""
    read = {n: spark.read.schema(s).parquet(f"{root}/{n}") for n, s in RAW_SCHEMAS.items()}
    return Tables(
        reps=read["sales_reps"],
        accounts=read["accounts"],
        contracts=read["contracts"],
        logs=read["daily_usage_logs"],
    )


def read_csv_snapshot(
    spark: SparkSession, path: str, schema: T.StructType, date_column: str = "as_of_date"
) -> DataFrame:
    """CSV snapshot with a header; the snapshot date is parsed from its text."""
    text = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name == date_column else f.dataType)
            for f in schema.fields
        ]
    )
    raw = spark.read.schema(text).csv(path, header=True)
    return raw.withColumn(date_column, F.to_date(F.col(date_column)))


def write_table(df: DataFrame, path: str) -> None:
    """Full overwrite; running it again leaves the same table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_usage(df: DataFrame, path: str) -> None:
    """Usage logs laid out by month, so date-bounded jobs read only their months.

    Ranges over (month, account, day, log) give each writer one stretch of a
    month: few files per month, and a hot account is cut into several ranges.
    """
    month = F.trunc("date", "month")
    (
        df.withColumn("usage_month", month)
        .repartitionByRange("usage_month", "account_id", "date", "log_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("usage_month")
        .parquet(path)
    )


def write_snapshot(df: DataFrame, path: str) -> None:
    """One partition per ``as_of_date``; a rerun replaces only its own dates."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("as_of_date")
        .parquet(path)
    )


def read_snapshots(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def stored_dates(spark: SparkSession, path: str, n: int | None = 30) -> DataFrame:
    """as_of_date of the stored snapshots, newest first.

    The dates come from the partitions' folder names; no file is opened.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.to_date(F.regexp_extract("path", r"/as_of_date=(\d{4}-\d{2}-\d{2})/", 1)).alias("as_of_date"))
    )
    newest = listed.distinct().orderBy(F.desc("as_of_date"))
    return newest if n is None else newest.limit(n)


def read_latest(
    spark: SparkSession, path: str, schema: T.StructType, as_of: date, fallback: str = "latest"
) -> DataFrame:
    """One stored snapshot: the newest that is not after ``as_of``, read from its own partition.

    If all stored dates lie after ``as_of``, ``latest`` takes the newest of all,
    ``none`` gives no rows. ``exact`` gives no rows unless the very date is stored,
    and ``all`` every row then.
    """
    dates = stored_dates(spark, path, None)
    day = F.lit(as_of)
    upto = F.max(F.when(F.col("as_of_date") <= day, F.col("as_of_date")))
    exact = F.max(F.when(F.col("as_of_date") == day, day))
    best = {
        "latest": F.coalesce(upto, F.max("as_of_date")),
        "none": upto,
        "exact": exact,
        "all": exact,
    }[fallback]
    found = dates.agg(best.alias("best")).first()["best"]
    stored = read_snapshots(spark, path, schema)
    if found is None and fallback == "all":
        return stored
    return stored.filter(F.col("as_of_date") == F.lit(found).cast("date"))


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
