"""Structured Streaming jobs over usage events.

Input rows carry ``log_id, account_id, ts, credits``. Each job is a streaming
DataFrame; ``run_available`` drives one to completion over what is there and
leaves its result as a Parquet table in shared storage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drawdown.functions import month_number, true_if, utc_clock, utc_instant
from drawdown.operators.contracts import contract_months, is_covered
from drawdown.operators.skew import salted_join
from drawdown.session import work_dir
from drawdown.sources import files, runs


def event_stream(
    spark: SparkSession, sf_dir: str, schema: str, max_files: int | None = None
) -> DataFrame:
    """The events table as a file stream, renamed to usage columns."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return usage_events(reader.parquet(sf_dir))


def usage_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("log_id"),
        F.col("user_id").alias("account_id"),
        utc_instant(F.col("ts")).alias("ts"),
        F.col("value").alias("credits"),
    )


def daily_usage(stream: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Credits per account and day; a day is final once the watermark passes its end."""
    return (
        stream.withWatermark("ts", lateness)
        .groupBy(F.window("ts", "1 day").alias("w"), "account_id")
        .agg(
            F.sum(F.col("credits").cast("decimal(28,12)")).cast("double").alias("credits_consumed"),
            F.count(F.lit(1)).alias("log_count"),
        )
        .select(
            "account_id",
            utc_clock(F.col("w.start")).cast("date").alias("date"),
            "credits_consumed",
            "log_count",
        )
    )


DAILY = (
    "account_id BIGINT, date DATE, credits_consumed DOUBLE, log_count BIGINT, last_ts TIMESTAMP, batch_id BIGINT"
)


def daily_updates(stream: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Totals so far per account and day and the last event in them, for update mode: no day waits for the watermark."""
    return (
        stream.withWatermark("ts", lateness)
        .groupBy(F.window("ts", "1 day").alias("w"), "account_id")
        .agg(
            F.sum(F.col("credits").cast("decimal(28,12)")).cast("double").alias("credits_consumed"),
            F.count(F.lit(1)).alias("log_count"),
            F.max("ts").alias("last_ts"),
        )
        .select(
            "account_id",
            utc_clock(F.col("w.start")).cast("date").alias("date"),
            "credits_consumed",
            "log_count",
            "last_ts",
        )
    )


def daily_upsert(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer of changed totals; a replayed batch replaces its own rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )

    return write


def daily_table(spark: SparkSession, path: str, lateness: str = "2 days") -> DataFrame:
    """One row per account and day, by its newest total; a day is final once the watermark has passed its end."""
    updates = spark.read.schema(DAILY).parquet(path)
    total = F.struct("credits_consumed", "log_count")
    newest = updates.groupBy("account_id", "date").agg(F.max_by(total, "batch_id").alias("total"))
    mark = updates.agg((utc_clock(F.max("last_ts")) - F.expr(f"interval {lateness}")).alias("mark"))
    return newest.crossJoin(mark).select(
        "account_id",
        "date",
        "total.*",
        (F.date_add("date", 1).cast("timestamp_ntz") <= F.col("mark")).alias("is_final"),
    )


def daily_with_late(
    path: str, late_path: str, lateness: str = "2 days"
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer of daily totals that keeps what comes too late.

    Each batch is split by the newest event time of all batches before it, less
    ``lateness``: rows of days still open go to the daily sums at ``path``, rows
    of days that were final already go to ``late_path`` as they are. Rows without
    a time are late too, so every event is in exactly one of the two. The mark
    is read from what earlier batches left (one row a batch), so a replayed batch
    splits as it did before and replaces its own rows in both places.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = _mark(spark, f"{path}-marks", batch_id)
        gap = F.expr(f"interval {lateness}")
        rows = batch.withColumn("date", utc_clock(F.col("ts")).cast("date")).withColumn(
            "batch_id", F.lit(batch_id).cast("long")
        )
        if mark is None:
            final = F.lit(False)
        else:
            final = F.date_add("date", 1).cast("timestamp_ntz") <= F.lit(mark) - gap
        late = F.coalesce(final, F.lit(True)) | F.col("ts").isNull()
        daily = (
            rows.filter(~late)
            .groupBy("account_id", "date", "batch_id")
            .agg(
                F.sum(F.col("credits").cast("decimal(28,12)")).alias("credits"),
                F.count(F.lit(1)).alias("log_count"),
            )
        )
        _replace(daily, path)
        _replace(rows.filter(late).select("log_id", "account_id", "date", "credits", "batch_id"), late_path)
        newest = rows.groupBy("batch_id").agg(F.max(utc_clock(F.col("ts"))).alias("newest"))
        _replace(newest, f"{path}-marks")

    return write


def _replace(rows: DataFrame, path: str) -> None:
    """Rows of one batch in its own partition; a replay replaces them."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def _mark(spark: SparkSession, path: str, batch_id: int):
    """Newest event time of the batches before one; a row a batch is read."""
    if batch_id == 0:
        return None
    marks = spark.read.schema("newest TIMESTAMP_NTZ, batch_id BIGINT").parquet(path)
    return marks.filter(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]


def daily_sums(spark: SparkSession, path: str) -> DataFrame:
    """account_id, date, credits_consumed, log_count from what ``daily_with_late`` wrote."""
    stored = spark.read.schema(
        "account_id BIGINT, date DATE, credits DECIMAL(38,12), log_count BIGINT, batch_id BIGINT"
    ).parquet(path)
    return stored.groupBy("account_id", "date").agg(
        F.sum("credits").cast("double").alias("credits_consumed"), F.sum("log_count").alias("log_count")
    )


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """log_id, account_id, date, credits of the rows that came after their day was final."""
    return spark.read.schema(
        "log_id BIGINT, account_id BIGINT, date DATE, credits DOUBLE, batch_id BIGINT"
    ).parquet(path).drop("batch_id")


def dedup(stream: DataFrame, lateness: str = "2 days") -> DataFrame:
    """First occurrence of each log id within the watermark."""
    return stream.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["log_id"])


INDEX = "account_id BIGINT, _month INT, covered_days BIGINT"
Static = DataFrame | Callable[[], DataFrame]


def _now(side: Static) -> DataFrame:
    """A static side as it is now; a frame over files keeps the files it found when it was made, a function reads again."""
    return side() if callable(side) else side


def guard_version(accounts: DataFrame, contracts: DataFrame) -> str:
    """A checksum of what the guards look at; equal rows in any order give the same text."""

    def text(df: DataFrame) -> str:
        digest = F.sha2(F.to_json(F.struct(*df.columns)), 256)
        sums = [
            F.sum(F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)")
            for i in range(2)
        ]
        row = df.agg(F.concat_ws(".", F.count(F.lit(1)).cast("string"), *[s.cast("string") for s in sums])).first()
        return row[0]

    spans = contracts.select("account_id", "start_date", "end_date")
    return f"{text(accounts.select('account_id'))}-{text(spans)}"


def guard_index(
    accounts: DataFrame, contracts: DataFrame, path: str, version: str
) -> DataFrame:
    """Covered days per known account and month as a stored table; built when its version is not there yet.

    Rows of a version count once its note in ``commits`` is written.
    """
    spark = accounts.sparkSession
    commits = runs.table(spark, f"{path}/commits", "built BOOLEAN", "version STRING")
    if commits.filter(F.col("version") == version).isEmpty():
        grid = contract_months(
            contracts.select("contract_id", "account_id", "start_date", "end_date").withColumn(
                "included_monthly_compute_credits", F.lit(0).cast("long")
            ),
            accounts.select("account_id").distinct(),
        )
        rows = grid.filter(F.col("covered_days") != 0).select("account_id", "_month", "covered_days")
        files.write_table(rows, f"{path}/grid/version={version}")
        files.write_table(spark.createDataFrame([(True,)], "built BOOLEAN"), f"{path}/commits/version={version}")
    return spark.read.schema(INDEX).parquet(f"{path}/grid/version={version}")


def guarded(
    accounts: Static,
    contracts: Static,
    accepted_path: str,
    rejected_path: str,
    index_path: str | None = None,
    version: Callable[[], str] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer that routes rows by the account and contract guards.

    The contracts of known accounts are kept as days covered per account and
    month, stored under ``index_path`` (beside the accepted rows by default) once
    for each version of the static sides. A batch meets the stored table in one
    left join, which tags its rows, and the tag splits them. ``version`` names the
    state of the static sides, such as a table's version number; without it a
    checksum over both is computed each batch. Give the sides as functions where
    their files change while the stream runs.

    Both sinks are partitioned by batch and overwrite only that partition. A
    batch notes the version that split it before it writes, so a replay splits
    it the same way though contracts have changed since. Rows without an account
    or a time are rejected.
    """
    home = index_path or f"{accepted_path}-index"

    def index(spark: SparkSession, batch_id: int) -> DataFrame:
        notes = runs.table(spark, f"{home}/batches", "version STRING", "batch_id BIGINT")
        noted = notes.filter(F.col("batch_id") == batch_id).first()
        if noted:
            return spark.read.schema(INDEX).parquet(f"{home}/grid/version={noted['version']}")
        sides = _now(accounts), _now(contracts)
        name = version() if version else guard_version(*sides)
        found = guard_index(*sides, home, name)
        files.write_table(spark.createDataFrame([(name,)], "version STRING"), f"{home}/batches/batch_id={batch_id}")
        return found

    def write(batch: DataFrame, batch_id: int) -> None:
        day = utc_clock(F.col("ts")).cast("date")
        rows = batch.withColumn("date", day).withColumn("batch_id", F.lit(batch_id))
        tagged = (
            salted_join(
                rows.withColumn("_month", month_number(F.col("date"))),
                index(batch.sparkSession, batch_id),
                ["account_id", "_month"],
                "left",
                ["log_id", "ts"],
            )
            .withColumn("_ok", true_if(is_covered(F.col("date"), F.col("covered_days"))))
            .select(*rows.columns, "_ok")
            .persist()
        )
        for kept, path in ((F.col("_ok"), accepted_path), (~F.col("_ok"), rejected_path)):
            _replace(tagged.filter(kept).drop("_ok"), path)
        tagged.unpersist()

    return write


def inactivity(stream: DataFrame, quiet: str = "30 days", lateness: str = "1 hour") -> DataFrame:
    """One alert per account and quiet spell.

    A session that closes is an account that has been silent for its gap, so
    built-in session windows do the work and keep one open session per account.
    """
    gap = F.expr(f"interval {quiet}")
    return (
        stream.withWatermark("ts", lateness)
        .groupBy(F.session_window("ts", quiet).alias("w"), "account_id")
        .agg(F.count(F.lit(1)).alias("events_before"))
        .select(
            "account_id",
            utc_clock(F.col("w.end") - gap).alias("silent_since"),
            utc_clock(F.col("w.end")).alias("alerted_at"),
            "events_before",
        )
    )


def run_available(
    spark: SparkSession, stream: DataFrame, purpose: str, foreach: Callable | None = None, mode: str = "append"
) -> str:
    """Process everything available, then stop; returns the result folder."""
    root = work_dir(spark, purpose)
    writer = stream.writeStream.trigger(availableNow=True).option(
        "checkpointLocation", f"{root}/checkpoint"
    )
    if foreach is not None:
        writer = writer.foreachBatch(foreach).outputMode(mode)
    else:
        writer = writer.format("parquet").option("path", f"{root}/table").outputMode("append")
    query = writer.start()
    query.awaitTermination()
    return f"{root}/table"
