"""A stored type-2 dimension, kept up to date by merging dated observations.

``merge`` takes rows (key, day, attributes): what was seen of a key on a day.
Digests of the attributes tell which observations change anything; only these
keys, and only the buckets that hold them, are written again. Equal observations
are dropped before any attribute of the stored rows is read.

Layout under the store, one folder a run: ``seen`` keeps every observation,
``current/bucket=B`` the open versions of the buckets that the run wrote,
``closed/bucket=B`` the versions that it closed, ``parts`` names the buckets it
wrote and whether their closed versions were written whole, and ``commits`` is
written last. A run that fails halfway leaves what was there.

Days may arrive out of order. Up to the latest day merged so far an observation
is late: its key is built again from all observations in ``seen``, and the
closed versions of its bucket are written whole. So any order of deliveries
gives the versions that one rebuild gives, surrogate keys included.

A surrogate key is the natural key times 65,536 plus the days from 1970-01-01 to
``valid_from``. It never changes, needs no counter shared by writers, and is
unique as there is one version per key and first day. Keys beyond 46 bits and
days outside 1970 to 2149 raise an error.

Defined results: rows without a key or a day are no observations; of several for
one key and day the greatest attributes count (nulls first); a null attribute is
a value like any other; further columns are ignored; no observations, no run.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from drawdown.operators.skew import salted_join
from drawdown.session import materialise
from drawdown.sources import runs

COMMITS = "last_day DATE, buckets INT, observations BIGINT, changes BIGINT"
PARTS = "bucket INT, whole BOOLEAN"
_DAYS = 1 << 16
_KEYS = 1 << 46


@dataclass(frozen=True)
class Dimension:
    """A dimension's folder, key, attributes with their types, and the reason a change of each stands for.

    ``buckets`` is fixed by the first merge: it sets how much one changed key
    makes a run write.
    """

    path: str
    key: str
    attributes: dict[str, str]
    reasons: dict[str, str] = field(default_factory=dict)
    buckets: int = 64

    @property
    def row(self) -> str:
        listed = ", ".join(f"{n} {kind}" for n, kind in self.attributes.items())
        return f"{self.key} BIGINT, {listed}"

    @property
    def version(self) -> str:
        return (
            f"surrogate_key BIGINT, {self.row}, valid_from DATE, valid_to DATE, "
            "change_reason STRING, dw_created_at TIMESTAMP, digest BINARY"
        )


def _digest(dim: Dimension) -> Column:
    """SHA-256 of the attributes; which of them are null is part of it."""
    return F.unhex(F.sha2(F.to_json(F.struct(*dim.attributes)), 256))


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _surrogate(dim: Dimension, day: str) -> Column:
    days = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    key = F.col(dim.key)
    fits = days.between(0, _DAYS - 1) & key.between(-_KEYS, _KEYS - 1)
    return F.when(fits, key * _DAYS + days).otherwise(
        F.raise_error(F.concat(F.lit("no surrogate key for "), key.cast("string"), F.lit(" on "), F.col(day).cast("string")))
    )


def _observed(dim: Dimension, observations: DataFrame, day: str) -> DataFrame:
    """One row per key and day, combined map-side however many there are."""
    typed = observations.select(
        F.col(dim.key).cast("bigint").alias(dim.key),
        F.col(day).cast("date").alias("day"),
        *[F.col(n).cast(kind).alias(n) for n, kind in dim.attributes.items()],
    ).filter(F.col(dim.key).isNotNull() & F.col("day").isNotNull())
    one = typed.groupBy(dim.key, "day").agg(F.max(F.struct(*dim.attributes)).alias("_best"))
    return one.select(dim.key, "day", "_best.*").withColumn("digest", _digest(dim))


def _state(spark: SparkSession, dim: Dimension):
    """The last commit, and per bucket the run with its open versions and the first one with its closed ones.

    At most ``buckets`` rows come to the driver.
    """
    last = runs.last_commit(spark, dim.path, COMMITS)
    if last is None:
        return None, {}, {}
    if last["buckets"] != dim.buckets:
        raise ValueError(f"{dim.path} has {last['buckets']} buckets, not {dim.buckets}")
    parts = runs.table(spark, f"{dim.path}/parts", PARTS).filter(F.col("run") <= last["run"])
    rows = parts.groupBy("bucket").agg(
        F.max("run").alias("newest"), F.coalesce(F.max(F.when(F.col("whole"), F.col("run"))), F.lit(1)).alias("base")
    ).collect()
    return last, {r["bucket"]: r["newest"] for r in rows}, {r["bucket"]: r["base"] for r in rows}


def _at(by_bucket: dict) -> Column:
    """A bucket's run; only partition columns are asked, so other folders are not listed for the scan."""
    pairs = [F.lit(x) for pair in sorted(by_bucket.items()) for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.col("bucket")) if pairs else F.lit(None).cast("int")


def _open(spark: SparkSession, dim: Dimension, newest: dict) -> DataFrame:
    rows = runs.table(spark, f"{dim.path}/current", dim.version, "run INT, bucket INT")
    return rows.filter(F.col("run") == _at(newest)).drop("run")


def _closed(spark: SparkSession, dim: Dimension, base: dict, upto: int) -> DataFrame:
    rows = runs.table(spark, f"{dim.path}/closed", dim.version, "run INT, bucket INT")
    return rows.filter((F.col("run") >= _at(base)) & (F.col("run") <= upto)).drop("run")


def _versions(dim: Dimension, points: DataFrame, run_ts: datetime | None) -> DataFrame:
    """Versions from observations unique per (key, day); rows that were a version before bring its ``created``.

    A key's window is bounded by the calendar.
    """
    order = W.partitionBy(dim.key).orderBy("day")
    before = F.lag(F.struct("digest", *dim.attributes)).over(order)
    changed = points.withColumn("_before", before).filter(
        F.col("_before").isNull() | (F.col("_before.digest") != F.col("digest"))
    )
    reason = F.coalesce(
        *[
            F.when(F.col("_before").isNotNull() & ~F.col(f"_before.{n}").eqNullSafe(F.col(n)), F.lit(why))
            for n, why in dim.reasons.items()
        ],
        F.lit(None).cast("string"),
    )
    # An open version that heads the list keeps the reason it was opened for.
    kept = F.col("_before").isNull() & F.col("created").isNotNull()
    return changed.select(
        _surrogate(dim, "day").alias("surrogate_key"),
        dim.key,
        *dim.attributes,
        F.col("day").alias("valid_from"),
        F.date_sub(F.lead("day").over(order), 1).alias("valid_to"),
        F.when(kept, F.col("reason")).otherwise(reason).alias("change_reason"),
        F.coalesce("created", F.lit(run_ts).cast("timestamp")).alias("dw_created_at"),
        "digest",
        _bucket(F.col(dim.key), dim.buckets).alias("bucket"),
    )


def _fresh(points: DataFrame) -> DataFrame:
    return points.withColumns(
        {"created": F.lit(None).cast("timestamp"), "reason": F.lit(None).cast("string")}
    )


def merge(dim: Dimension, observations: DataFrame, day: str, run_ts: datetime | None = None) -> int | None:
    """Merge observations into the stored dimension; the run's number, or None if there were none."""
    spark = observations.sparkSession
    last, newest, base = _state(spark, dim)
    run = last["run"] + 1 if last else 1
    seen = f"{dim.path}/seen"
    seen_row = f"{dim.row}, day DATE, digest BINARY"
    there = [c.split()[0] for c in seen_row.split(", ")]
    batch = _observed(dim, observations, day).withColumn("bucket", _bucket(F.col(dim.key), dim.buckets))
    runs.write(batch.select(*there, "bucket"), seen, run, "bucket")
    stored = runs.table(spark, seen, seen_row, "run INT, bucket INT")
    rows = stored.filter(F.col("run") == run).drop("run")
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.max("day").alias("last")).first()
    if not total["n"]:
        return None
    mark = last["last_day"] if last else None
    is_late = F.lit(False) if mark is None else F.col("day") <= F.lit(mark)
    late = rows.filter(is_late).select(dim.key, "bucket").distinct()
    opened = _open(spark, dim, newest)

    # In order: keys with an observation that differs from the open version. Digests alone are compared.
    known = opened.select(dim.key, F.col("digest").alias("_open"))
    differs = F.col("_open").isNull() | (F.col("_open") != F.col("digest"))
    changed = rows.select(dim.key, "digest", "bucket").join(known, dim.key, "left").filter(differs)
    touched = materialise(
        changed.select(dim.key, "bucket", F.lit(False).alias("late"))
        .unionByName(late.withColumn("late", F.lit(True)))
        .groupBy(dim.key, "bucket")
        .agg(F.max("late").alias("late")),
        "dimension-keys",
    )
    parts = touched.groupBy("bucket").agg(F.max("late").alias("whole"), F.count(F.lit(1)).alias("n")).collect()
    written = [r["bucket"] for r in parts]
    whole = [r["bucket"] for r in parts if r["whole"]]
    if written:
        here = F.col("bucket").isin(written)
        ordinary, again = touched.filter(~F.col("late")), touched.filter(F.col("late"))
        heads = opened.filter(here).select(
            dim.key, *dim.attributes, F.col("valid_from").alias("day"), "digest",
            F.col("dw_created_at").alias("created"), F.col("change_reason").alias("reason"),
        )
        news = _fresh(rows.filter(here).drop("bucket"))
        # The rows of a key meet once: the windows keep the order of this join.
        points = heads.unionByName(news).join(ordinary.select(dim.key), dim.key, "left_semi")
        made = _versions(dim, points, run_ts)
        rest = opened.filter(here).join(touched.select(dim.key), dim.key, "left_anti")
        if whole:
            made = made.unionByName(_rebuilt(dim, stored, opened, base, whole, again, run, run_ts))
        made = materialise(made, "dimension-versions")
        names = [c.split()[0] for c in dim.version.split(", ")]
        current = made.filter(F.col("valid_to").isNull()).unionByName(rest)
        runs.write(current.select(*names, "bucket"), f"{dim.path}/current", run, "bucket")
        closed = made.filter(F.col("valid_to").isNotNull())
        if whole:
            old = _closed(spark, dim, base, run - 1).filter(F.col("bucket").isin(whole))
            closed = closed.unionByName(old.join(again.select(dim.key), dim.key, "left_anti"))
        runs.write(closed.select(*names, "bucket"), f"{dim.path}/closed", run, "bucket")
        listed = [(r["bucket"], r["whole"]) for r in parts]
        runs.write(spark.createDataFrame(listed, PARTS), f"{dim.path}/parts", run)
    done = (max(total["last"], mark) if mark else total["last"], dim.buckets, total["n"], sum(r["n"] for r in parts))
    runs.commit(spark, dim.path, COMMITS, done, run)
    return run


def _rebuilt(
    dim: Dimension, stored: DataFrame, opened: DataFrame, base: dict, whole: list[int], again: DataFrame,
    run: int, run_ts: datetime | None,
) -> DataFrame:
    """Versions of keys with late observations, from everything seen of them; versions that stay keep their time."""
    spark = stored.sparkSession
    mine = F.col("bucket").isin(whole)
    history = stored.filter(mine & (F.col("run") <= run)).join(again.select(dim.key), dim.key, "left_semi")
    # A later delivery of a day replaces an earlier one.
    newest = history.groupBy(dim.key, "day").agg(
        F.max_by(F.struct(*dim.attributes, "digest"), "run").alias("_row")
    )
    points = _fresh(newest.select(dim.key, "day", "_row.*"))
    before = opened.filter(mine).unionByName(_closed(spark, dim, base, run - 1).filter(mine))
    kept = before.join(again.select(dim.key), dim.key, "left_semi").select(
        "surrogate_key", F.col("digest").alias("_digest"), F.col("dw_created_at").alias("_created")
    )
    built = _versions(dim, points, run_ts)
    same = (F.col("digest") == F.col("_digest")) & F.col("_created").isNotNull()
    return (
        built.join(kept, "surrogate_key", "left")
        .withColumn("dw_created_at", F.when(same, F.col("_created")).otherwise(F.col("dw_created_at")))
        .select(*built.columns)
    )


def _shown(dim: Dimension, rows: DataFrame) -> DataFrame:
    return rows.select(
        "surrogate_key", dim.key, *dim.attributes, "valid_from", "valid_to",
        F.col("valid_to").isNull().alias("is_current"), "change_reason", "dw_created_at",
    )


def read(spark: SparkSession, dim: Dimension) -> DataFrame:
    """Every version as of the last committed run."""
    last, newest, base = _state(spark, dim)
    upto = last["run"] if last else 0
    return _shown(dim, _open(spark, dim, newest).unionByName(_closed(spark, dim, base, upto)))


def read_current(spark: SparkSession, dim: Dimension) -> DataFrame:
    """Open versions only; closed ones are not opened."""
    return _shown(dim, _open(spark, dim, _state(spark, dim)[1]))


def bind(fact: DataFrame, spark: SparkSession, dim: Dimension, key: str, day: str, name: str, spread: list[str]) -> DataFrame:
    """The fact with the surrogate key of the version that held on its day (null where none did).

    A key that owns a third of the fact is split by ``spread``, columns that
    differ between its rows.
    """
    versions = read(spark, dim).select(
        F.col(dim.key).alias("_dim_key"), F.col("surrogate_key").alias(name),
        F.col("valid_from").alias("_dim_from"), F.col("valid_to").alias("_dim_to"),
    )
    days = (F.col(day) >= F.col("_dim_from")) & (F.col("_dim_to").isNull() | (F.col(day) <= F.col("_dim_to")))
    tagged = fact.withColumn("_dim_key", F.col(key))
    return salted_join(tagged, versions, ["_dim_key"], "left", spread=spread, residual=days).select(*fact.columns, name)
