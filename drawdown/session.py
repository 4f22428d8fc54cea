"""Session settings the jobs rely on, and the shared work folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Left alone on a cluster unless the caller asks for them: adaptive execution
# sizes partitions, splits skewed joins and turns measured-small sides into
# broadcasts, so no operator forces a broadcast itself.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cpus: int | str = 8, partitions: int = 8) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("drawdown")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        # Tables of a few MB grow many times over when intervals are spread over
        # days and months, so a single machine keeps its partitions small.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which keyed state with timers needs."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    Only where that is unset (a test or a single machine) is a folder under
    the session's warehouse used instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir() if _has_dir(spark) else None
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def _has_dir(spark: SparkSession) -> bool:
    return bool(spark.sparkContext.getCheckpointDir())


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate once to shared storage and read it back.

    Cuts lineage in a way that survives the loss of executors.
    """
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
