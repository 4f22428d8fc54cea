"""Tables written run by run: a run's rows count once its commit is written.

A table of a store lies under ``<store>/<table>/run=N``. Runs are numbered from
1 without gaps, because a run that failed is written again under its number, so
"committed" is the same as "up to the last commit". One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, path: str, schema: str, keys: str = "run INT") -> DataFrame:
    """A table with ``keys`` as partition columns; empty before its first run."""
    whole = T.StructType.fromDDL(f"{schema}, {keys}")
    if not exists(spark, path):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a store has a folder; only its name is asked for."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def write(df: DataFrame, path: str, run: int, *parts: str) -> None:
    """A run's rows of one table; what a failed attempt at the same run left is replaced."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(f"{path}/run={run}")


def last_commit(spark: SparkSession, store: str, schema: str):
    """The row of the newest commit with its ``run``, or None."""
    return table(spark, f"{store}/commits", schema).orderBy(F.desc("run")).first()


def commit(spark: SparkSession, store: str, schema: str, row: tuple, run: int) -> None:
    write(spark.createDataFrame([row], schema), f"{store}/commits", run)
