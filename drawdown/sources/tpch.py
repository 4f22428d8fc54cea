"""The logical tables expressed over the star-schema Parquet tables.

FIXTURES.md lists the rules. Rows are only relabelled, never dropped: whole
tables go in. Irregular rows (unknown accounts, malformed contracts, zero
allowances, unknown reps) come from rules on the keys so that each check has
something to find.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drawdown.model import Tables

AS_OF = date(2000, 6, 30)

_NTZ = T.TimestampNTZType()
_RAW = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_RAW[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_schema(name: str) -> str:
    return _RAW[name]


def _rep_count(spark: SparkSession, sf_dir: str) -> Column:
    return raw(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()


def sales_reps(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation, region = (raw(spark, sf_dir, n) for n in ("supplier", "nation", "region"))
    segment = (
        F.when(F.col("s_suppkey") % 3 == 0, "Enterprise")
        .when(F.col("s_suppkey") % 3 == 1, "Mid-Market")
        .otherwise("Public Sector")
    )
    return (
        # Nations and regions are fixed lists of 25 and 5 rows at every scale.
        supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("employee_id"),
            F.col("s_name").alias("name"),
            F.col("r_name").alias("region"),
            segment.alias("segment"),
            F.col("n_nationkey").cast("long").alias("manager_id"),
            F.col("n_name").alias("manager_name"),
        )
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    reps, key = _rep_count(spark, sf_dir), F.col("c_custkey")
    return raw(spark, sf_dir, "customer").select(
        key.alias("account_id"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("industry"),
        F.when(key % 211 == 0, reps + key).otherwise(key % reps).alias("employee_id"),
    )


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, account = F.col("o_orderkey"), F.col("o_custkey")
    start = F.col("o_orderdate").cast("date")
    term = (
        F.when(F.col("o_orderkey") % 89 == 0, 8)
        .when(F.col("o_orderkey") % 83 == 0, 18)
        .when(F.col("o_orderpriority") == "5-LOW", 36)
        .when(F.col("o_orderpriority") == "2-HIGH", 24)
        .otherwise(12)
    )
    end = F.when(key % 97 == 0, F.date_sub(start, 1)).otherwise(
        F.date_sub(F.add_months(start, term), 1)
    )
    return raw(spark, sf_dir, "orders").select(
        key.alias("contract_id"),
        F.when(key % 499 == 0, -1 - account).otherwise(account).alias("account_id"),
        ((account + key) % _rep_count(spark, sf_dir)).alias("owner_id"),
        start.alias("start_date"),
        end.alias("end_date"),
        F.floor("o_totalprice").alias("annual_commit_dollars"),
        F.when(key % 53 == 0, 0).otherwise(1 + key % 8).cast("long").alias(
            "included_monthly_compute_credits"
        ),
        term.alias("contract_term_months"),
    )


def usage_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as usage; the order key is unique on the orders side.

    A hot order is left to adaptive skew handling: nothing above the join relies
    on its partitioning, so its partition may be split freely.
    """
    owner = raw(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    account, order = F.col("o_custkey"), F.col("l_orderkey")
    unknown = (account % 10 == 3) | (order % 200 == 0)
    return raw(spark, sf_dir, "lineitem").join(owner, order == F.col("o_orderkey")).select(
        (order * 10 + F.col("l_linenumber")).alias("log_id"),
        F.when(unknown, -1 - account).otherwise(account).alias("account_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_quantity").alias("compute_credits_consumed"),
    )


def load(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(
        reps=sales_reps(spark, sf_dir),
        accounts=accounts(spark, sf_dir),
        contracts=contracts(spark, sf_dir),
        logs=usage_logs(spark, sf_dir),
    )


def amendments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item amends one field of its order's contract on the ship date."""
    line = F.col("l_linenumber") % 3
    shipped = F.col("l_shipdate").cast("date")
    field = (
        F.when(line == 1, "annual_commit_dollars")
        .when(line == 2, "end_date")
        .otherwise("included_monthly_compute_credits")
    )
    value = (
        F.when(line == 1, F.floor("l_extendedprice").cast("string"))
        .when(line == 2, F.date_add(shipped, 365).cast("string"))
        .otherwise(F.floor("l_quantity").cast("string"))
    )
    return raw(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("amendment_id"),
        F.col("l_orderkey").alias("contract_id"),
        field.alias("field_changed"),
        value.alias("new_value"),
        shipped.alias("effective_date"),
        shipped.alias("created_at"),
    )


def rep_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly observations of each signing rep's segment, from the commit signed."""
    signed = contracts(spark, sf_dir).groupBy(
        F.col("owner_id").alias("employee_id"),
        F.trunc("start_date", "quarter").alias("observed_on"),
    ).agg(F.sum("annual_commit_dollars").alias("signed"))
    segment = (
        F.when(F.col("signed") >= 1500000, "Enterprise")
        .when(F.col("signed") >= 500000, "Mid-Market")
        .otherwise("Public Sector")
    )
    return signed.select("employee_id", "observed_on", segment.alias("segment"))
