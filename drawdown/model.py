"""Logical tables and the fixed values of the metric."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values of the metric definition.
RATE_CAP = 2.0
OVERAGE_RATE = 1.2
TRAILING_MONTHS = 3
RAMP_DAYS = 90
RENEWAL_HORIZON_DAYS = 180
TIER_CUTS = (0.05, 0.40, 0.80, 1.20)
ATTAINMENT_TARGET = 0.85
ATTAINMENT_WATCH = 0.70
SHELFWARE_TARGET = 0.08
SHELFWARE_ALERT = 0.15
TIERS = ("Expansion", "Healthy", "At Risk", "Shelfware", "Inactive", "Ramping")
RISK_TIERS = ("At Risk", "Shelfware", "Inactive")
TIER_RISK = {
    "Inactive": 5,
    "Shelfware": 4,
    "At Risk": 3,
    "Ramping": 3,
    "Healthy": 2,
    "Expansion": 1,
}

# Dollars are summed as exact decimals and credits as whole ten-thousandths, so
# that results do not depend on the order in which partitions arrive.
UNITS_PER_CREDIT = 10000
AMOUNT = T.DecimalType(18, 2)
RATE = T.DecimalType(18, 12)


def _schema(spec: str) -> T.StructType:
    out = T.StructType()
    for part in spec.split(","):
        name, kind = part.split()
        required = kind.endswith("!")
        out.add(name, _TYPES[kind.rstrip("!")], nullable=not required)
    return out


_TYPES = {
    "key": T.LongType(),
    "str": T.StringType(),
    "date": T.DateType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "bool": T.BooleanType(),
    "ts": T.TimestampType(),
}

SALES_REPS = _schema(
    "employee_id key!, name str, region str, segment str, manager_id key, manager_name str"
)
ACCOUNTS = _schema("account_id key!, company_name str, industry str, employee_id key")
CONTRACTS = _schema(
    "contract_id key!, account_id key, owner_id key, start_date date, end_date date, "
    "annual_commit_dollars long, included_monthly_compute_credits long, "
    "contract_term_months int"
)
USAGE_LOGS = _schema(
    "log_id key!, account_id key, date date, compute_credits_consumed double"
)
OWNERSHIP = _schema(
    "account_id key, employee_id key, effective_from date, effective_to date"
)
AMENDMENTS = _schema(
    "amendment_id key, contract_id key, field_changed str, new_value str, "
    "effective_date date, created_at date"
)
ACCOUNT_FACT = _schema(
    "account_id key, employee_id key, signing_owner_id key, company_name str, "
    "industry str, primary_contract_id key, contract_start_date date, "
    "contract_end_date date, contract_term_months int, annual_commit_dollars long, "
    "included_monthly_compute_credits long, has_expansion bool, "
    "active_contract_count long, trailing_90d_avg_rate double, months_of_data long, "
    "max_monthly_rate double, overage_months long, zero_usage_months long, "
    "expansion_flag bool, is_spike_drop bool, low_data_flag bool, "
    "is_new_account bool, health_tier str, cacv double, expansion_signal_acv double, "
    "acv_at_risk double, as_of_date date, calculated_at ts"
)


@dataclass(frozen=True)
class Tables:
    """The four raw tables every job starts from."""

    reps: DataFrame
    accounts: DataFrame
    contracts: DataFrame
    logs: DataFrame
