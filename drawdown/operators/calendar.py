"""Calendar and fiscal attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _fiscal(day: Column, start_month: int) -> tuple[Column, Column, Column]:
    month = F.month(day)
    year = F.year(day) + F.when(month >= start_month, 1).otherwise(0) if start_month > 1 else F.year(day)
    fiscal_month = F.pmod(month - start_month, F.lit(12)) + 1
    quarter = F.floor((fiscal_month - 1) / 3).cast("int") + 1
    return year, fiscal_month, quarter


def fiscal_quarter_label(day: Column, fy_start_month: int = 8) -> Column:
    year, _, quarter = _fiscal(day, fy_start_month)
    return F.concat(F.lit("FY"), year.cast("string"), F.lit("-Q"), quarter.cast("string"))


def calendar_columns(day: Column, fy_start_month: int = 8) -> dict[str, Column]:
    """The thirty attributes of the date dimension, as expressions on any date column.

    Weeks begin on Sunday and week 0 holds the days before the first Sunday.
    """
    year, quarter, month = F.year(day), F.quarter(day), F.month(day)
    dow = F.dayofweek(day)
    label = F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string"))
    month_start, month_end = F.trunc(day, "month"), F.last_day(day)
    quarter_start = F.trunc(day, "quarter")
    quarter_end = F.date_sub(F.add_months(quarter_start, 3), 1)
    fy, fm, fq = _fiscal(day, fy_start_month)
    return {
        "date_id": F.date_format(day, "yyyyMMdd").cast("long"),
        "year": year,
        "quarter": quarter,
        "year_quarter": label,
        "month": month,
        "month_name": F.date_format(day, "MMMM"),
        "month_short": F.date_format(day, "MMM"),
        "year_month": F.date_format(day, "yyyy-MM"),
        "week_of_year": F.floor((F.dayofyear(day) + 7 - dow) / 7).cast("int"),
        "day_of_year": F.dayofyear(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": dow,
        "day_name": F.date_format(day, "EEEE"),
        "day_short": F.date_format(day, "EEE"),
        "is_weekend": dow.isin(1, 7),
        "is_weekday": ~dow.isin(1, 7),
        "is_month_start": day == month_start,
        "is_month_end": day == month_end,
        "month_start_date": month_start,
        "month_end_date": month_end,
        "is_quarter_start": day == quarter_start,
        "is_quarter_end": day == quarter_end,
        "calendar_year": year,
        "calendar_quarter": quarter,
        "calendar_year_quarter": label,
        "fiscal_year": fy,
        "fiscal_year_name": F.concat(F.lit("FY"), fy.cast("string")),
        "fiscal_month": fm,
        "fiscal_quarter": fq,
        "fiscal_year_quarter": fiscal_quarter_label(day, fy_start_month),
    }


def with_calendar(df: DataFrame, day: str = "date", fy_start_month: int = 8) -> DataFrame:
    return df.withColumns(calendar_columns(F.col(day), fy_start_month))


def dim_dates(
    spark: SparkSession,
    first: str = "2000-01-01",
    last: str = "2030-12-31",
    fy_start_month: int = 8,
) -> DataFrame:
    """The full date dimension, one row per day."""
    span = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))
    days = spark.range(1).select(F.explode(span).alias("date"))
    return with_calendar(days, "date", fy_start_month)
