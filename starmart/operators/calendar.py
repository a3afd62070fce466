"""Generated calendar and clock dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.functions.time import date_key
from starmart.tables import CALENDAR_FIRST, CALENDAR_LAST


def describe_days(days: DataFrame, day: str = "full_date") -> DataFrame:
    """The calendar attributes of a column of dates; weeks and weekdays follow ISO 8601."""
    d = F.col(day)
    iso_day = F.weekday(d) + 1
    return days.select(
        date_key(day).alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("smallint").alias("year"),
        F.quarter(d).cast("smallint").alias("quarter"),
        F.month(d).cast("smallint").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).cast("smallint").alias("week_of_year"),
        F.dayofmonth(d).cast("smallint").alias("day_of_month"),
        iso_day.cast("smallint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        iso_day.isin(6, 7).alias("is_weekend"),
    )


def calendar(spark: SparkSession, first: str = CALENDAR_FIRST, last: str = CALENDAR_LAST) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included."""
    span = spark.range(1).select(
        F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date")).alias("days")
    )
    return describe_days(span.select(F.explode("days").alias("full_date")))


def calendar_with(spark: SparkSession, days: DataFrame) -> DataFrame:
    """The standard calendar and the dates in ``days`` (one column), each day once."""
    named = days.toDF("full_date").filter("full_date is not null").distinct()
    standard = calendar(spark)
    return standard.unionByName(insert_if_absent(standard, describe_days(named), "date_key"))


def calendar_for(df: DataFrame, day: Column) -> DataFrame:
    """One row per day from the first to the last date found in ``df``."""
    span = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    days = span.select(F.explode(F.sequence(F.col("lo"), F.col("hi"))).alias("full_date"))
    return describe_days(days)


def clock(spark: SparkSession) -> DataFrame:
    """One row per second of the day; the key is HHMMSS as int."""
    second = F.col("id").cast("int")
    hour = F.floor(second / 3600).cast("int")
    minute = F.floor(second / 60).cast("int") % 60
    return spark.range(24 * 60 * 60).select(
        (hour * 10000 + minute * 100 + second % 60).alias("time_key"),
        F.concat_ws(
            ":", *(F.lpad(x.cast("string"), 2, "0") for x in (hour, minute, second % 60))
        ).alias("full_time"),
        hour.cast("smallint").alias("hour"),
        minute.cast("smallint").alias("minute"),
        (second % 60).cast("smallint").alias("second"),
    )


def insert_if_absent(existing: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key does not exist yet."""
    return rows.join(existing.select(key), key, "left_anti")
