"""Calendar dimension (dim_date)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, EngagementConfig


def date_key_of(d: Column) -> Column:
    """yyyymmdd integer key; NULL date -> NULL key."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def dim_date(spark: SparkSession, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    """One row per day from ``calendar_start`` for ``calendar_days`` days, gap-free.

    Generated from a range of day offsets (one row per day, bounded by the
    configured length), so it is small and safe to broadcast wherever it is
    joined.
    """
    start = F.to_date(F.lit(cfg.calendar_start))
    days = spark.range(0, cfg.calendar_days, 1, 1).select(F.date_add(start, F.col("id").cast("int")).alias("d"))
    dow = F.dayofweek("d") - 1  # 0 = Sunday ... 6 = Saturday
    if cfg.literal_calendar_tenure:  # keeps only days in 2020-2030
        days = days.filter(F.col("d").between(F.to_date(F.lit("2020-01-01")), F.to_date(F.lit("2030-12-31"))))
    return (days.select(
                F.col("d").alias("date"),
                date_key_of(F.col("d")).alias("date_key"),
                F.year("d").alias("year"),
                F.month("d").alias("month"),
                F.date_format("d", "MMMM").alias("month_name"),
                F.dayofmonth("d").alias("day_of_month"),
                dow.cast("int").alias("day_of_week_num"),
                F.date_format("d", "E").alias("day_name"),
                F.when(dow.isin(0, 6), 1).otherwise(0).alias("weekend_flag"),
                F.quarter("d").alias("quarter"),
                F.concat(F.date_format("d", "yyyy"), F.lit("-Q"), F.quarter("d").cast("string")).alias("year_quarter"),
            ))  # generated in date order from a single-partition range


def key_lookup(cal: DataFrame) -> DataFrame:
    """date -> date_key pairs of the calendar, for broadcast lookups."""
    return cal.select(F.col("date").alias("_cal_date"), F.col("date_key").alias("_cal_key"))


def with_date_key(df: DataFrame, date_col: str, key_name: str, cal: DataFrame | None) -> DataFrame:
    """Calendar key of a wall-clock date.

    Without ``cal`` the key follows from the date by arithmetic: the calendar
    covers every date that can be valid.  With a calendar (the literal one of 30
    days) it is a left join, and dates outside get a NULL key; the calendar is
    bounded by ``calendar_days`` rows, so the broadcast is safe.
    """
    if cal is None:
        return df.withColumn(key_name, date_key_of(F.col(date_col)))
    return (df.join(F.broadcast(key_lookup(cal)), F.col(date_col) == F.col("_cal_date"), "left")
            .withColumnRenamed("_cal_key", key_name).drop("_cal_date"))
