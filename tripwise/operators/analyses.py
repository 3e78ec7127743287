"""Questions answered on the driver-day table.

Each function is ``DataFrame -> small DataFrame``; results are aggregates of a
few hundred rows at most, handed to the caller (who may ``toPandas()`` them
for charts).  Means are exact decimal ratios rounded half-up (see
``functions.ratios``), so results do not depend on partitioning or summation
order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, EngagementConfig
from ..functions.ratios import half_up_ratio, money_ratio


def _sum(c: str, alias: str | None = None, dtype: str = "bigint") -> Column:
    return F.sum(c).cast(dtype).alias(alias or c)


def _mean(c: Column, scale: int, times: int = 1) -> Column:
    """avg(c) (NULLs skipped) as an exact half-up decimal."""
    return half_up_ratio(F.sum(c), F.count(c), scale, times)


# --------------------------------------------------------------------------- N1 / N2
def driver_kpi_summary(agg: DataFrame, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    """Per driver over days with offers: totals, percentage rates, revenue per trip.

    Zero denominators give NULL here (not 0 as in the daily table).
    """
    s = F.sum
    rev_times = 100 if cfg.literal_revenue_pct else 1
    return (agg.filter(F.col("total_offers") != 0)
            .groupBy("driver_id")
            .agg(_sum("total_offers"), _sum("offers_accepted"), _sum("offers_cancelled"),
                 _sum("total_est_revenue", dtype="decimal(38,2)"), _sum("total_bookings"),
                 _sum("completed_trips"), _sum("driver_abort_count"),
                 half_up_ratio(s("offers_accepted"), s("total_offers"), 2, 100).alias("offer_acceptance_rate"),
                 half_up_ratio(s("completed_trips"), s("total_bookings"), 2, 100).alias("booking_completion_rate"),
                 half_up_ratio(s("driver_abort_count"), s("total_bookings"), 2, 100).alias("driver_abort_rate"),
                 (money_ratio(s("total_est_revenue").cast("decimal(38,2)"), s("completed_trips"), 2) if rev_times == 1
                  else half_up_ratio(s("total_est_revenue"), s("completed_trips"), 2, rev_times))
                 .alias("avg_est_revenue_per_trip")))


def driver_kpi_projection(summary: DataFrame) -> DataFrame:
    return summary.select("driver_id", "total_offers", "offer_acceptance_rate", "booking_completion_rate",
                          "driver_abort_rate")


# --------------------------------------------------------------------------- N3
def weekend_vs_weekday(agg: DataFrame, cal: DataFrame) -> DataFrame:
    """Totals and unrounded (6-digit) rates per day type; calendar joined on the day key.

    The driver-day rows are first summed per day (at most one row per
    calendar day), so the calendar join and the final grouping see a handful
    of rows instead of drivers x days.
    """
    s = F.sum
    per_day = agg.groupBy("activity_date_key").agg(
        _sum("total_offers"), _sum("offers_accepted"), _sum("total_bookings"), _sum("completed_trips"),
        _sum("driver_abort_count"), _sum("total_est_revenue", dtype="decimal(38,2)"))
    days = F.broadcast(cal.select(F.col("date_key").alias("activity_date_key"), "weekend_flag"))
    return (per_day.join(days, "activity_date_key")
            .groupBy(F.when(F.col("weekend_flag") == 1, "Weekend").otherwise("Weekday").alias("day_type"))
            .agg(_sum("total_offers"), _sum("offers_accepted"), _sum("total_bookings"), _sum("completed_trips"),
                 _sum("driver_abort_count"), _sum("total_est_revenue", "total_revenue", "decimal(38,2)"),
                 half_up_ratio(s("offers_accepted"), s("total_offers"), 6).alias("offer_acceptance_rate"),
                 half_up_ratio(s("driver_abort_count"), s("total_bookings"), 6).alias("driver_abort_rate"),
                 half_up_ratio(s("completed_trips"), s("total_bookings"), 6).alias("completion_rate")))


# --------------------------------------------------------------------------- N4
def driver_tenure_engagement(agg: DataFrame, dim_active: DataFrame) -> DataFrame:
    """Per (driver_type, driver): totals and unrounded rates; drivers unknown to the dimension get NULL type.

    Summed per driver before the dimension lookup: the active view holds one
    row per driver, so the label is a function of the driver and the join
    runs on one row per driver instead of one per driver-day.
    """
    per_driver = agg.groupBy("driver_id").agg(
        _sum("total_offers"), _sum("offers_accepted"), _sum("offers_cancelled"), _sum("offers_read"),
        _sum("total_route_distance", dtype="decimal(38,0)"), _sum("total_bookings"),
        _sum("completed_trips"), _sum("total_est_revenue", dtype="decimal(38,2)"), _sum("driver_abort_count"))
    d = dim_active.select("driver_id", "driver_type").dropDuplicates(["driver_id"])
    c = F.col
    return per_driver.join(d, "driver_id", "left").select(
        "driver_type", "driver_id", "total_offers", "offers_accepted", "offers_cancelled", "offers_read",
        "total_route_distance", "total_bookings", "completed_trips", "total_est_revenue", "driver_abort_count",
        half_up_ratio(c("offers_accepted"), c("total_offers"), 6).alias("offer_acceptance_rate"),
        half_up_ratio(c("completed_trips"), c("total_bookings"), 6).alias("booking_completion_rate"),
        half_up_ratio(c("driver_abort_count"), c("total_bookings"), 6).alias("driver_abort_rate"),
        money_ratio(c("total_est_revenue"), c("completed_trips"), 6).alias("avg_est_revenue_per_trip"))


# --------------------------------------------------------------------------- N5 / N6
HIST_KPIS = (("acceptance_rate_pct", "offer_acceptance_rate"),
             ("completion_rate_pct", "booking_completion_rate"),
             ("abort_rate_pct", "driver_abort_rate"))


def _kpi_long(summary: DataFrame) -> DataFrame:
    """(driver_id, kpi, value) -- one row per driver and KPI, NULL values dropped."""
    cols = [F.struct(F.lit(name).alias("kpi"), F.col(src).alias("value")) for name, src in HIST_KPIS]
    return (summary.select("driver_id", F.explode(F.array(*cols)).alias("kv"))
            .select("driver_id", "kv.kpi", "kv.value").filter(F.col("value").isNotNull()))


def kpi_histogram(summary: DataFrame, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    """Equal-width bins between each KPI's min and max (last bin closed), all bins listed, with the KPI's mean.

    Driver counts per bin are a grouped count (partial aggregation, no data to
    the driver); min/max are a 3-row aggregate broadcast back.  When all values
    are equal there is a single bin.
    """
    bins = cfg.histogram_bins
    long = _kpi_long(summary)
    stats = long.groupBy("kpi").agg(F.min("value").alias("kpi_min"), F.max("value").alias("kpi_max"),
                                    _mean(F.col("value"), 2).alias("kpi_mean"))
    width = F.col("kpi_max") - F.col("kpi_min")
    pos = F.floor((F.col("value") - F.col("kpi_min")) * bins / F.nullif(width, F.lit(0))).cast("int") + 1
    counted = (long.join(F.broadcast(stats), "kpi")
               .withColumn("bin", F.when(width == 0, 1).otherwise(F.least(pos, F.lit(bins))))
               .groupBy("kpi", "bin").agg(F.count(F.lit(1)).alias("driver_count")))
    all_bins = stats.select("kpi", "kpi_min", "kpi_max", "kpi_mean", F.explode(F.sequence(
        F.lit(1), F.when(width == 0, 1).otherwise(bins))).alias("bin"))
    return (all_bins.join(counted, ["kpi", "bin"], "left")
            .select("kpi", "bin", "kpi_min", "kpi_max", "kpi_mean",
                    F.coalesce(F.col("driver_count"), F.lit(0)).cast("bigint").alias("driver_count"))
            .orderBy("kpi", "bin"))


def kpi_overview(summary: DataFrame) -> DataFrame:
    return summary.agg(F.count(F.lit(1)).alias("total_drivers"),
                       _mean(F.col("offer_acceptance_rate"), 2).alias("avg_acceptance_rate_pct"),
                       _mean(F.col("booking_completion_rate"), 2).alias("avg_completion_rate_pct"),
                       _mean(F.col("driver_abort_rate"), 2).alias("avg_abort_rate_pct"))


# --------------------------------------------------------------------------- N7 / N8
def driver_segments(agg: DataFrame, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    """Per driver over days with bookings: abort segment and mean daily rates (6 digits)."""
    r = F.col("driver_abort_rate")
    high = F.sum(r) * 100 >= F.count(r) * cfg.abort_threshold_pct  # avg(rate)*100 >= threshold, exactly
    return (agg.filter(F.col("total_bookings") > 0)
            .groupBy("driver_id")
            .agg(F.when(high, "High Abort").otherwise("Reliable").alias("segment"),
                 _mean(F.col("booking_completion_rate"), 6, 100).alias("avg_completion_rate"),
                 _mean(F.col("avg_est_revenue_per_trip"), 6).alias("avg_est_revenue_per_trip"),
                 _sum("driver_abort_count", "total_aborts")))


def abort_segments(agg: DataFrame, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    # one row per driver below, so COUNT(DISTINCT driver_id) is a plain count (no distinct expand)
    return (driver_segments(agg, cfg).groupBy("segment")
            .agg(F.count("driver_id").alias("driver_count"),
                 _mean(F.col("avg_completion_rate"), 1).alias("avg_completion_rate"),
                 _mean(F.col("avg_est_revenue_per_trip"), 2).alias("avg_est_revenue_per_trip"),
                 _sum("total_aborts"))
            .orderBy("segment"))


def segment_dim_coverage(agg: DataFrame, dim_active: DataFrame, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    d = dim_active.select(F.col("driver_id").alias("d_driver_id"), "driver_rating")
    seg = driver_segments(agg, cfg)
    return (seg.join(d, seg["driver_id"] == d["d_driver_id"], "left")
            .groupBy("segment")
            .agg(F.count("driver_id").alias("global_driver_count"),
                 F.count("d_driver_id").alias("dim_driver_count"),
                 _mean(F.col("driver_rating"), 6).alias("avg_driver_rating")))


# --------------------------------------------------------------------------- N9 / N10 / F10
def _trend_aggs(prefix: str = "", revenue_name: str = "avg_est_revenue_per_trip") -> list[Column]:
    return [_mean(F.col("driver_abort_rate"), 1, 100).alias(prefix + "avg_abort_rate"),
            _mean(F.col("booking_completion_rate"), 1, 100).alias(prefix + "avg_completion_rate"),
            _mean(F.col("avg_est_revenue_per_trip"), 2).alias(prefix + revenue_name)]


def country_trend(agg: DataFrame, dim_active: DataFrame) -> DataFrame:
    d = dim_active.select("driver_id", "country_name")
    return (agg.filter(F.col("total_bookings") > 0).join(d, "driver_id", "left")
            .groupBy("activity_date", "country_name").agg(*_trend_aggs())
            .orderBy("activity_date"))


def country_trend_pivot(agg: DataFrame, dim_active: DataFrame, countries=("France", "Austria")) -> DataFrame:
    """One row per day with bookings, one column block per listed country."""
    d = dim_active.select("driver_id", "country_name")
    return (agg.filter(F.col("total_bookings") > 0).join(d, "driver_id", "left")
            .groupBy("activity_date").pivot("country_name", list(countries)).agg(*_trend_aggs())
            .orderBy("activity_date"))


def daily_trend(agg: DataFrame) -> DataFrame:
    return (agg.filter(F.col("total_bookings") > 0)
            .groupBy("activity_date").agg(*_trend_aggs(revenue_name="avg_revenue_per_trip"))
            .orderBy("activity_date"))
