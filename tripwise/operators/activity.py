"""Dense driver x day activity table (A1-A7) and its building blocks.

The population (A1) is every driver registered by the window end plus every
driver with an offer or booking in the window; the table has one row per
population driver and window day, zeros on idle days.  ``offers_daily`` /
``bookings_daily`` / ``driver_date_spine`` are the original's building blocks
as stand-alone results; ``agg_driver_activity`` computes the same table
without materialising the spine in a shuffle (see its docstring).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, EngagementConfig
from ..functions.ratios import count_ratio, money_ratio

# Stored types of the driver-day table: as wide as the staged fares, so no valid sum overflows.
MONEY, DISTANCE, RATE = "decimal(38,2)", "decimal(38,0)", "decimal(38,2)"


def offers_in_window(fact_offers: DataFrame, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    return fact_offers.filter(F.col("offer_created_date_key").between(cfg.window_start_key, cfg.window_end_key))


def bookings_in_window(fact_bookings: DataFrame, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    return fact_bookings.filter(
        F.col("booking_request_date_key").between(cfg.window_start_key, cfg.window_end_key))


def registered_by_window_end(dim_active: DataFrame, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    if cfg.literal_calendar_tenure:
        return dim_active.filter(F.col("registration_date_key") <= cfg.window_end_key)
    return dim_active.filter(F.col("registration_local_date") <= F.to_date(F.lit(cfg.window_end)))


def active_driver_population(dim_active: DataFrame, fact_offers: DataFrame, fact_bookings: DataFrame,
                             cfg: EngagementConfig = DEFAULT) -> DataFrame:
    """Union of the three id sources, NULL ids removed, de-duplicated."""
    ids = (registered_by_window_end(dim_active, cfg).select("driver_id")
           .unionByName(offers_in_window(fact_offers, cfg).select("driver_id"))
           .unionByName(bookings_in_window(fact_bookings, cfg).select("driver_id")))
    return ids.filter(F.col("driver_id").isNotNull()).distinct()


def driver_date_spine(population: DataFrame, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    """Every population driver x every window day.

    The window's calendar days are a bounded list known from the config
    (at most ``calendar_days`` keys), so each driver row is expanded in place
    (explode of a literal array): no join and no exchange for the product.
    """
    keys = F.array(*[F.lit(k) for k in cfg.window_day_keys()]).cast("array<int>")
    return population.select("driver_id", F.explode(keys).alias("activity_date_key"))


# Measures of one offer and of one booking (G1, G2), by name in the daily table: what one row adds to its day's sum.
OFFER_MEASURES = {
    "missing_driver_offers_records": lambda: _i(F.col("is_missing_driver") == 1),
    "total_offers": lambda: _i(F.col("offer_id").isNotNull()),
    "offers_accepted": lambda: _i(F.col("offer_state") == "ACCEPTED"),
    "offers_cancelled": lambda: _i(F.col("offer_state") == "CANCELED"),
    "offers_read": lambda: _i(F.col("driver_read")),
}
BOOKING_MEASURES = {
    "missing_driver_bookings_records": lambda: _i(F.col("is_missing_driver") == 1),
    "total_bookings": lambda: _i(F.col("booking_id").isNotNull()),
    "completed_trips": lambda: _i(F.col("booking_status") == "SUCCESS"),
    "driver_abort_count": lambda: _i(F.col("booking_status") == "DRIVER_ABORT"),
    "no_driver_found_count": lambda: _i(F.col("booking_status") == "NO_DRIVER_FOUND"),
}


def _fare() -> Column:
    # NULL fares of trips stay NULL, so a day without any known fare has no revenue per trip
    return F.when(F.col("booking_status") == "SUCCESS", F.col("estimated_route_fare")).otherwise(F.lit(0)).cast(MONEY)


def _i(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("int").cast("bigint")


def offers_daily(fact_offers: DataFrame, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    """G1: per driver (NULL kept as a group) and day in the window."""
    return (offers_in_window(fact_offers, cfg)
            .groupBy("driver_id", F.col("offer_created_date_key").alias("activity_date_key"))
            .agg(F.sum("route_distance").cast(DISTANCE).alias("route_distance"),
                 *[F.sum(one()).alias(name) for name, one in OFFER_MEASURES.items()]))


def bookings_daily(fact_bookings: DataFrame, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    """Per driver (NULL kept as a group) and day in the window."""
    return (bookings_in_window(fact_bookings, cfg)
            .groupBy("driver_id", F.col("booking_request_date_key").alias("activity_date_key"))
            .agg(*[F.sum(one()).alias(name) for name, one in BOOKING_MEASURES.items()],
                 F.sum(_fare()).cast(MONEY).alias("total_est_revenue")))


COUNTS = (*OFFER_MEASURES, *BOOKING_MEASURES)
SUMS = ("route_distance", "revenue", *COUNTS)


def daily_sums(fact_offers: DataFrame, fact_bookings: DataFrame) -> DataFrame:
    """Sparse sums (``SUMS``) per (driver, day) of the days with offers or bookings; NULL drivers are left out.

    Sums of parts of the facts can be added up (``F.sum`` of each column) to those of the whole.
    """
    zero = F.lit(0).cast("bigint")
    offers = fact_offers.filter(F.col("driver_id").isNotNull()).select(
        "driver_id", F.col("offer_created_date_key").alias("activity_date_key"), F.col("route_distance").cast(DISTANCE).alias("route_distance"),
        F.lit(None).cast(MONEY).alias("revenue"), *[one().alias(c) for c, one in OFFER_MEASURES.items()], *[zero.alias(c) for c in BOOKING_MEASURES])
    bookings = fact_bookings.filter(F.col("driver_id").isNotNull()).select(
        "driver_id", F.col("booking_request_date_key").alias("activity_date_key"), F.lit(None).cast(DISTANCE).alias("route_distance"),
        _fare().alias("revenue"), *[zero.alias(c) for c in OFFER_MEASURES], *[one().alias(c) for c, one in BOOKING_MEASURES.items()])
    return (offers.unionByName(bookings).groupBy("driver_id", "activity_date_key")
            .agg(F.sum("route_distance").cast(DISTANCE).alias("route_distance"), F.sum("revenue").cast(MONEY).alias("revenue"),
                 *[F.sum(c).alias(c) for c in COUNTS]))


def _key_to_date(key: Column) -> Column:
    """yyyymmdd integer key -> date, by arithmetic (no string parsing per row)."""
    return F.make_date((key / 10000).cast("int"), (key / 100 % 100).cast("int"), (key % 100).cast("int"))


def dense_activity(daily: DataFrame, registered: DataFrame, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    """Every population driver on every window day, from the sparse ``daily_sums`` and the registered driver ids.

    A driver's days are gathered into one row, a list of at most as many entries as
    the window has days, however active the driver is; registered drivers add an
    empty list.  The row then expands to its entries and, as rows of literal zeros, to
    the days that it lacks (``array_except`` over the window's literal day list).  Dense
    rows arise after the last exchange, and the daily sums are computed once.
    """
    spark = daily.sparkSession
    # the exchange carries the sparse days but feeds an output that is larger by the window's length: its
    # width is the configured one instead of what AQE would fit to the (small) shuffled bytes
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sums = F.struct(*[F.col(c) for c in SUMS])
    active = daily.select("driver_id", F.struct(F.col("activity_date_key").cast("int").alias("day"), sums.alias("sums")).alias("entry"))
    none = F.lit(None).cast(active.schema["entry"].dataType)
    per_driver = (active.unionByName(registered.filter(F.col("driver_id").isNotNull()).select("driver_id", none.alias("entry")))
                  .repartition(parts, "driver_id").groupBy("driver_id")
                  .agg(F.collect_list("entry").alias("entries")))  # NULLs are skipped
    window = F.array(*[F.lit(k) for k in cfg.window_day_keys()]).cast("array<int>")
    # both branches read the same exchange: Spark runs it once and reuses it
    active_days = (per_driver.select("driver_id", F.explode("entries").alias("entry"))
                   .select("driver_id", F.col("entry.day").alias("activity_date_key"), "entry.sums.*"))
    idle_days = per_driver.select("driver_id", F.explode(F.array_except(window, F.col("entries.day"))).alias("activity_date_key"))

    def rate(guard: str, value: Column) -> Column:
        # NULL (not 0) where trips were made but no fare of the day is known
        return F.when(F.col(guard) > 0, value).otherwise(F.lit(0).cast(RATE))

    def total(c: str, kind: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0).cast(kind))

    measures = {"total_route_distance": (DISTANCE, total("route_distance", DISTANCE))}
    measures |= {c: ("bigint", F.col(c)) for c in ("total_offers", "offers_accepted", "offers_cancelled", "offers_read", "total_bookings",
                                                   "completed_trips", "driver_abort_count", "no_driver_found_count")}
    measures |= {
        "total_est_revenue": (MONEY, total("revenue", MONEY)),
        "missing_driver_offers_records": ("bigint", F.col("missing_driver_offers_records")),
        "missing_driver_bookings_records": ("bigint", F.col("missing_driver_bookings_records")),
        "offer_acceptance_rate": (RATE, rate("total_offers", count_ratio(F.col("offers_accepted"), F.col("total_offers"), 2))),
        "booking_completion_rate": (RATE, rate("total_bookings", count_ratio(F.col("completed_trips"), F.col("total_bookings"), 2))),
        "driver_abort_rate": (RATE, rate("total_bookings", count_ratio(F.col("driver_abort_count"), F.col("total_bookings"), 2))),
        "avg_est_revenue_per_trip": (RATE, rate("completed_trips", money_ratio(F.col("revenue"), F.col("completed_trips"), 2))),
    }
    keys = ("driver_id", "activity_date_key", _key_to_date(F.col("activity_date_key")).alias("activity_date"))
    return (active_days.select(*keys, *[value.alias(c) for c, (_, value) in measures.items()])
            .unionByName(idle_days.select(*keys, *[F.lit(0).cast(kind).alias(c) for c, (kind, _) in measures.items()])))


def agg_driver_activity(dim_active: DataFrame, fact_offers: DataFrame, fact_bookings: DataFrame,
                        cfg: EngagementConfig = DEFAULT) -> DataFrame:
    """One row per population driver and window day, measures 0 when idle.

    Offer and booking rows are summed on (driver, day), with map-side partial sums (a
    hot driver's rows spread over its days), and ``dense_activity`` does the rest:
    each input is scanned once, and there is one exchange per key.  Equals
    "population x days LEFT JOIN offers_daily LEFT JOIN bookings_daily": every
    in-window fact's driver is in the population and every in-window day is a spine day.
    """
    daily = daily_sums(offers_in_window(fact_offers, cfg), bookings_in_window(fact_bookings, cfg))
    return dense_activity(daily, registered_by_window_end(dim_active, cfg).select("driver_id"), cfg)
