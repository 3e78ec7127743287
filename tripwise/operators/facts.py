"""Booking and offer facts (B1, B2).

Facts resolve a driver against the *current* dimension version and a wall
date against the calendar.  The dimension / booking lookups are plain left joins
on de-duplicated keys and AQE picks broadcast or shuffle from their measured size.
A NULL key matches nothing; such rows (often a large share) would all meet in one
shuffle partition, so each joins by its own id behind a prefix no real key carries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .calendar import with_date_key


def _flag_missing(hit: str) -> F.Column:
    return F.when(F.col(hit).isNull(), 1).otherwise(0)


def _driver_keys(dim_active: DataFrame) -> DataFrame:
    # one active version per driver; distinct keeps the join from fanning out regardless
    return (dim_active.select(F.col("driver_id").alias("_d_driver_id"), "dim_driver_id")
            .dropDuplicates(["_d_driver_id"]))


def spread(key: str, row_id: str) -> F.Column:
    return F.coalesce(F.col(key), F.concat(F.lit("\u0000"), F.coalesce(F.col(row_id), F.lit(""))))


def with_driver_version(df: DataFrame, dim_active: DataFrame, row_id: str) -> DataFrame:
    """``dim_driver_id`` of the driver's active version, and whether there is none."""
    return (df.join(_driver_keys(dim_active), spread("driver_id", row_id) == F.col("_d_driver_id"), "left")
            .withColumn("is_missing_driver", _flag_missing("_d_driver_id")).drop("_d_driver_id"))


def fact_bookings(bookings_valid: DataFrame, dim_active: DataFrame, cal: DataFrame | None) -> DataFrame:
    b = with_driver_version(bookings_valid, dim_active, "booking_id")
    b = with_date_key(b, "booking_request_local_date", "booking_request_date_key", cal)
    return b.select(
        "booking_id", "booking_request_date", "booking_request_date_key", "booking_status",
        "driver_id", "dim_driver_id", "estimated_route_fare", "is_missing_driver")


def fact_offers(offers_valid: DataFrame, bookings_valid: DataFrame | None, dim_active: DataFrame,
                cal: DataFrame | None, staged_check: bool = False) -> DataFrame:
    """``bookings_valid=None`` skips the booking check (for consumers that do not read it).

    ``staged_check`` takes it from the staged rows instead, which have it against the same valid bookings.
    """
    o = offers_valid
    cols = ["offer_id", "offer_created_date", "offer_created_date_key", "booking_id", "driver_id",
            "dim_driver_id", "route_distance", "offer_state", "driver_read", "is_missing_driver"]
    if staged_check:
        cols.append(F.col("is_missing_booking").cast("int").alias("is_missing_booking"))
    elif bookings_valid is not None:
        bk = (bookings_valid.select(F.col("booking_id").alias("_b_booking_id")).distinct())
        o = o.join(bk, spread("booking_id", "offer_id") == F.col("_b_booking_id"), "left")
        cols.append(_flag_missing("_b_booking_id").alias("is_missing_booking"))
    o = with_driver_version(o, dim_active, "offer_id")
    return with_date_key(o, "offer_created_local_date", "offer_created_date_key", cal).select(*cols)


#: a driver with more than one in so many bookings is hot; there are fewer than so many of them
HOT_SHARE = 1000


def fact_bookings_asof(bookings_valid: DataFrame, dim: DataFrame, deals: int = 64) -> DataFrame:
    """Bookings with the driver version that was in force when they were requested.

    A version is in force from its start until the next one's, half open, so the second between the end
    of one and the start of the next belongs to the former; a booking before the first version has none.
    Versions and bookings of a driver are put in one order of time, and the last version seen is the one
    (no range join).  A hot driver's bookings are dealt over ``deals`` groups, each with all its versions.
    """
    has_driver = F.col("driver_id").isNotNull()
    known = bookings_valid.filter(has_driver)
    per_driver = known.groupBy("driver_id").agg(F.count(F.lit(1)).alias("_n"))
    total = per_driver.agg(F.sum("_n").alias("n")).first()["n"] or 0
    hot = F.broadcast(per_driver.filter(F.col("_n") * HOT_SHARE > total).select("driver_id", F.lit(deals).alias("_deals")))

    def dealt(df: DataFrame) -> DataFrame:
        return df.join(hot, "driver_id", "left").withColumn("_deals", F.coalesce("_deals", F.lit(1)))

    version = F.struct("dim_driver_id", "driver_rating", "country_code", "receive_marketing")
    versions = (dealt(dim).select("driver_id", F.explode(F.sequence(F.lit(0), F.col("_deals") - 1)).alias("_deal"),
                                  F.col("start_eff_ts").alias("_at"), F.lit(0).alias("_kind"), version.alias("_version"),
                                  F.lit(None).cast(_booking_type(bookings_valid)).alias("_booking")))
    rows = (dealt(known).withColumn("_deal", F.pmod(F.xxhash64("booking_id"), F.col("_deals")).cast("int"))
            .select("driver_id", "_deal", F.col("booking_request_date").alias("_at"), F.lit(1).alias("_kind"),
                    F.lit(None).cast(versions.schema["_version"].dataType).alias("_version"),
                    F.struct(*_ASOF_COLUMNS).alias("_booking")))
    seen = Window.partitionBy("driver_id", "_deal").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = (versions.unionByName(rows).withColumn("_version", F.last("_version", ignorenulls=True).over(seen))
             .filter(F.col("_kind") == 1).select("driver_id", "_booking.*", "_version.*"))
    rest = bookings_valid.filter(~has_driver).select("driver_id", *_ASOF_COLUMNS)
    return found.unionByName(rest, allowMissingColumns=True)


_ASOF_COLUMNS = ("booking_id", "booking_request_date", "booking_status", "estimated_route_fare")


def _booking_type(bookings: DataFrame) -> str:
    return bookings.select(F.struct(*_ASOF_COLUMNS).alias("b")).schema["b"].dataType.simpleString()
