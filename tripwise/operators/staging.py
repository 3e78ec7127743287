"""Raw text -> typed staging rows with quality and referential flags.

Each cleaner is ``raw DataFrame -> staging DataFrame``: dedup the unprocessed
batch, cast totally, evaluate the rule list, flag unknown references.  No row
is dropped; ``valid_*`` is the quarantine boundary consumers read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (BOOKING_STATUSES, DEFAULT, DRIVER_READ_VALID, MARKETING_FALSE, MARKETING_TRUE,
                      OFFER_STATES, RULE_MESSAGES, EngagementConfig)
from ..functions.casts import (blank, norm_upper, null_text, text_to_bool, to_decimal, to_instant,
                               to_local_date)
from ..functions.rules import Rule, apply_rules
from ..sources.seeds import country_mapping
from .dedup import latest_per_key


def _msg(code: str, detail=None):
    """Rule message; ``detail`` (a column) is appended for format errors."""
    text = F.lit(RULE_MESSAGES[code])
    return text if detail is None else F.concat(text, detail)


def _ts(s: str):
    return F.lit(s).cast("timestamp")


def unprocessed(raw: DataFrame) -> DataFrame:
    # the batch filter sits below the ranking (a window does not let it through)
    return raw.filter(~F.col("is_processed")) if "is_processed" in raw.columns else raw


# --------------------------------------------------------------------------- drivers
def driver_rules(cfg: EngagementConfig) -> list[Rule]:
    c = F.col
    now = _ts(cfg.as_of)
    return [
        Rule("R1", blank("id"), _msg("R1")),
        Rule("R2", c("registration_date").isNull() | (c("registration_date") > now)
             | (c("registration_date") < _ts(cfg.driver_date_floor)), _msg("R2")),
        Rule("R3", c("org_date_registration").isNotNull() & c("registration_date").isNull(),
             _msg("R3", c("org_date_registration"))),
        Rule("R4", c("org_rating").isNotNull() & c("rating").isNull(),
             _msg("R4", c("org_rating"))),
        Rule("R5", c("org_rating_count").isNotNull() & c("rating_count").isNull(),
             _msg("R5", c("org_rating_count"))),
        Rule("R6", (c("rating") < 1) | (c("rating") > 5), _msg("R6")),
        Rule("R7", c("rating_count") < 0, _msg("R7")),
        Rule("R8", ((c("rating_count") == 0) | c("rating_count").isNull()) & (c("rating") >= 1),
             _msg("R8")),
        Rule("R9", ((c("rating") == 0) | c("rating").isNull()) & (c("rating_count") > 0),
             _msg("R9")),
        # NOT IN under three-valued logic: a NULL value does not fail
        Rule("R10", ~c("receive_marketing_txt").isin(*MARKETING_TRUE, *MARKETING_FALSE),
             _msg("R10")),
        Rule("R11", blank("country"), _msg("R11")),
        Rule("R12", c("country_code").isNull(),
             _msg("R12", F.coalesce(c("country"), F.lit("NULL")))),
    ]


def standardise_country(df: DataFrame, country_col: str = "country") -> DataFrame:
    """Left join to the country spelling map on UPPER(TRIM(...)).

    The map is a fixed seed of a few rows, de-duplicated on its normalised key
    so the join cannot fan out; broadcasting it is size-safe.
    """
    cm = (country_mapping(df.sparkSession)
          .select(norm_upper("raw_value").alias("_cm_key"), "country_name", "country_code")
          .dropDuplicates(["_cm_key"]))
    return (df.join(F.broadcast(cm), norm_upper(country_col) == F.col("_cm_key"), "left")
            .drop("_cm_key"))


def clean_drivers(raw: DataFrame, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    d = latest_per_key(unprocessed(raw), "id")
    typed = d.select(
        "id", "country", "load_tz",
        null_text("rating_count").alias("org_rating_count"),
        null_text("rating").alias("org_rating"),
        null_text("date_registration").alias("org_date_registration"),
        to_instant("date_registration").alias("registration_date"),
        to_local_date("date_registration").alias("registration_local_date"),
        to_decimal("rating", 38, 2).alias("rating"),
        to_decimal("rating_count", 38, 0).alias("rating_count"),
        norm_upper("receive_marketing").alias("receive_marketing_txt"),
    )
    checked = apply_rules(standardise_country(typed), driver_rules(cfg))
    return checked.select(
        F.col("id").alias("driver_id"),
        F.col("country").alias("country_raw"),
        "country_name", "country_code",
        F.col("rating").alias("driver_rating"),
        F.col("rating_count").alias("driver_rating_count"),
        "registration_date", "registration_local_date",
        text_to_bool("receive_marketing_txt", MARKETING_TRUE, MARKETING_FALSE).alias("receive_marketing"),
        "is_valid", "error_reason", "error_codes",
        F.lit(False).alias("is_processed"),
        F.col("load_tz").alias("raw_load_tz"),
    )


def valid_drivers(stg: DataFrame, *more: str) -> DataFrame:
    return stg.filter(F.col("is_valid")).select(
        "driver_id", "country_name", "country_code", "driver_rating", "driver_rating_count",
        "registration_date", "registration_local_date", "receive_marketing", "is_processed", "raw_load_tz", *more)


# --------------------------------------------------------------------------- bookings
def booking_rules(cfg: EngagementConfig) -> list[Rule]:
    c = F.col
    now = _ts(cfg.as_of)
    return [
        Rule("R13", blank("id"), _msg("R13")),
        Rule("R14", c("request_date").isNull() | (c("request_date") > now)
             | (c("request_date") < _ts(cfg.booking_date_floor)), _msg("R14")),
        Rule("R15", c("org_request_date").isNotNull() & c("request_date").isNull(),
             _msg("R15", c("org_request_date"))),
        Rule("R16", c("status").isNull() | ~c("status").isin(*BOOKING_STATUSES),
             _msg("R16", F.coalesce(c("status"), F.lit("NULL")))),
        Rule("R17", c("estimated_route_fare") < 0, _msg("R17")),
        Rule("R18", c("org_estimated_route_fare").isNotNull() & c("estimated_route_fare").isNull(),
             _msg("R18", c("org_estimated_route_fare"))),
    ]


def missing_ref(df: DataFrame, fk: str, ref_keys: DataFrame, ref_key: str, flag: str, row_id: str,
                fk_present=None) -> DataFrame:
    """``flag`` = the (present) foreign key has no match among ``ref_keys``.

    The reference side is reduced to its distinct keys first, so duplicates
    there cannot multiply rows here.  Broadcast vs. shuffle is left to AQE,
    which broadcasts only when the measured key set is small.  A NULL key
    can never match; such rows (often a large share, e.g. unassigned
    bookings) would all hash to one shuffle partition, so their join key is
    replaced by the row's own id behind a prefix no real key carries: unique
    per row (ids are deduplicated), deterministic, and matching nothing.
    """
    keys = ref_keys.select(F.col(ref_key).alias("_ref_key")).distinct().withColumn("_ref_hit", F.lit(True))
    present = F.col(fk).isNotNull() if fk_present is None else fk_present
    spread = F.concat(F.lit("\u0000"), F.coalesce(F.col(row_id), F.lit("")))
    return (df.withColumn("_fk", F.coalesce(F.col(fk), spread))
            .join(keys, F.col("_fk") == F.col("_ref_key"), "left")
            .withColumn(flag, F.col("_ref_hit").isNull() & present)
            .drop("_fk", "_ref_key", "_ref_hit"))


def clean_bookings(raw: DataFrame, drivers_valid: DataFrame, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    b = latest_per_key(unprocessed(raw), "id")
    typed = b.select(
        "id",
        F.col("request_date").alias("org_request_date"),
        to_instant("request_date").alias("request_date"),
        to_local_date("request_date").alias("request_local_date"),
        norm_upper("status").alias("status"),
        null_text("id_driver").alias("id_driver"),
        null_text("estimated_route_fare").alias("org_estimated_route_fare"),
        to_decimal("estimated_route_fare", 38, 2).alias("estimated_route_fare"),
        "load_tz",
    )
    checked = apply_rules(typed, booking_rules(cfg))
    flagged = missing_ref(checked, "id_driver", drivers_valid, "driver_id", "is_missing_driver", "id")
    return flagged.select(
        F.col("id").alias("booking_id"),
        F.col("request_date").alias("booking_request_date"),
        F.col("request_local_date").alias("booking_request_local_date"),
        F.col("status").alias("booking_status"),
        F.col("id_driver").alias("driver_id"),
        "estimated_route_fare", "is_valid", "error_reason", "error_codes",
        F.lit(False).alias("is_processed"),
        F.col("load_tz").alias("raw_load_tz"),
        "is_missing_driver",
    )


def valid_bookings(stg: DataFrame) -> DataFrame:
    return stg.filter(F.col("is_valid")).select(
        "booking_id", "booking_request_date", "booking_request_local_date", "booking_status", "driver_id",
        "estimated_route_fare", "is_processed", "raw_load_tz", "is_missing_driver")


# --------------------------------------------------------------------------- offers
def offer_rules(cfg: EngagementConfig) -> list[Rule]:
    c = F.col
    now = _ts(cfg.as_of)
    driver_for_rule = c("driverid_raw") if cfg.literal_offer_driver_text_null else c("driverid")
    return [
        Rule("R19", blank("offer_id"), _msg("R19")),
        Rule("R20", driver_for_rule.isNull(), _msg("R20")),
        Rule("R21", c("offer_created_date").isNull() | (c("offer_created_date") > now)
             | (c("offer_created_date") < _ts(cfg.offer_date_floor)), _msg("R21")),
        Rule("R22", c("org_datecreated").isNotNull() & c("offer_created_date").isNull(),
             _msg("R22", c("org_datecreated"))),
        Rule("R23", c("bookingid").isNull(), _msg("R23")),
        Rule("R24", (c("route_distance_2") < 0) | (c("route_distance_2") > cfg.max_route_distance),
             _msg("R24")),
        Rule("R25", c("org_routedistance").isNotNull() & c("route_distance_2").isNull(),
             _msg("R25", c("org_routedistance"))),
        Rule("R26", c("offer_state").isNull() | ~c("offer_state").isin(*OFFER_STATES), _msg("R26")),
        Rule("R27", c("driver_read_txt").isNull() | ~c("driver_read_txt").isin(*DRIVER_READ_VALID),
             _msg("R27")),
    ]


def clean_offers(raw: DataFrame, bookings_valid: DataFrame, drivers_valid: DataFrame,
                 cfg: EngagementConfig = DEFAULT) -> DataFrame:
    o = latest_per_key(unprocessed(raw), "id")
    typed = o.select(
        F.col("id").alias("offer_id"),
        F.col("datecreated").alias("org_datecreated"),
        to_instant("datecreated").alias("offer_created_date"),
        to_local_date("datecreated").alias("offer_created_local_date"),
        "bookingid",
        F.col("driverid").alias("driverid_raw"),
        null_text("driverid").alias("driverid"),
        null_text("routedistance").alias("org_routedistance"),
        to_decimal(null_text("routedistance"), 38, 2).alias("route_distance_2"),
        norm_upper("state").alias("offer_state"),
        norm_upper("driverread").alias("driver_read_txt"),
        F.col("load_tz").alias("raw_load_tz"),
    )
    checked = apply_rules(typed, offer_rules(cfg))
    drv_present = (F.col("driverid_raw") if cfg.literal_offer_driver_text_null else F.col("driverid")).isNotNull()
    flagged = missing_ref(checked, "bookingid", bookings_valid, "booking_id", "is_missing_booking", "offer_id")
    flagged = missing_ref(flagged, "driverid", drivers_valid, "driver_id", "is_missing_driver", "offer_id",
                          fk_present=drv_present)
    return flagged.select(
        "offer_id", "offer_created_date", "offer_created_local_date",
        F.col("bookingid").alias("booking_id"),
        F.col("driverid").alias("driver_id"),
        # checked at scale 2, stored at scale 0 (rounded half-up)
        F.col("route_distance_2").cast("decimal(38,0)").alias("route_distance"),
        "offer_state",
        text_to_bool("driver_read_txt", MARKETING_TRUE, MARKETING_FALSE).alias("driver_read"),
        "is_valid", "error_reason", "error_codes",
        F.lit(False).alias("is_processed"),
        "raw_load_tz", "is_missing_driver", "is_missing_booking",
    )


def valid_offers(stg: DataFrame) -> DataFrame:
    return stg.filter(F.col("is_valid")).select(
        "offer_id", "offer_created_date", "offer_created_local_date", "booking_id", "driver_id",
        "route_distance", "offer_state", "driver_read", "is_processed", "raw_load_tz",
        "is_missing_driver", "is_missing_booking")


# --------------------------------------------------------------------------- across batches
STAGED_KEYS = {"drivers": "driver_id", "bookings": "booking_id", "offers": "offer_id"}


def latest_staged(staged: DataFrame, kind: str) -> DataFrame:
    """Latest staged row per key across loads (Q3).

    Each load deduplicates only its own batch, so a re-sent id is staged once
    per load; consumers that join on the key (facts, reference checks) should
    read this view of the accumulated staged table.  Newest load wins; ties
    are broken on the other columns as in ``latest_per_key``.
    """
    return latest_per_key(staged, STAGED_KEYS[kind], newest_first="raw_load_tz")
