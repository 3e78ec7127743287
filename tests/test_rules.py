"""One literal row per rule: pass, fail and NULL cases."""

from pyspark.sql import functions as F

from tripwise.operators import staging
from tripwise.sources.fixtures import RAW_BOOKING_COLUMNS, RAW_DRIVER_COLUMNS, RAW_OFFER_COLUMNS

TS = "2026-06-01 00:00:00"
GOOD_DRIVER = ("1", "FRANCE", "4.5", "10", "2021-06-01 08:00:00", "true")


def _raw(spark, cols, rows):
    schema = ", ".join(f"{c} string" for c in cols[:-2]) + ", is_processed boolean, load_tz timestamp"
    df = spark.createDataFrame([tuple(r) + (False, None) for r in rows], schema)
    return df.withColumn("load_tz", F.lit(TS).cast("timestamp"))


def _drivers(spark, *rows):
    out = staging.clean_drivers(_raw(spark, RAW_DRIVER_COLUMNS, rows)).orderBy("driver_id").collect()
    return {r["driver_id"]: r for r in out}


def test_good_driver_is_valid(spark):
    r = _drivers(spark, GOOD_DRIVER)["1"]
    assert r.is_valid and r.error_reason == "" and r.error_codes == ""
    assert r.country_name == "France" and r.country_code == "FR" and r.receive_marketing is True


def test_driver_rules_fire(spark):
    rows = {
        "R2": ("2", "FRANCE", "4.5", "10", "2008-01-01 00:00:00", "true"),
        "R3": ("3", "FRANCE", "4.5", "10", "not-a-date", "true"),
        "R4": ("4", "FRANCE", "abc", "10", "2021-06-01 08:00:00", "true"),
        "R5": ("5", "FRANCE", "4.5", "x", "2021-06-01 08:00:00", "true"),
        "R6": ("6", "FRANCE", "5.01", "10", "2021-06-01 08:00:00", "true"),
        "R7": ("7", "FRANCE", "4.5", "-3", "2021-06-01 08:00:00", "true"),
        "R8": ("8", "FRANCE", "4.5", "0", "2021-06-01 08:00:00", "true"),
        "R9": ("9", "FRANCE", "null", "5", "2021-06-01 08:00:00", "true"),
        "R10": ("10", "FRANCE", "4.5", "10", "2021-06-01 08:00:00", "maybe"),
        "R12": ("12", "GERMANY", "4.5", "10", "2021-06-01 08:00:00", "true"),
    }
    got = _drivers(spark, *rows.values())
    for code, row in rows.items():
        r = got[row[0]]
        assert code in r.error_codes.split(","), (code, r.error_codes)
        assert not r.is_valid
    assert got["12"].error_reason == "UNMAPPED COUNTRY: GERMANY"
    assert got["3"].error_reason == "INVALID DATE_REGISTRATION | DATE_REGISTRATION FORMAT ERROR: not-a-date"


def test_driver_null_cases(spark):
    got = _drivers(spark,
                   (None, None, "4.5", "10", "2021-06-01 08:00:00", None),      # NULL id, country, marketing
                   ("20", "FRANCE", "0", "0", "2021-06-01 08:00:00", "null"),   # rating 0 fails R6, text null fails R10
                   ("21", "FRANCE", "1.0", "1", "2021-06-01 08:00:00", "1"),
                   ("22", "FRANCE", "5.0", "1", "2021-06-01 08:00:00", " yes "))
    n = got[None]
    assert set(n.error_codes.split(",")) == {"R1", "R11", "R12"}          # NULL marketing passes R10
    assert n.error_reason.startswith("NULL/EMPTY ID | ")
    assert "UNMAPPED COUNTRY: NULL" in n.error_reason
    assert set(got["20"].error_codes.split(",")) == {"R6", "R10"}
    assert got["21"].is_valid and got["22"].is_valid and got["22"].receive_marketing is True


def test_null_id_rows_keep_one(spark):
    got = staging.clean_drivers(_raw(spark, RAW_DRIVER_COLUMNS, [
        (None, "FRANCE", "4.5", "10", "2021-06-01 08:00:00", "true"),
        (None, "FRANCE", "4.6", "10", "2021-06-01 08:00:00", "true")]))
    assert got.count() == 1


def test_booking_rules(spark):
    drivers = staging.valid_drivers(staging.clean_drivers(_raw(spark, RAW_DRIVER_COLUMNS, [GOOD_DRIVER])))
    raw = _raw(spark, RAW_BOOKING_COLUMNS, [
        ("b1", "2021-06-02 10:00:00", " success", "1", "12.50"),
        ("b2", "2021-06-02 10:00:00", "SUCCESS", "999", "12.50"),
        (" ", "null", "LOST", "null", "-5.00"),
        ("b4", "2005-01-01 00:00:00", None, "1", "n/a"),
        ("b5", "2027-01-01 00:00:00", "DRIVER_ABORT", "1", "null"),
    ])
    got = {r["booking_id"]: r for r in staging.clean_bookings(raw, drivers).collect()}
    assert got["b1"].is_valid and not got["b1"].is_missing_driver and got["b1"].booking_status == "SUCCESS"
    assert got["b2"].is_valid and got["b2"].is_missing_driver
    assert set(got[" "].error_codes.split(",")) == {"R13", "R14", "R15", "R16", "R17"}
    assert not got[" "].is_missing_driver                      # 'null' driver is missing, not unknown
    assert "INVALID STATUS: |LOST" in got[" "].error_reason
    assert set(got["b4"].error_codes.split(",")) == {"R14", "R16", "R18"}
    assert "INVALID STATUS: |NULL" in got["b4"].error_reason
    assert got["b5"].error_codes == "R14" and got["b5"].estimated_route_fare is None


def test_offer_rules(spark):
    drivers = staging.valid_drivers(staging.clean_drivers(_raw(spark, RAW_DRIVER_COLUMNS, [GOOD_DRIVER])))
    bookings = staging.valid_bookings(staging.clean_bookings(
        _raw(spark, RAW_BOOKING_COLUMNS, [("b1", "2021-06-02 10:00:00", "SUCCESS", "1", "12.50")]), drivers))
    raw = _raw(spark, RAW_OFFER_COLUMNS, [
        ("o1", "2021-06-02 10:00:00", "b1", "1", "1700.5", " accepted", "true"),
        ("o2", "2021-06-02 10:00:00", "b9", "7", "far", "PENDING", "maybe"),
        ("", "bad", None, "null", "600000", "Canceled", "YES"),
        ("o4", "2005-01-01 00:00:00", "b1", "1", "-1", None, None),
    ])
    got = {r["offer_id"]: r for r in staging.clean_offers(raw, bookings, drivers).collect()}
    o1 = got["o1"]
    assert o1.is_valid and o1.route_distance == 1701 and o1.offer_state == "ACCEPTED" and o1.driver_read is True
    assert not o1.is_missing_driver and not o1.is_missing_booking
    o2 = got["o2"]
    assert set(o2.error_codes.split(",")) == {"R25", "R26", "R27"} and o2.is_missing_driver and o2.is_missing_booking
    o3 = got[""]
    assert set(o3.error_codes.split(",")) == {"R19", "R20", "R21", "R22", "R23", "R24", "R27"}
    assert o3.driver_read is True                 # YES maps to true although R27 rejects it
    assert set(got["o4"].error_codes.split(",")) == {"R21", "R24", "R26", "R27"}


def test_offer_text_null_driver_literal_mode(spark):
    from tripwise.config import DEFAULT
    cfg = DEFAULT.with_(literal_offer_driver_text_null=True)
    drivers = staging.valid_drivers(staging.clean_drivers(_raw(spark, RAW_DRIVER_COLUMNS, [GOOD_DRIVER])))
    bookings = staging.valid_bookings(staging.clean_bookings(
        _raw(spark, RAW_BOOKING_COLUMNS, [("b1", "2021-06-02 10:00:00", "SUCCESS", "1", "12.50")]), drivers))
    raw = _raw(spark, RAW_OFFER_COLUMNS, [("o1", "2021-06-02 10:00:00", "b1", "null", "10", "ACCEPTED", "1")])
    r = staging.clean_offers(raw, bookings, drivers, cfg).first()
    assert "R20" not in r.error_codes and r.is_missing_driver and r.driver_id is None
