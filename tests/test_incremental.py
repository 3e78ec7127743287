"""Load by load against full rebuilds: late references, parts that stay, failed loads, versions as of a time."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripwise.config import DEFAULT
from tripwise.operators import facts, staging
from tripwise.plans.incremental import IncrementalModel
from tripwise.plans.layers import Layers
from tripwise.sources.fixtures import RAW_BOOKING_COLUMNS, RAW_DRIVER_COLUMNS, RAW_OFFER_COLUMNS

AT = {1: dt.datetime(2026, 5, 1), 2: dt.datetime(2026, 5, 2), 3: dt.datetime(2026, 5, 3)}


def _raw(spark, load, drivers=(), bookings=(), offers=()):
    def df(rows, columns):
        kinds = ["boolean" if c == "is_processed" else "timestamp" if c == "load_tz" else "string" for c in columns]
        return spark.createDataFrame([(*r, False, AT[load]) for r in rows], ", ".join(f"{c} {k}" for c, k in zip(columns, kinds)))
    return {"drivers": df(drivers, RAW_DRIVER_COLUMNS), "bookings": df(bookings, RAW_BOOKING_COLUMNS), "offers": df(offers, RAW_OFFER_COLUMNS)}


def _driver(i, rating="4.0"):
    return (i, "France", rating, "10", "2021-05-01 08:00:00", "true")


def _booking(i, driver, day="2021-06-03", status="SUCCESS", fare="10.00"):
    return (i, f"{day} 10:00:00", status, driver, fare)


def _offer(i, booking, driver, day="2021-06-03"):
    return (i, f"{day} 09:00:00", booking, driver, "100", "ACCEPTED", "true")


def _loads(spark):
    return [
        _raw(spark, 1, [_driver("d1")], [_booking("b1", "d2"), _booking("b2", "d1", "2021-07-05"), _booking("b4", None), _booking("b5", "d1", status="LOST")],
             [_offer("o1", "b1", "d2"), _offer("o2", "b3", "d1", "2021-08-01"), _offer("o3", "b5", "d1")]),
        # the driver and the booking that were missing; a booking sent again on another day; one that becomes invalid
        _raw(spark, 2, [_driver("d2")], [_booking("b3", "d1", "2021-06-09"), _booking("b5", "d1", "2021-06-10"), _booking("b1", "d2", "2021-06-04")],
             [_offer("o4", "b2", "d1", "2021-06-04")]),
        _raw(spark, 3, [_driver("d1", "4.5")], [_booking("b3", "d1", "2021-06-09", status="GONE")], [_offer("o4", "b2", "d1", "2021-06-04")]),
    ]


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_load_by_load_equals_full_load(spark, scratch, monkeypatch):
    loads = _loads(spark)
    model = IncrementalModel(spark, scratch, buckets=4)
    model.load(loads[0], "l1")
    flags = lambda t, key: {r[key]: r.is_missing_driver for r in model.staged[t].read().collect()}
    assert flags("bookings", "booking_id") == {"b1": True, "b2": False, "b4": False, "b5": False}
    july = model.facts["bookings"].folders()["202107"]

    # the second load fails between staging and facts, and is run again
    with monkeypatch.context() as m:
        m.setattr(IncrementalModel, "_update_facts", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            model.load(loads[1], "l2")
    assert model.facts["bookings"].folders()["202107"] == july and model.daily.version() == 1
    model.load(loads[1], "l2")
    assert flags("bookings", "booking_id")["b1"] is False and flags("offers", "offer_id")["o1"] is False
    assert model.facts["bookings"].folders()["202107"] == july  # nothing of July has changed
    versions = {k: t.version() for k, t in (model.staged | model.facts | {"daily": model.daily}).items()}
    model.load(loads[1], "l2")
    assert versions == {k: t.version() for k, t in (model.staged | model.facts | {"daily": model.daily}).items()}

    model.load(loads[2], "l3")
    missing = {r.offer_id: r.is_missing_booking for r in model.staged["offers"].read().collect()}
    assert missing == {"o1": False, "o2": True, "o3": False, "o4": False}  # b3 came and went

    raw = {k: loads[0][k].unionByName(loads[1][k]).unionByName(loads[2][k]) for k in loads[0]}
    full = Layers(spark, "", raw=raw)
    assert _same(model.staged["bookings"].read(), full.stg_bookings()) and _same(model.staged["offers"].read(), full.stg_offers())
    assert _same(model.agg_driver_activity(), full.agg_driver_activity())
    # every fact of the driver with a new version has the new one
    active = {r.driver_id: r.dim_driver_id for r in model.dim_drivers().filter("is_active").collect()}
    assert len(active) == 2 and model.dim_drivers().count() == 3
    for table, rebuilt in ((model.fact_bookings(), full.fact_bookings()), (model.fact_offers(), full.fact_offers())):
        assert {(r.driver_id, r.dim_driver_id) for r in table.collect() if r.driver_id} <= set(active.items())
        assert _same(table.drop("dim_driver_id"), rebuilt.drop("dim_driver_id"))


def test_version_as_of_a_time(spark):
    t = lambda s: dt.datetime.fromisoformat(s)
    dim = spark.createDataFrame([(1, "a", t("2021-01-01"), 4, "FR", True), (2, "a", t("2021-02-01"), 5, "AT", None), (3, "b", t("2021-03-01"), 3, None, False)],
                                "dim_driver_id long, driver_id string, start_eff_ts timestamp, driver_rating int, country_code string, receive_marketing boolean")
    times = {"before": ("a", "2020-12-31 23:59:59", None), "start": ("a", "2021-01-01", 1), "gap": ("a", "2021-01-31 23:59:59.500000", 1),
             "next": ("a", "2021-02-01", 2), "late": ("a", "2025-01-01", 2), "other": ("b", "2021-04-01", 3), "unknown": ("c", "2021-04-01", None),
             "none": (None, "2021-04-01", None)}
    rows = [(k, t(at), "SUCCESS", driver, None) for k, (driver, at, _) in times.items()]
    rows += [(f"hot{i}", t("2021-02-01") + dt.timedelta(hours=i - 30), "SUCCESS", "a", None) for i in range(60)]
    bookings = spark.createDataFrame(rows, "booking_id string, booking_request_date timestamp, booking_status string, driver_id string, estimated_route_fare decimal(38,2)")
    got = {r.booking_id: r for r in facts.fact_bookings_asof(bookings, dim, deals=3).collect()}
    assert len(got) == len(rows)
    assert {k: got[k].dim_driver_id for k in times} == {k: v for k, (_, _, v) in times.items()}
    assert all(got[f"hot{i}"].dim_driver_id == (1 if i < 30 else 2) for i in range(60))
    assert got["next"].country_code == "AT" and got["next"].receive_marketing is None
    plan = facts.fact_bookings_asof(bookings, dim)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan


def test_staged_rows_are_the_latest(spark, scratch):
    model = IncrementalModel(spark, scratch, DEFAULT, buckets=3)
    one, two = _loads(spark)[:2]
    model.load_staging(one, "l1")
    model.load_staging(two, "l2")
    both = {k: one[k].unionByName(two[k]) for k in one}
    want = staging.clean_bookings(both["bookings"], staging.valid_drivers(staging.clean_drivers(both["drivers"])))
    assert _same(model.staged["bookings"].read(), want)
    assert model.staged["bookings"].read().groupBy("booking_id").count().agg(F.max("count")).first()[0] == 1
