"""Structural invariants of the model on the small test tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tripwise.config import DEFAULT
from tripwise.operators import scd2
from tripwise.plans.layers import Layers


def test_valid_iff_no_error(spark):
    L = Layers(spark, SF_SMALL)
    for stg in (L.stg_drivers(), L.stg_bookings(), L.stg_offers()):
        assert stg.filter(F.col("is_valid") != (F.col("error_reason") == "")).count() == 0
        assert stg.filter((F.col("error_reason") == "") != (F.col("error_codes") == "")).count() == 0


def test_dense_table_shape_and_totals(spark):
    L = Layers(spark, SF_SMALL)
    agg = L.agg_driver_activity()
    days = len(DEFAULT.window_day_keys())
    assert agg.count() == L.population().count() * days
    assert agg.select("driver_id", "activity_date_key").distinct().count() == agg.count()
    lo, hi = DEFAULT.window_start_key, DEFAULT.window_end_key
    offers = L.fact_offers().filter(F.col("offer_created_date_key").between(lo, hi) & F.col("driver_id").isNotNull())
    bookings = L.fact_bookings().filter(F.col("booking_request_date_key").between(lo, hi)
                                        & F.col("driver_id").isNotNull())
    tot = agg.agg(F.sum("total_offers"), F.sum("total_bookings")).first()
    assert tot[0] == offers.count() and tot[1] == bookings.count()


def test_scd2_versions(spark):
    L = Layers(spark, SF_SMALL)
    dim = L.scd2_batch2()["dim"]
    # at most one active version per driver
    assert dim.filter("is_active").groupBy("driver_id").count().filter("count > 1").count() == 0
    # surrogate keys unique and consecutive
    n = dim.count()
    ids = dim.agg(F.countDistinct("dim_driver_id"), F.min("dim_driver_id"), F.max("dim_driver_id")).first()
    assert tuple(ids) == (n, 1, n)
    # versions of one driver do not overlap
    a, b = dim.alias("a"), dim.alias("b")
    overlap = a.join(b, (F.col("a.driver_id") == F.col("b.driver_id"))
                     & (F.col("a.dim_driver_id") < F.col("b.dim_driver_id"))
                     & (F.col("a.start_eff_ts") <= F.col("b.end_eff_ts"))
                     & (F.col("b.start_eff_ts") <= F.col("a.end_eff_ts")))
    assert overlap.count() == 0
    # every closed version ends one second before its successor starts
    closed = L.scd2_batch2()["closed"]
    assert closed.count() > 0
    assert closed.filter(F.col("end_eff_ts") != F.lit("2026-06-01 23:59:59").cast("timestamp")).count() == 0


def test_scd2_rerun_is_noop(spark):
    L = Layers(spark, SF_SMALL)
    once = L.scd2_batch2()["dim"]
    twice = scd2.apply_batch(once, L.valid_drivers_batch2(), "2026-06-03 00:00:00", DEFAULT)
    assert twice["closed"].count() == 0 and twice["opened"].count() == 0
    assert twice["dim"].exceptAll(once).count() == 0 and once.exceptAll(twice["dim"]).count() == 0


def test_pending_loads_in_one_pass_equal_load_by_load(spark):
    L = Layers(spark, SF_SMALL)
    from tripwise.operators import staging
    third = staging.valid_drivers(staging.clean_drivers(L.raw_drivers_batch3(), DEFAULT.with_(as_of="2026-06-03 00:00:00")))
    loads = [L.valid_drivers_batch2(), third]
    at = "2026-06-03 00:00:00"
    for cfg in (DEFAULT, DEFAULT.with_(literal_scd2_compare=True)):
        dim = L.dim_drivers()
        for load in loads:
            dim = scd2.apply_batch(dim, load, at, cfg)["dim"]
        together = loads[0].withColumn("load", F.lit(1)).unionByName(loads[1].withColumn("load", F.lit(2)))
        done = scd2.apply_loads(L.dim_drivers(), together, at, cfg)
        assert done["dim"].exceptAll(dim).count() == 0 and dim.exceptAll(done["dim"]).count() == 0
        # drivers with three versions: what the first of the loads opens, the second closes
        assert dim.groupBy("driver_id").count().filter("count = 3").count() > 0
        changes = {r["load"]: (r["opened"], r["closed"]) for r in done["changes"].collect()}
        assert sum(o for o, _ in changes.values()) == done["opened"].count() and sum(c for _, c in changes.values()) == done["closed"].count()


def test_driver_day_plan_reads_each_input_once(spark, scratch):
    L = Layers(spark, SF_SMALL, store=f"{scratch}/m")
    for layer in (L.dim_drivers, L.fact_offers, L.fact_bookings):
        layer()
    from tripwise.operators import activity
    df = activity.agg_driver_activity(L.registered_drivers(), L.fact_offers(), L.fact_bookings(), L.ccfg)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 3
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # one by (driver, day), one by driver, and the latter used again
    assert sum("ReusedExchange" not in line for line in exchanges) == 2 and len(exchanges) == 3


def test_partition_independence(spark):
    base = Layers(spark, SF_SMALL)
    one = Layers(spark, SF_SMALL, raw={"drivers": base.raw_drivers().repartition(1),
                                       "bookings": base.raw_bookings().repartition(1),
                                       "offers": base.raw_offers().repartition(7)})
    a, b = base.agg_driver_activity(), one.agg_driver_activity()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_wide_window_matches_day_by_day(spark):
    """The dense table for a 30-day window equals the union of its parts over the same population."""
    cfg = DEFAULT.with_(window_end="2021-06-30")
    L = Layers(spark, SF_SMALL, cfg)
    agg = L.agg_driver_activity()
    assert agg.count() == L.population().count() * 30
    first = agg.filter(F.col("activity_date_key") <= 20210614).filter(F.col("total_offers") > 0)
    ref = Layers(spark, SF_SMALL).agg_driver_activity().filter(F.col("total_offers") > 0)
    assert first.exceptAll(ref).count() == 0 and ref.exceptAll(first).count() == 0


def test_stored_layers_equal_lazy_plan(spark, scratch):
    """Production shape (every layer written, facts sorted by day in each file) gives the lazy plan's results."""
    stored = Layers(spark, SF_SMALL, store=f"{scratch}/model")
    lazy = Layers(spark, SF_SMALL)
    a, b = stored.agg_driver_activity(), lazy.agg_driver_activity()
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
    fo = spark.read.parquet(f"{scratch}/model/fact_offers")
    assert "offer_created_date_key" in fo.columns and fo.count() == lazy.fact_offers().count()
    for path in fo.inputFiles():
        days = [r[0] for r in spark.read.parquet(path).select("offer_created_date_key").collect()]
        assert days == sorted(days, key=lambda d: (d is not None, d))


def _joined_form(L):
    """The original formulation: spine LEFT JOIN offers_daily LEFT JOIN bookings_daily, then KPIs."""
    from tripwise.functions.ratios import half_up_ratio
    keys = ["driver_id", "activity_date_key"]
    o = L.offers_daily().filter(F.col("driver_id").isNotNull())
    b = L.bookings_daily().filter(F.col("driver_id").isNotNull())
    m = L.spine().join(o, keys, "left").join(b, keys, "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))

    def rate(num, den, guard):
        return F.when(z(guard) > 0, half_up_ratio(F.col(num), F.col(den), 2)).otherwise(0).cast("decimal(18,2)")

    return m.select(
        "driver_id", "activity_date_key",
        z("route_distance").cast("decimal(18,0)").alias("total_route_distance"),
        *[z(c).alias(c) for c in ("total_offers", "offers_accepted", "offers_cancelled", "offers_read",
                                  "total_bookings", "completed_trips", "driver_abort_count",
                                  "no_driver_found_count")],
        z("total_est_revenue").cast("decimal(18,2)").alias("total_est_revenue"),
        z("missing_driver_offers_records").alias("missing_driver_offers_records"),
        z("missing_driver_bookings_records").alias("missing_driver_bookings_records"),
        rate("offers_accepted", "total_offers", "total_offers").alias("offer_acceptance_rate"),
        rate("completed_trips", "total_bookings", "total_bookings").alias("booking_completion_rate"),
        rate("driver_abort_count", "total_bookings", "total_bookings").alias("driver_abort_rate"),
        rate("total_est_revenue", "completed_trips", "completed_trips").alias("avg_est_revenue_per_trip"))


def test_hot_driver_matches_joined_form(spark):
    """A third of all bookings and offers on one driver: the fused plan equals the joined form."""
    base = Layers(spark, SF_SMALL)
    hot = F.when(F.xxhash64("id") % 3 == 0, F.lit("1"))
    raw = {"bookings": base.raw_bookings().withColumn("id_driver", F.coalesce(hot, F.col("id_driver"))),
           "offers": base.raw_offers().withColumn("driverid", F.coalesce(hot, F.col("driverid")))}
    for L in (base, Layers(spark, SF_SMALL, raw=raw)):
        fused = L.agg_driver_activity().drop("activity_date")
        joined = _joined_form(L)
        assert fused.count() == joined.count()
        assert fused.exceptAll(joined).count() == 0 and joined.exceptAll(fused).count() == 0
    top = (Layers(spark, SF_SMALL, raw=raw).agg_driver_activity().groupBy("driver_id")
           .agg(F.sum("total_bookings").alias("n")).orderBy(F.desc("n")).first())
    assert top.driver_id == "1"
