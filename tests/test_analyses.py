"""Ratios, rounding and histogram edge cases on literal driver-day rows."""

from decimal import Decimal

from pyspark.sql import functions as F

from tripwise.functions.ratios import half_up_ratio
from tripwise.operators import analyses

AGG_SCHEMA = ("driver_id string, activity_date_key int, activity_date date, total_route_distance decimal(18,0), "
              "total_offers bigint, offers_accepted bigint, offers_cancelled bigint, offers_read bigint, "
              "total_bookings bigint, completed_trips bigint, driver_abort_count bigint, "
              "no_driver_found_count bigint, total_est_revenue decimal(18,2), "
              "missing_driver_offers_records bigint, missing_driver_bookings_records bigint, "
              "offer_acceptance_rate decimal(18,2), booking_completion_rate decimal(18,2), "
              "driver_abort_rate decimal(18,2), avg_est_revenue_per_trip decimal(18,2)")


def test_half_up(spark):
    df = spark.createDataFrame([(23, 40), (1, 8), (5, 0), (2, 3)], "a bigint, b bigint")
    got = [r[0] for r in df.select(half_up_ratio(F.col("a"), F.col("b"), 2)).collect()]
    assert got == [Decimal("0.58"), Decimal("0.13"), None, Decimal("0.67")]


def _agg(spark, rows):
    import datetime as dt
    full = []
    for driver, key, offers, acc, bookings, done, aborts, rev in rows:
        d = dt.date(key // 10000, key // 100 % 100, key % 100)
        acc_rate = Decimal(round(acc / offers, 2)) if offers else Decimal(0)
        full.append((driver, key, d, Decimal(0), offers, acc, 0, 0, bookings, done, aborts, 0, Decimal(rev), 0, 0,
                     acc_rate, Decimal(0), Decimal(0), Decimal(0)))
    return spark.createDataFrame(full, AGG_SCHEMA)


def test_summary_null_on_zero_denominator(spark):
    agg = _agg(spark, [("d1", 20210601, 40, 23, 0, 0, 0, "0"), ("d2", 20210601, 0, 0, 3, 1, 1, "10")])
    rows = {r.driver_id: r for r in analyses.driver_kpi_summary(agg).collect()}
    assert set(rows) == {"d1"}                                  # offerless days are left out
    assert rows["d1"].offer_acceptance_rate == Decimal("57.50")
    assert rows["d1"].booking_completion_rate is None and rows["d1"].avg_est_revenue_per_trip is None


def test_histogram_bins(spark):
    schema = "driver_id string, offer_acceptance_rate decimal(38,2), booking_completion_rate decimal(38,2), " \
             "driver_abort_rate decimal(38,2)"
    summary = spark.createDataFrame([("a", Decimal("0"), Decimal("50"), None),
                                     ("b", Decimal("100"), Decimal("50"), None),
                                     ("c", Decimal("5"), Decimal("50"), None)], schema)
    h = analyses.kpi_histogram(summary).collect()
    acc = {r.bin: r.driver_count for r in h if r.kpi == "acceptance_rate_pct"}
    assert len(acc) == 20 and acc[1] == 1 and acc[2] == 1 and acc[20] == 1 and sum(acc.values()) == 3
    comp = [r for r in h if r.kpi == "completion_rate_pct"]
    assert len(comp) == 1 and comp[0].bin == 1 and comp[0].driver_count == 3
    assert not [r for r in h if r.kpi == "abort_rate_pct"]


def test_segments_threshold_exact(spark):
    rows = []
    for i, key in enumerate((20210601, 20210602, 20210603)):
        rows.append(("d1", key, 0, 0, 10, 7, 3, "30"))          # 0.30 abort rate each day -> High Abort
    rows.append(("d2", 20210601, 0, 0, 10, 8, 2, "30"))
    agg = _agg(spark, rows).withColumn(
        "driver_abort_rate", (F.col("driver_abort_count") / F.col("total_bookings")).cast("decimal(18,2)"))
    seg = {r.segment: r for r in analyses.abort_segments(agg).collect()}
    assert seg["High Abort"].driver_count == 1 and seg["Reliable"].driver_count == 1
    assert seg["High Abort"].total_aborts == 9


def test_money_ratio_up_to_the_stored_limit(spark):
    """Fares of up to 36 whole digits, rounded once; compared with Python's exact decimals."""
    import random
    from decimal import ROUND_HALF_UP, Decimal, localcontext
    from tripwise.functions.ratios import count_ratio, money_ratio
    rnd = random.Random(7)
    most = Decimal("9" * 36 + ".99")
    rows = [(most, 1), (most, 7), (Decimal("0.05"), 2), (Decimal("1e35") + Decimal("0.04"), 8), (None, 3), (Decimal(5), None), (Decimal(5), 0)]
    rows += [(Decimal(rnd.randrange(10 ** e)) + Decimal(rnd.randrange(100)) / 100, rnd.randrange(1, 10 ** rnd.choice([1, 4, 18])))
             for e in (1, 9, 13, 15, 20, 21, 32, 36) for _ in range(60)]
    df = spark.createDataFrame(rows, "n decimal(38,2), d bigint")
    with localcontext() as exact:
        exact.prec = 90
        for scale in (2, 6):
            for r in df.select("n", "d", money_ratio(F.col("n"), F.col("d"), scale).alias("q")).collect():
                want = None if r.n is None or not r.d else (r.n / r.d).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)
                # what decimal(38, scale) has no room for is NULL
                assert r.q == (None if want is not None and want >= Decimal(10) ** (38 - scale) else want), r
    counts = spark.createDataFrame([(23, 40), (1, 3), (2, 3), (10 ** 15, 7), (0, 5)], "n bigint, d bigint")
    got = [str(r[0]) for r in counts.select(count_ratio(F.col("n"), F.col("d"), 2)).collect()]
    assert got == ["0.58", "0.33", "0.67", "142857142857142.86", "0.00"]
