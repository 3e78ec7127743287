"""CSV dialect, gzip, positional header, and the streaming incremental load."""

import gzip
import os


from pyspark.sql import functions as F

import pytest

from conftest import SF_SMALL
from tripwise.config import DEFAULT
from tripwise.plans.layers import Layers
from tripwise.sources.csv import read_raw_csv, write_raw_csv
from tripwise.streaming.ingest import run_ingest


def test_csv_dialect(spark, scratch):
    path = os.path.join(scratch, "drivers.csv.gz")
    text = ('ID,Land,Score,N,Registered,Mkt\n'
            '"1","France, Metropolitan","4.5","10","2021-06-01 08:00:00","true"\n'
            '2,"say ""hi""",,"","2021-06-01",no\n')
    with gzip.open(path, "wt") as f:
        f.write(text)
    rows = read_raw_csv(spark, path, "drivers", load_tz="2026-06-01 00:00:00").orderBy("id").collect()
    assert [r.id for r in rows] == ["1", "2"]
    assert rows[0].country == "France, Metropolitan" and rows[1].country == 'say "hi"'
    assert rows[1].rating is None and rows[1].rating_count is None      # empty and quoted empty -> NULL
    assert rows[0].is_processed is False and str(rows[0].load_tz) == "2026-06-01 00:00:00"


def test_csv_roundtrip_keeps_blanks(spark, scratch):
    raw = Layers(spark, SF_SMALL).raw_bookings()
    write_raw_csv(raw, os.path.join(scratch, "b"), "bookings")
    back = read_raw_csv(spark, os.path.join(scratch, "b"), "bookings", load_tz="2026-06-01 00:00:00")
    cols = ["id", "request_date", "status", "id_driver", "estimated_route_fare"]
    assert raw.select(cols).exceptAll(back.select(cols)).count() == 0


def test_streaming_two_batches_equal_full_load(spark, scratch):
    L = Layers(spark, SF_SMALL)
    L.stg_drivers().write.parquet(f"{scratch}/stg_drivers")
    write_raw_csv(L.raw_bookings().repartition(2), f"{scratch}/raw", "bookings", compression="gzip")
    kw = dict(cfg=DEFAULT, load_tz="2026-06-01 00:00:00", drivers_staged_path=f"{scratch}/stg_drivers", max_files_per_batch=1)
    run_ingest(spark, f"{scratch}/raw", "bookings", f"{scratch}/stg", f"{scratch}/ck", **kw)
    staged = spark.read.parquet(f"{scratch}/stg")
    assert staged.select("batch_id").distinct().count() == 2
    full = L.stg_bookings()
    got = staged.drop("load_run", "batch_id")
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
    # same checkpoint, no new files: nothing is loaded twice
    run_ingest(spark, f"{scratch}/raw", "bookings", f"{scratch}/stg", f"{scratch}/ck", **kw)
    assert spark.read.parquet(f"{scratch}/stg").count() == full.count()


def test_runner_from_csv_extracts(spark, scratch):
    """CSV extracts -> every layer written as a table -> same driver-day table as the lazy plan."""
    from tripwise.plans import runner
    from tripwise.sources.csv import read_raw_csv
    L = Layers(spark, SF_SMALL)
    for kind, df in (("drivers", L.raw_drivers()), ("bookings", L.raw_bookings()), ("offers", L.raw_offers())):
        write_raw_csv(df, f"{scratch}/csv/{kind}", kind, compression="gzip")
    paths = runner.run(spark, f"{scratch}/model", raw_csv=f"{scratch}/csv", load_tz="2026-06-01 00:00:00", as_of=DEFAULT.as_of)
    assert spark.read.parquet(paths["abort_segments"]).count() >= 1
    stored = spark.read.parquet(f"{runner.published(spark, f'{scratch}/model')}/agg_driver_activity")
    raw = {k: read_raw_csv(spark, f"{scratch}/csv/{k}", k, load_tz="2026-06-01 00:00:00")
           for k in ("drivers", "bookings", "offers")}
    lazy = Layers(spark, SF_SMALL, raw=raw).agg_driver_activity()
    assert stored.count() == lazy.count() > 0
    assert stored.exceptAll(lazy).count() == 0


def test_dimension_loads_each_staged_batch_once(spark, scratch):
    """raw CSV batches -> streaming staging -> ledger-driven SCD2 loads == the one-shot SCD2 result."""
    from tripwise.config import BATCH2_AS_OF, BATCH2_LOAD_TZ
    from tripwise.sources import fixtures
    from tripwise.streaming.dim_load import current_dimension, load_pending
    write_raw_csv(Layers(spark, SF_SMALL).raw_drivers(), f"{scratch}/src/b1", "drivers")
    # reference: the same extract through the lazy layers (one load time for all rows of the file)
    L = Layers(spark, SF_SMALL, raw={"drivers": read_raw_csv(spark, f"{scratch}/src/b1", "drivers",
                                                             load_tz="2026-06-01 00:00:00")})
    ingest = dict(checkpoint_path=f"{scratch}/ck", staged_path=f"{scratch}/stg", kind="drivers",
                  source_dir=f"{scratch}/src/*")
    run_ingest(spark, cfg=DEFAULT, load_tz="2026-06-01 00:00:00", **ingest)
    first = load_pending(spark, f"{scratch}/stg", f"{scratch}/dim", as_of=DEFAULT.as_of)
    assert first["applied"] and first["version"] == 1
    assert not load_pending(spark, f"{scratch}/stg", f"{scratch}/dim", as_of=DEFAULT.as_of)["applied"]
    write_raw_csv(fixtures.raw_drivers_batch2(L.valid_drivers()), f"{scratch}/src/b2", "drivers")
    run_ingest(spark, cfg=DEFAULT.with_(as_of=BATCH2_AS_OF), load_tz=BATCH2_LOAD_TZ, **ingest)
    second = load_pending(spark, f"{scratch}/stg", f"{scratch}/dim", as_of=BATCH2_AS_OF)
    assert second["version"] == 2 and second["batches"] == 1
    got, _ = current_dimension(spark, f"{scratch}/dim")
    want = L.scd2_batch2()["dim"]
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_streaming_offers_against_staged_references(spark, scratch):
    """Offer extracts streamed in two batches, checked against staged drivers and bookings tables."""
    L0 = Layers(spark, SF_SMALL)
    # all rows of one offer id in the same extract file, so per-batch dedup = full dedup
    write_raw_csv(L0.raw_offers().repartition(2, "id"), f"{scratch}/raw", "offers")
    ts = "2026-06-01 00:00:00"
    L = Layers(spark, SF_SMALL, raw={"offers": read_raw_csv(spark, f"{scratch}/raw", "offers", load_tz=ts)})
    L.stg_drivers().write.parquet(f"{scratch}/stg_drivers")
    L.stg_bookings().write.parquet(f"{scratch}/stg_bookings")
    run_ingest(spark, f"{scratch}/raw", "offers", f"{scratch}/stg", f"{scratch}/ck", cfg=DEFAULT, load_tz=ts,
               drivers_staged_path=f"{scratch}/stg_drivers", bookings_staged_path=f"{scratch}/stg_bookings",
               max_files_per_batch=1)
    got = spark.read.parquet(f"{scratch}/stg").drop("load_run", "batch_id")
    want = L.stg_offers()
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_latest_staged_across_loads(spark, scratch):
    """A booking re-sent in a later load: the accumulated staged table keeps both, the view the newest."""
    from tripwise.operators.staging import latest_staged
    from tripwise.sources.csv import with_load_defaults
    L = Layers(spark, SF_SMALL)
    raw = L.raw_bookings().drop("is_processed", "load_tz")
    first = with_load_defaults(raw, "2026-06-01 00:00:00")
    resent = with_load_defaults(raw.limit(5).withColumn("status", F.lit("DRIVER_ABORT")), "2026-06-02 00:00:00")
    from tripwise.operators import staging
    stg = (staging.clean_bookings(first, L.valid_drivers())
           .unionByName(staging.clean_bookings(resent, L.valid_drivers())))
    assert stg.count() == raw.count() + 5
    latest = latest_staged(stg, "bookings")
    assert latest.count() == raw.count()
    assert latest.filter(F.col("raw_load_tz") == F.lit("2026-06-02 00:00:00").cast("timestamp")) \
        .filter(F.col("booking_status") == "DRIVER_ABORT").count() == 5


def _driver(rating):
    return {"id": "d1", "date_registration": "2021-01-01 00:00:00", "driver_rating": rating, "rating_count": "5",
            "receive_marketing": "true", "country": "France"}


def test_pending_batches_keep_every_version_and_fresh_checkpoints_keep_staged_rows(spark, scratch):
    """Three extracts, the last two pending together; the third comes through a stream of its own."""
    from tripwise.sources.csv import RAW_COLUMNS
    from tripwise.streaming.dim_load import current_dimension, ledger, load_pending
    first = Layers(spark, SF_SMALL).raw_drivers().limit(1).collect()[0].asDict()
    rating = [c for c in RAW_COLUMNS["drivers"] if c.endswith("rating")][0]
    for n, (value, checkpoint) in enumerate((("4.0", "ck1"), ("4.5", "ck1"), ("4.8", "ck2")), start=1):
        row = {**first, **{k: v for k, v in _driver(value).items() if k in first}, rating: value}
        df = spark.createDataFrame([tuple(row[c] for c in RAW_COLUMNS["drivers"])], ", ".join(f"{c} string" for c in RAW_COLUMNS["drivers"]))
        write_raw_csv(df, f"{scratch}/src{checkpoint}/b{n}", "drivers")
        run_ingest(spark, f"{scratch}/src{checkpoint}/*", "drivers", f"{scratch}/stg", f"{scratch}/{checkpoint}", cfg=DEFAULT,
                   load_tz=f"2026-05-0{n} 00:00:00")
        if n == 1:
            load_pending(spark, f"{scratch}/stg", f"{scratch}/dim", as_of=DEFAULT.as_of)
    assert spark.read.parquet(f"{scratch}/stg").count() == 3
    assert load_pending(spark, f"{scratch}/stg", f"{scratch}/dim", as_of=DEFAULT.as_of)["batches"] == 2
    dim, version = current_dimension(spark, f"{scratch}/dim")
    assert version == 3 and ledger(spark, f"{scratch}/dim").count() == 3
    got = [(float(r.driver_rating), r.is_active) for r in dim.orderBy("start_eff_ts").collect()]
    assert got == [(4.0, False), (4.5, False), (4.8, True)]


def test_unreadable_ledger_is_an_error(spark, scratch):
    from tripwise.streaming.dim_load import current_dimension
    assert current_dimension(spark, f"{scratch}/none")[1] == 0
    os.makedirs(f"{scratch}/dim/_ledger")
    with open(f"{scratch}/dim/_ledger/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        current_dimension(spark, f"{scratch}/dim")


def test_large_fare_reaches_the_driver_day_table(spark):
    """Fares may have 36 whole digits; nothing on the way narrows them."""
    from decimal import Decimal
    L = Layers(spark, SF_SMALL)
    raw = L.raw_bookings()
    big = (raw.filter("upper(trim(status)) = 'SUCCESS' AND id_driver IS NOT NULL AND id_driver <> 'null'").limit(1)
           .withColumn("id", F.lit("big")).withColumn("request_date", F.lit("2021-06-03 10:00:00"))
           .withColumn("estimated_route_fare", F.lit("100000000000000000.00")))
    agg = Layers(spark, SF_SMALL, raw={"bookings": raw.unionByName(big)}).agg_driver_activity()
    top = agg.agg(F.max("total_est_revenue").alias("r"), F.max("avg_est_revenue_per_trip").alias("a")).first()
    assert top.r >= Decimal("1e17") and top.a > Decimal("1e16")


def test_second_run_keeps_versions_and_a_failed_run_leaves_the_last(spark, scratch, monkeypatch):
    """Two runs into one folder: the dimension keeps the first run's versions; a run that fails midway is not seen."""
    from tripwise.operators import analyses
    from tripwise.plans import runner
    L = Layers(spark, SF_SMALL)
    for n, drivers in enumerate((L.raw_drivers(), L.raw_drivers_batch2()), 1):
        for kind, df in (("drivers", drivers), ("bookings", L.raw_bookings().limit(200)), ("offers", L.raw_offers().limit(200))):
            write_raw_csv(df, f"{scratch}/csv{n}/{kind}", kind)
    out = f"{scratch}/model"
    assert runner.published(spark, out) is None
    runner.run(spark, out, raw_csv=f"{scratch}/csv1", load_tz="2026-06-01 00:00:00", as_of=DEFAULT.as_of, run_id="one")
    first = runner.published(spark, out)
    assert first.endswith("runs/one")

    def broken(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(analyses, "daily_trend", broken)
        with pytest.raises(RuntimeError):
            runner.run(spark, out, raw_csv=f"{scratch}/csv2", load_tz="2026-06-02 00:00:00", as_of="2026-06-02 00:00:00", run_id="two")
    assert runner.published(spark, out) == first and spark.read.parquet(f"{first}/analyses/daily_trend").count() > 0
    runner.run(spark, out, raw_csv=f"{scratch}/csv2", load_tz="2026-06-02 00:00:00", as_of="2026-06-02 00:00:00", run_id="two")
    assert runner.published(spark, out).endswith("runs/two")
    from tripwise.streaming.dim_load import current_dimension, ledger
    dim, version = current_dimension(spark, f"{out}/history/dim_drivers")
    assert version == 2 and ledger(spark, f"{out}/history/dim_drivers").count() == 2
    assert dim.filter("NOT is_active").count() > 0 and dim.groupBy("driver_id").count().filter("count = 2").count() > 0


def test_versioned_table(spark, scratch, monkeypatch):
    from tripwise.sources.versioned import VersionedTable, read_table, replace_table
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    t = VersionedTable(spark, f"{scratch}/t", F.col("day"))
    assert t.version() == 0 and t.read() is None
    df = lambda *r: spark.createDataFrame(list(r), "day int, x string")
    t.write(df((1, "a"), (2, "b"), (3, "c")))
    before = t.folders()
    t.write(df((2, "B"), (4, "d")), replaces=["2", "3"], label="second")
    assert rows(t.read()) == [(1, "a"), (2, "B"), (4, "d")] and t.version() == 2 and t.has("second") and not t.has("first")
    assert t.folders()["1"] == before["1"] and t.folders()["2"] != before["2"]
    assert rows(t.read(["2", "9"])) == [(2, "B")]
    # a run that fails before the version is written leaves the last one
    monkeypatch.setattr(VersionedTable, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        t.write(df((1, "z")))
    assert rows(t.read()) == [(1, "a"), (2, "B"), (4, "d")]
    monkeypatch.undo()
    t.write(df(), replaces=None)
    assert t.version() == 3 and rows(t.read()) == []
    with pytest.raises(ValueError):
        VersionedTable(spark, f"{scratch}/u", F.col("x")).write(df((1, "a/b")))
    with pytest.raises(FileNotFoundError):
        read_table(spark, f"{scratch}/none")
    replace_table(df((1, "a")), f"{scratch}/full")
    replace_table(read_table(spark, f"{scratch}/full").withColumn("x", F.lit("new")), f"{scratch}/full")  # from its own rows
    assert rows(read_table(spark, f"{scratch}/full")) == [(1, "new")]


def test_landing_loads_a_file_once(spark, scratch):
    from tripwise.sources.landing import Landing
    L = Layers(spark, SF_SMALL)
    write_raw_csv(L.raw_bookings().limit(50).coalesce(1), f"{scratch}/a", "bookings", compression="gzip")
    write_raw_csv(L.raw_bookings().limit(70).coalesce(1), f"{scratch}/b", "bookings")
    write_raw_csv(L.raw_bookings().limit(50).coalesce(1), f"{scratch}/copy", "bookings")
    landing = Landing(spark, f"{scratch}/raw", "bookings")
    with pytest.raises(FileNotFoundError):
        landing.raw()
    assert landing.land(f"{scratch}/a", "one", "2026-06-01 00:00:00") == 1
    assert landing.land(f"{scratch}/a", "one", "2026-06-01 00:00:00") == 0
    # the same content under other names, packed or not, is known; only the new file is loaded
    assert landing.land([f"{scratch}/copy", f"{scratch}/b"], "two", "2026-06-02 00:00:00") == 1
    assert landing.land(f"{scratch}/copy", "three", "2026-06-03 00:00:00") == 0
    assert landing.manifest().count() == 2
    assert landing.raw().count() == 120 and landing.raw(["one"]).count() == 50
    assert {str(r[0]) for r in landing.raw().select("load_tz").distinct().collect()} == {"2026-06-01 00:00:00", "2026-06-02 00:00:00"}
