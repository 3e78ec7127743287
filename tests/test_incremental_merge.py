"""The staged tables' merge: rows joined by id once, changes read from the files that the load wrote."""

import datetime as dt
import itertools
import os

from pyspark.sql import functions as F

from test_incremental import _booking, _driver, _loads, _offer, _raw
from tripwise.operators import staging
from tripwise.operators.dedup import latest_per_key, newer
from tripwise.plans.incremental import IncrementalModel


def test_newer_is_the_row_that_latest_per_key_takes(spark):
    ages, texts = (None, dt.datetime(2026, 5, 1), dt.datetime(2026, 5, 2)), (None, "", "b")
    rows = list(itertools.product(ages, texts, (None, True, False)))
    pairs = [(str(i), *row) for i, pair in enumerate(itertools.product(rows, rows)) for row in pair]
    kinds = "id string, load_tz timestamp, t string, f boolean"
    want = {r.id: tuple(r)[1:] for r in latest_per_key(spark.createDataFrame(pairs, kinds), "id").collect()}
    both = spark.createDataFrame([(a, b) for a, b in zip(pairs[::2], pairs[1::2])], f"a struct<{kinds.replace(' ', ':').replace(',:', ',')}>, "
                                 f"b struct<{kinds.replace(' ', ':').replace(',:', ',')}>")
    taken = both.select(F.when(newer("a", "b", ["id", "load_tz", "t", "f"], "id"), F.col("a")).otherwise(F.col("b")).alias("r")).select("r.*")
    assert {r.id: tuple(r)[1:] for r in taken.collect()} == want


def test_changes_come_from_the_tables_own_files(spark, scratch):
    loads = _loads(spark)
    model = IncrementalModel(spark, scratch, buckets=4)
    model.load_staging(loads[0], "l1")
    changed = model.load_staging(loads[1], "l2")["bookings"]
    rows = {r.key: (r.before and r.before.is_missing_driver, r.after.is_missing_driver) for r in changed.collect()}
    # b1 was sent again and its driver came, b5 got a valid status, b3 is new; b2 and b4 stay
    assert rows == {"b1": (True, False), "b3": (None, False), "b5": (False, False)}
    assert not os.path.exists(f"{scratch}/loads/_changes")
    # the load again: the same changes, and no version of its own
    version = model.staged["bookings"].version()
    again = model.load_staging(loads[1], "l2")["bookings"]
    assert {r.key for r in again.collect()} == set(rows) and model.staged["bookings"].version() == version
    assert model.staged["bookings"].read().columns == staging.clean_bookings(loads[0]["bookings"], model.valid("drivers")).columns


def test_a_reference_touches_buckets_that_the_load_brings_no_row_for(spark, scratch):
    model = IncrementalModel(spark, scratch, buckets=64)
    model.load_staging(_raw(spark, 1, [_driver("d1")], [_booking(f"b{i}", "d2") for i in range(20)], [_offer("o1", "b0", "d2")]), "l1")
    kept = model.staged["bookings"].folders()
    changed = model.load_staging(_raw(spark, 2, [_driver("d2")], [_booking("b0", "d2", "2021-06-04")], [_offer("o2", "b0", "d2")]), "l2")["bookings"]
    assert {r.key: r.after.is_missing_driver for r in changed.collect()} == {f"b{i}": False for i in range(20)}
    assert not set(kept.values()) & set(model.staged["bookings"].folders().values())
