"""What a load leaves on the disks: shuffle files, cleaned batches, rows before."""

import glob
import os

from pyspark.sql import functions as F

from test_incremental import _loads, _same
from tripwise.plans import incremental
from tripwise.plans.incremental import IncrementalModel
from tripwise.plans.layers import Layers
from tripwise.session import FREE_SHUFFLES


def test_every_bucket_and_part_alone_gives_the_same_tables(spark, scratch, monkeypatch):
    loads = _loads(spark)[:2]
    freed = []
    prepare = incremental.VersionedTable.prepare

    def watched(table, df):
        freed.append(spark.conf.get(FREE_SHUFFLES))
        return prepare(table, df)

    monkeypatch.setattr(incremental.VersionedTable, "prepare", watched)
    monkeypatch.setattr(incremental, "_groups", lambda parts, size: [[p] for p in sorted(parts)])
    model = IncrementalModel(spark, scratch, buckets=2)
    before = spark.conf.get(FREE_SHUFFLES)
    for n, load in enumerate(loads):
        model.load(load, f"l{n}")
    assert spark.conf.get(FREE_SHUFFLES) == before
    raw = {k: loads[0][k].unionByName(loads[1][k]) for k in loads[0]}
    full = Layers(spark, "", raw=raw)
    assert _same(model.staged["bookings"].read(), full.stg_bookings()) and _same(model.staged["offers"].read(), full.stg_offers())
    assert _same(model.agg_driver_activity(), full.agg_driver_activity())
    # more writes than the one a table and load
    assert len(freed) > 12 and set(freed) == {"true"}


def test_groups_are_as_large_as_their_files(monkeypatch):
    monkeypatch.setattr(incremental, "AT_ONCE", 10)
    assert incremental._groups(["1", "0", "2", "3"], 20) == [["0", "2"], ["1", "3"]]
    assert incremental._groups(["1", "0"], 1000) == [["0"], ["1"]] and incremental._groups(["1", None], 10) == [[None, "1"]]
    assert incremental._groups([], 5) == []


def test_merged_batches_go_and_flags_alone_are_no_second_row(spark, scratch):
    loads = _loads(spark)
    model = IncrementalModel(spark, scratch, buckets=4)
    model.load_staging(loads[0], "l1")
    changed = model.load_staging(loads[1], "l2")["offers"]
    assert not glob.glob(f"{scratch}/loads/bookings/load_run*") and not glob.glob(f"{scratch}/loads/offers/load_run*")
    assert os.path.isdir(f"{scratch}/loads/drivers")
    rows = {r.key: (r.before, r.after) for r in changed.collect()}
    assert rows["o4"][0] is None
    # o1's driver and o2's booking came; everything else of the row before is that of the row
    for key, flag in (("o1", "is_missing_driver"), ("o2", "is_missing_booking")):
        before, after = (r.asDict() for r in rows[key])
        assert before.pop(flag) is True and after.pop(flag) is False and before == after
    files = model.staged["offers"].written("l2")
    table = spark.read.parquet(*[f"{scratch}/staged/offers/{f}" for f in files.values()])
    assert table.filter(F.col("_before").isNotNull()).count() == 0 and table.filter(F.col("_was").isNotNull()).count() == len(rows) - 1
