"""The model kept up to date load by load, instead of being rebuilt.

One load (raw drivers, bookings, offers) goes through these steps, each of which
reads and writes only what the load changes:

1. **Cleaned load**: the batch is cleaned as in a full run and stored under its id, until
   it is merged (drivers stay, the dimension reads them).
2. **Keyed staging** (Q3, S6): the staged tables hold one row per id, in buckets by the
   id's hash; the load rewrites the buckets that its ids fall into, the newest row wins.
   A row that the load changes is written with what it was before (where a reference flag
   alone changed, with that flag), so that the later steps
   read the changes from the same files and rows are joined by id once.
3. **Late references** (J2, J3): where an id becomes valid, or no longer is, the rows
   that refer to it get their flag anew; nothing else is checked again.
4. **Dimension**: the load's drivers through ``dim_load.load_pending``.
5. **Facts** (B1, B2), in parts by month or day: the parts of changed rows, and those with
   rows of drivers that got a new version, are rewritten.
6. **Daily sums** (A2), in the same parts: those whose facts were rewritten.  The dense
   driver-day table is expanded from them when it is read.

Steps 1, 2, 5 and 6 take some buckets or parts after another, as many at once as have ``AT_ONCE``
bytes in their files, and Spark removes each query's shuffle files when it ends: what a load
shuffles lies on the disks for some of its rows only.

Tables are published version by version (``sources.versioned``) with the load's id, and
what a load changes is stored before it is published.  A load that failed is run again
with the same id: steps that were published are not repeated, the others are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, EngagementConfig
from ..operators import activity, facts, scd2, staging
from ..operators.calendar import date_key_of
from ..operators.dedup import newer
from ..session import delete_folder, prepare, shuffles_freed
from ..sources.versioned import VersionedTable
from ..streaming.dim_load import ledger, load_pending, stage_batch

DAY = {"bookings": "booking_request_date_key", "offers": "offer_created_date_key"}
LOCAL_DATE = {"bookings": "booking_request_local_date", "offers": "offer_created_local_date"}

#: columns of the staged tables' files beside the table's own: whether the load that wrote a row changed it, the row before where
#: the load brought another, and else the reference flags before
_CHANGED, _BEFORE, _WAS = "_changed", "_before", "_was"
#: bytes of the files whose rows are cleaned, merged or summed at once
AT_ONCE = 2 << 30


def _bytes(df: DataFrame | None) -> int:
    """The size of the files behind ``df``; sources of unknown size count as none."""
    if df is None:
        return 0
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < 1 << 60)


def _groups(parts: Iterable[str | None], size: int) -> list[list[str | None]]:
    """The parts dealt into groups of about ``AT_ONCE`` bytes, if all have ``size``."""
    parts = sorted(parts, key=lambda p: p or "")
    n = max(1, min(len(parts), -(-size // AT_ONCE)))
    return [parts[i::n] for i in range(n)] if parts else []


def _among(part: F.Column, parts: list[str | None]) -> F.Column:
    return F.coalesce(part.cast("string"), F.lit("")).isin([p or "" for p in parts])


class IncrementalModel:
    """The staged tables, dimension, facts and daily sums under ``root``, a folder that all executors share.

    ``buckets`` (of staged ids) and ``parts`` ("month" or "day", of facts and sums) set how much a load rewrites
    against how many files there are; both are fixed for the life of a model.
    """

    def __init__(self, spark: SparkSession, root: str, cfg: EngagementConfig = DEFAULT, buckets: int = 16, parts: str = "month"):
        if not cfg.extends_calendar or cfg.literal_scd2_compare:
            raise ValueError("the incremental model has no literal variants")
        self.spark, self.root, self.cfg, self.buckets = prepare(spark), root.rstrip("/"), cfg, buckets
        self.staged = {kind: VersionedTable(spark, f"{self.root}/staged/{kind}", F.pmod(F.xxhash64(key), F.lit(buckets)))
                       for kind, key in staging.STAGED_KEYS.items()}
        self._of_day = {"month": 100, "day": 1}[parts]
        self.facts = {kind: VersionedTable(spark, f"{self.root}/facts/{kind}", self._part(F.col(day))) for kind, day in DAY.items()}
        self.daily = VersionedTable(spark, f"{self.root}/daily", self._part(F.col("activity_date_key")))

    def _part(self, day_key: F.Column) -> F.Column:
        return F.floor(day_key / self._of_day).cast("int")

    # ------------------------------------------------------------------ staging
    def valid(self, kind: str) -> DataFrame:
        return {"drivers": staging.valid_drivers, "bookings": staging.valid_bookings,
                "offers": staging.valid_offers}[kind](self.staged[kind].read())

    def _batch(self, kind: str, rows: DataFrame, load_run: str, n: int) -> tuple[DataFrame, str]:
        path = f"{self.root}/loads/{kind}"
        stage_batch(rows, path, load_run, n)
        folder = f"{path}/load_run={load_run}/batch_id={n}"
        try:
            return self.spark.read.schema(rows.schema).parquet(folder), folder
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], rows.schema), folder  # buckets that references alone touch

    def _merge(self, kind: str, raw: DataFrame, clean: Callable[[DataFrame], DataFrame], load_run: str,
               references: dict[str, tuple[str, DataFrame]]) -> DataFrame:
        """Take a raw load, which ``clean`` makes staged rows of, into the staged table; returns the changed rows: key, ``before`` and ``after``.

        ``references`` give, by foreign key, the flag to renew and the ids whose validity the load has changed.
        """
        table, key = self.staged[kind], staging.STAGED_KEYS[kind]
        if not table.has(load_run):
            new: dict[str, str] = {}
            of_raw = F.pmod(F.xxhash64("id"), F.lit(self.buckets))
            buckets = self._touched(kind, raw, of_raw, references)
            # the dimension takes a load's drivers as one batch
            groups = [sorted(buckets)] if kind == "drivers" else _groups(buckets, _bytes(raw) + _bytes(table.read(buckets)))
            schema = clean(raw).schema
            for n, group in enumerate(groups or [[]]):
                some = raw if len(groups) <= 1 else raw.filter(_among(of_raw, group))
                batch, folder = self._batch(kind, clean(some), load_run, n)
                new |= table.prepare(self._merged(kind, batch, group, references))
                if kind != "drivers":
                    delete_folder(self.spark, folder)
            table.publish(new, schema, buckets, load_run)
            if kind != "drivers":
                delete_folder(self.spark, f"{self.root}/loads/{kind}/load_run={load_run}")
        schema = table.schema()
        written = table.read_folders(table.written(load_run), T.StructType([
            *schema, T.StructField(_CHANGED, T.BooleanType()), T.StructField(_BEFORE, schema), T.StructField(_WAS, T.ArrayType(T.BooleanType()))]))
        # rows of this load that are new have no row before
        before = F.coalesce(F.col(_BEFORE), F.when(F.col(_WAS).isNotNull(), self._with_flags(F.col, schema.names, references)))
        return written.filter(_CHANGED).select(F.col(key).alias("key"), before.alias("before"), F.struct(*schema.names).alias("after"))

    @staticmethod
    def _with_flags(of: Callable[[str], F.Column], names: list[str], references: dict[str, tuple[str, DataFrame]]) -> F.Column:
        """A row of these columns with the reference flags that ``_WAS`` has."""
        flags = [flag for flag, _ in references.values()]
        return F.struct(*[(F.col(_WAS)[flags.index(c)] if c in flags else of(c)).alias(c) for c in names])

    def _touched(self, kind: str, raw: DataFrame, of_raw: F.Column, references: dict[str, tuple[str, DataFrame]]) -> list[str]:
        """The buckets that a load rewrites."""
        table = self.staged[kind]
        # at most one row a bucket
        buckets = {r.part for r in staging.unprocessed(raw).select(of_raw.cast("string").alias("part")).distinct().collect()}
        others = set(table.folders()) - buckets
        if others and references:
            # where the load brings no row, a bucket is touched by references that it changes
            rest = table.read(others)
            found = [rest.join(ids.select(F.col("id").alias(fk)), fk, "left_semi").select(table.part.alias("part")) for fk, (_, ids) in references.items()]
            buckets |= {r.part for r in reduce(DataFrame.unionByName, found).distinct().collect()}
        return sorted(buckets)

    def _merged(self, kind: str, batch: DataFrame, buckets: list[str], references: dict[str, tuple[str, DataFrame]]) -> DataFrame:
        """The rows of these buckets, all that the batch has rows of among them; each says whether the load changed it, and from what."""
        table, key = self.staged[kind], staging.STAGED_KEYS[kind]
        names, row_type = batch.columns, F.struct(*batch.columns)
        none = F.lit(None).cast(batch.select(row_type.alias("r")).schema["r"].dataType)
        before = table.read(buckets)
        if before is None:
            return batch.withColumns({_CHANGED: F.lit(True), _BEFORE: none, _WAS: F.lit(None).cast("array<boolean>")})
        flags = [flag for flag, _ in references.values()]
        renewed = before.select(*names, F.array(*flags).cast("array<boolean>").alias(_WAS))
        for fk, (flag, ids) in references.items():
            again = ids.select(F.col("id").alias("_id"), F.col("valid").alias("_valid"))
            renewed = (renewed.join(again, facts.spread(fk, key) == F.col("_id"), "left")
                       .withColumn(flag, F.when(F.col("_id").isNotNull(), ~F.col("_valid")).otherwise(F.col(flag)))
                       .drop("_id", "_valid"))
        # one row per key on both sides; of the two the one that ``latest_per_key`` takes
        old = renewed.select(F.col(key).alias("_key"), F.struct(*names).alias("_old"), _WAS)
        new = batch.select(F.col(key).alias("_new_key"), row_type.alias("_new"))
        both = old.join(new, F.col("_key").eqNullSafe(F.col("_new_key")), "full_outer")
        takes_new = F.col("_new").isNotNull() & (F.col("_old").isNull() | newer("_new", "_old", names, key, "raw_load_tz"))
        both = both.withColumn("_takes_new", F.coalesce(takes_new, F.lit(False)))
        row = F.when(F.col("_takes_new"), F.col("_new")).otherwise(F.col("_old"))
        was = F.when(F.col("_old").isNotNull(), self._with_flags(lambda c: F.col(f"_old.{c}"), names, references))
        both = both.select(row.alias("_row"), was.alias(_BEFORE), _WAS, "_takes_new").withColumn(_CHANGED, ~F.col("_row").eqNullSafe(F.col(_BEFORE)))
        return both.select("_row.*", _CHANGED, F.when(F.col(_CHANGED) & F.col("_takes_new"), F.col(_BEFORE)).alias(_BEFORE),
                           F.when(F.col(_CHANGED) & ~F.col("_takes_new"), F.col(_WAS)).alias(_WAS))

    @staticmethod
    def _validity(changed: DataFrame) -> DataFrame:
        """(id, valid) of the ids whose validity has changed."""
        was, now = (F.coalesce(F.col(f"{side}.is_valid"), F.lit(False)) for side in ("before", "after"))
        return changed.filter(was != now).select(F.col("key").alias("id"), now.alias("valid"))

    # ------------------------------------------------------------------ dimension
    def dim_drivers(self) -> DataFrame:
        return self._dimension(F.lit(True))

    def _dimension(self, where: F.Column) -> DataFrame:
        last = ledger(self.spark, f"{self.root}/dim").filter(where).orderBy(F.col("version").desc()).limit(1).collect()
        return self.spark.read.parquet(f"{self.root}/dim/{last[0].folder}") if last else scd2.empty_dim(self.spark)

    def _new_versions(self, load_run: str) -> DataFrame:
        """Drivers that got a version by this load."""
        own = ledger(self.spark, f"{self.root}/dim").filter(F.col("load_run") == load_run).first()
        before = self._dimension(F.col("version") < own.version).select("dim_driver_id")
        return (self._dimension(F.col("version") == own.version).join(before, "dim_driver_id", "left_anti")
                .select("driver_id").distinct())

    # ------------------------------------------------------------------ facts
    def _fact_rows(self, kind: str, rows: DataFrame, active: DataFrame) -> DataFrame:
        if kind == "bookings":
            return facts.fact_bookings(rows, active, None)
        return facts.fact_offers(rows, None, active, None, staged_check=True)

    def _update_facts(self, kind: str, changed: DataFrame, drivers: DataFrame, active: DataFrame, load_run: str) -> list[str]:
        """Rewrite the parts of the facts that the load touches; returns these parts."""
        table, key, day = self.facts[kind], staging.STAGED_KEYS[kind], DAY[kind]
        current = table.read()
        day_of = {side: date_key_of(F.col(f"{side}.{LOCAL_DATE[kind]}")) for side in ("before", "after")}
        days = [changed.filter(f"{side}.is_valid").select(at.alias("day")) for side, at in day_of.items()]
        if current is not None:
            days.append(current.join(drivers, "driver_id", "left_semi").select(F.col(day).alias("day")))
        parts = reduce(DataFrame.unionByName, days).select(self._part(F.col("day")).cast("string").alias("part")).distinct()
        touched = [r.part for r in parts.collect()]  # at most one row a part
        if touched and not table.has(load_run):
            new: dict[str, str] = {}
            groups = _groups(touched, _bytes(changed) + _bytes(current))
            for group in groups:
                # a changed row leaves the part that it was in, and comes into the one that it is in
                was, now = (changed.filter(f"{side}.is_valid").filter(F.lit(True) if len(groups) == 1 else _among(self._part(at), group))
                            for side, at in day_of.items())
                rows = self._fact_rows(kind, now.select("after.*"), active)
                if current is not None:
                    kept = table.read(group).join(was.select(F.col("key").alias(key)), key, "left_anti").drop("dim_driver_id", "is_missing_driver")
                    rows = facts.with_driver_version(kept, active, key).select(*rows.columns).unionByName(rows)
                new |= table.prepare(rows)
            table.publish(new, rows.schema, touched, load_run)
        return touched

    # ------------------------------------------------------------------ one load
    def load_staging(self, raw: dict[str, DataFrame], load_run: str, as_of: str | None = None) -> dict[str, DataFrame]:
        """Steps 1 to 3; returns the changed rows by table."""
        cfg = self.cfg.with_(as_of=as_of) if as_of else self.cfg
        with shuffles_freed(self.spark):
            drivers = self._merge("drivers", raw["drivers"], lambda rows: staging.clean_drivers(rows, cfg), load_run, {})
            valid_drivers, driver_ids = self.valid("drivers"), self._validity(drivers)
            bookings = self._merge("bookings", raw["bookings"], lambda rows: staging.clean_bookings(rows, valid_drivers, cfg), load_run,
                                   {"driver_id": ("is_missing_driver", driver_ids)})
            valid_bookings, booking_ids = self.valid("bookings"), self._validity(bookings)
            offers = self._merge("offers", raw["offers"], lambda rows: staging.clean_offers(rows, valid_bookings, valid_drivers, cfg), load_run,
                                 {"driver_id": ("is_missing_driver", driver_ids), "booking_id": ("is_missing_booking", booking_ids)})
        return {"bookings": bookings, "offers": offers}

    def load(self, raw: dict[str, DataFrame], load_run: str, as_of: str | None = None) -> None:
        """Take one load of raw drivers, bookings and offers into all tables; with the same id again it changes nothing."""
        changes = self.load_staging(raw, load_run, as_of)
        with shuffles_freed(self.spark):
            self._load_model(changes, load_run, as_of)

    def _load_model(self, changes: dict[str, DataFrame], load_run: str, as_of: str | None) -> None:
        """Steps 4 to 6."""
        load_pending(self.spark, f"{self.root}/loads/drivers", f"{self.root}/dim", as_of or self.cfg.as_of, self.cfg)
        active = self.dim_drivers().filter("is_active")
        new_versions = self._new_versions(load_run)
        touched = set()
        for kind, changed in changes.items():
            touched |= set(self._update_facts(kind, changed, new_versions, active, load_run))
        if touched and not self.daily.has(load_run):
            empty = {kind: self._fact_rows(kind, self.valid(kind).limit(0), active) for kind in ("offers", "bookings")}
            new: dict[str, str] = {}
            for group in _groups(touched, sum(_bytes(self.facts[kind].read(touched)) for kind in empty)):
                fo, fb = (empty[kind] if table is None else table for kind, table in ((kind, self.facts[kind].read(group)) for kind in empty))
                sums = activity.daily_sums(fo, fb)
                new |= self.daily.prepare(sums)
            self.daily.publish(new, sums.schema, touched, load_run)

    # ------------------------------------------------------------------ results
    def fact_bookings(self) -> DataFrame:
        return self.facts["bookings"].read()

    def fact_offers(self) -> DataFrame:
        return self.facts["offers"].read()

    def agg_driver_activity(self) -> DataFrame:
        """The dense driver-day table of the window."""
        days = self.cfg.window_day_keys()
        daily = self.daily.read({str(k // self._of_day) for k in days}).filter(F.col("activity_date_key").between(days[0], days[-1]))
        registered = activity.registered_by_window_end(self.dim_drivers().filter("is_active"), self.cfg)
        return activity.dense_activity(daily, registered.select("driver_id"), self.cfg)
