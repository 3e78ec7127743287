"""The layered model: raw -> staging -> dimensions -> facts -> driver-day -> analyses.

``Layers`` wires the operators together for one input folder and one config.
Each layer is built once per instance (memoised).  Two modes:

* lazy (default): layers are composed into one logical plan per result, so
  Catalyst prunes columns / pushes filters across layers and AQE re-plans at
  runtime; identical sub-plans inside one query share one exchange.
* ``store=<folder>``: each layer is written as parquet under ``store`` (a shared
  path, e.g. the cluster's checkpoint folder) and read back, so downstream
  layers start from a short lineage and a lost executor re-reads files
  instead of recomputing the chain -- the shape of a production run.

With ``history=<folder>`` the driver dimension is the one kept there over runs: this
run's staged drivers become one more load (``load_run``) of it, and every earlier
version stays.  Without, the dimension begins with this run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..config import BATCH2_AS_OF, DEFAULT, EngagementConfig
from ..operators import activity, analyses, calendar, facts, scd2, staging
from ..session import cut_lineage, prepare
from ..sources import fixtures
from ..streaming.dim_load import current_dimension, load_pending, stage_batch


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str, cfg: EngagementConfig = DEFAULT,
                 store: str | None = None, raw: dict[str, DataFrame] | None = None,
                 history: str | None = None, load_run: str | None = None):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self.cfg = cfg
        self.store = store.rstrip("/") if store else None
        self.history = history.rstrip("/") if history else None
        self.load_run = load_run
        self._raw = raw or {}
        self._memo: dict[str, DataFrame] = {}
        self._ccfg: EngagementConfig | None = None

    @property
    def ccfg(self) -> EngagementConfig:
        """Config with the calendar resolved: all dates the rules admit, and the window (D5, Q6); no data is read."""
        if self._ccfg is None:
            self._ccfg = self.cfg.with_calendar()
        return self._ccfg

    def _key_calendar(self) -> DataFrame | None:
        """The calendar that dates are looked up in; None where the key is arithmetic (see ``with_date_key``)."""
        return None if self.cfg.extends_calendar else self.dim_date()

    # ------------------------------------------------------------------ plumbing
    def _layer(self, name: str, build, materialize: bool = True, by_day: str | None = None) -> DataFrame:
        """Build (and in store mode write + re-read) one layer.

        ``by_day`` names a fact table's day column: each file is sorted by (day,
        driver), so parquet row-group statistics skip out-of-window rows.  The
        layout is the same at every size and needs no shuffle or counting pass.
        """
        if name not in self._memo:
            df = build()
            if self.store and materialize:
                path = f"{self.store}/{name}"
                if by_day:
                    df = df.sortWithinPartitions(by_day, "driver_id")
                df.write.mode("overwrite").parquet(path)
                df = self.spark.read.parquet(path).select(*df.columns)
            self._memo[name] = df
        return self._memo[name]

    # ------------------------------------------------------------------ raw
    def _raw_or(self, key: str, make) -> DataFrame:
        given = self._raw.get(key)
        return given if given is not None else make(self.spark, self.sf_dir)

    def raw_drivers(self) -> DataFrame:
        return self._layer("raw_drivers", lambda: self._raw_or("drivers", fixtures.raw_drivers), materialize=False)

    def raw_bookings(self) -> DataFrame:
        return self._layer("raw_bookings", lambda: self._raw_or("bookings", fixtures.raw_bookings), materialize=False)

    def raw_offers(self) -> DataFrame:
        return self._layer("raw_offers", lambda: self._raw_or("offers", fixtures.raw_offers), materialize=False)

    # ------------------------------------------------------------------ staging
    def stg_drivers(self) -> DataFrame:
        return self._layer("stg_drivers", lambda: staging.clean_drivers(self.raw_drivers(), self.cfg))

    def valid_drivers(self) -> DataFrame:
        return staging.valid_drivers(self.stg_drivers())

    def stg_bookings(self) -> DataFrame:
        return self._layer("stg_bookings", lambda: staging.clean_bookings(
            self.raw_bookings(), self.valid_drivers(), self.cfg))

    def valid_bookings(self) -> DataFrame:
        return staging.valid_bookings(self.stg_bookings())

    def stg_offers(self) -> DataFrame:
        return self._layer("stg_offers", lambda: staging.clean_offers(
            self.raw_offers(), self.valid_bookings(), self.valid_drivers(), self.cfg))

    def valid_offers(self) -> DataFrame:
        return staging.valid_offers(self.stg_offers())

    # ------------------------------------------------------------------ dimensions
    def dim_date(self) -> DataFrame:
        return self._layer("dim_date", lambda: calendar.dim_date(self.spark, self.ccfg), materialize=False)

    def scd2_batch1(self) -> dict[str, DataFrame]:
        if "scd2_batch1" not in self._memo:
            self._memo["scd2_batch1"] = scd2.apply_batch(scd2.empty_dim(self.spark), self.valid_drivers(),
                                                         self.cfg.as_of, self.cfg)
        return self._memo["scd2_batch1"]

    def _load_history(self) -> DataFrame:
        stage_batch(self.stg_drivers(), f"{self.history}/staged_drivers", self.load_run or uuid.uuid4().hex, 0)
        load_pending(self.spark, f"{self.history}/staged_drivers", f"{self.history}/dim_drivers", self.cfg.as_of, self.cfg)
        return current_dimension(self.spark, f"{self.history}/dim_drivers")[0]

    def dim_drivers(self) -> DataFrame:
        if self.history:
            return self._layer("dim_drivers", self._load_history, materialize=False)
        # the dimension is a stored table: cut its lineage even in lazy mode
        return self._layer("dim_drivers", lambda: self._stored(self.scd2_batch1()["dim"]))

    def _stored(self, df: DataFrame) -> DataFrame:
        return df if self.store else cut_lineage(df)

    def dim_drivers_active(self) -> DataFrame:
        return scd2.active_view(self.dim_drivers(), self._key_calendar(), self.cfg)

    # second driver batch on top of the first (SCD2 change handling)
    def raw_drivers_batch2(self) -> DataFrame:
        return self._layer("raw_drivers_batch2", lambda: fixtures.raw_drivers_batch2(self.valid_drivers()),
                           materialize=False)

    def valid_drivers_batch2(self) -> DataFrame:
        return self._layer("valid_drivers_batch2", lambda: staging.valid_drivers(staging.clean_drivers(
            self.raw_drivers_batch2(), self.cfg.with_(as_of=BATCH2_AS_OF))))

    def raw_drivers_batch3(self) -> DataFrame:
        return self._layer("raw_drivers_batch3", lambda: fixtures.raw_drivers_batch3(self.valid_drivers_batch2()),
                           materialize=False)

    def scd2_batch2(self) -> dict[str, DataFrame]:
        if "scd2_batch2" not in self._memo:
            self._memo["scd2_batch2"] = scd2.apply_batch(self.dim_drivers(), self.valid_drivers_batch2(),
                                                         BATCH2_AS_OF, self.cfg)
        return self._memo["scd2_batch2"]

    def new_drivers_batch2(self) -> DataFrame:
        return scd2.new_drivers(self.dim_drivers(), self.valid_drivers_batch2(), self.cfg)

    # ------------------------------------------------------------------ facts
    def fact_bookings(self) -> DataFrame:
        return self._layer("fact_bookings", lambda: facts.fact_bookings(
            self.valid_bookings(), self.dim_drivers_active(), self._key_calendar()),
            by_day="booking_request_date_key")

    def fact_offers(self) -> DataFrame:
        return self._layer("fact_offers", lambda: facts.fact_offers(
            self.valid_offers(), self.valid_bookings(), self.dim_drivers_active(), self._key_calendar()),
            by_day="offer_created_date_key")

    def _offers_for_activity(self) -> DataFrame:
        # the driver-day table does not read the booking check; in lazy mode skip that join
        if self.store:
            return self.fact_offers()
        return facts.fact_offers(self.valid_offers(), None, self.dim_drivers_active(), self._key_calendar())

    # ------------------------------------------------------------------ driver-day
    def registered_drivers(self) -> DataFrame:
        # the population reads registration dates; only the literal variant needs the calendar key
        if self.cfg.literal_calendar_tenure:
            return self.dim_drivers_active()
        return self.dim_drivers().filter("is_active")

    def population(self) -> DataFrame:
        return activity.active_driver_population(self.registered_drivers(), self._offers_for_activity(),
                                                 self.fact_bookings(), self.ccfg)

    def spine(self) -> DataFrame:
        return activity.driver_date_spine(self.population(), self.ccfg)

    def offers_daily(self) -> DataFrame:
        return activity.offers_daily(self._offers_for_activity(), self.ccfg)

    def bookings_daily(self) -> DataFrame:
        return activity.bookings_daily(self.fact_bookings(), self.ccfg)

    def agg_driver_activity(self) -> DataFrame:
        return self._layer("agg_driver_activity", lambda: activity.agg_driver_activity(
            self.registered_drivers(), self._offers_for_activity(), self.fact_bookings(), self.ccfg))

    # ------------------------------------------------------------------ analyses
    def driver_kpi_summary(self) -> DataFrame:
        return analyses.driver_kpi_summary(self.agg_driver_activity(), self.cfg)
