"""Driver dimension as slowly changing versions (SCD type 2) without MERGE.

File tables cannot be updated in place, so the pending loads are a pure function
``(dim, valid staged drivers by load, as_of) -> dim'`` and the caller writes
``dim'`` to a new location.  All loads are applied in one pass: the *active*
versions (load 0) and the incoming drivers meet in one exchange on the driver, in
load order, where

* a row opens a version if it is its driver's first, or if its tracked attributes
  differ from those of the row before (rows between two changes are an island and
  belong to the version that began it);
* ``lead`` over the rows that are left gives what closes a version: it ends 1 s
  before the next one starts.

Comparing with the row before equals comparing with the version, as "equal" carries
over from row to row; only the literal comparison, for which NULL equals anything,
has to take the loads one by one.  Closed (inactive) versions never enter the
exchange.  A driver has at most one row a load there, so no key is hot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, OPEN_END_TS, EngagementConfig
from ..functions.keys import with_consecutive_ids
from ..session import cut_lineage
from .calendar import with_date_key
from .dedup import latest_per_key

DIM_COLUMNS = ("dim_driver_id", "driver_id", "registration_date", "registration_local_date",
               "driver_rating", "driver_rating_count", "country_name", "country_code",
               "receive_marketing", "start_eff_ts", "end_eff_ts", "is_active", "last_modified_ts")

DIM_SCHEMA = ("dim_driver_id bigint, driver_id string, registration_date timestamp, "
              "registration_local_date date, driver_rating decimal(38,2), driver_rating_count decimal(38,0), "
              "country_name string, country_code string, receive_marketing boolean, start_eff_ts timestamp, "
              "end_eff_ts timestamp, is_active boolean, last_modified_ts timestamp")


def empty_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DIM_SCHEMA)


def _differs(t: Column, s: Column, literal: bool) -> Column:
    # literal: SQL '!=' -- a NULL on either side is "unknown", never a change
    return (t != s) if literal else ~t.eqNullSafe(s)


def _marketing(cfg: EngagementConfig) -> Column:
    # literal: the original never stores it
    return F.lit(None).cast("boolean") if cfg.literal_scd2_compare else F.col("receive_marketing")


def version_chains(dim: DataFrame, incoming: DataFrame, as_of: str, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    """The versions of every driver that is active or comes in, over all loads at once; see the module's text.

    ``incoming`` are valid staged drivers with their load's number (1, 2, ...) in ``load``.  Adds
    ``load`` (0: the version was active before), ``opens`` and ``closed_by`` (the load that closes it).
    """
    # two unprocessed rows of a load for one driver would open two versions: keep the latest
    src = latest_per_key(incoming.filter(~F.col("is_processed")), ["load", "driver_id"], newest_first="raw_load_tz")
    rows = src.select(
        F.lit(None).cast("bigint").alias("dim_driver_id"),
        "driver_id", "registration_date", "registration_local_date", "driver_rating", "driver_rating_count",
        "country_name", "country_code", _marketing(cfg).alias("receive_marketing"),
        F.col("raw_load_tz").alias("start_eff_ts"), F.lit(OPEN_END_TS).cast("timestamp").alias("end_eff_ts"),
        F.lit(True).alias("is_active"), F.lit(as_of).cast("timestamp").alias("last_modified_ts"), "load")
    active = dim.filter(F.col("is_active")).select(*DIM_COLUMNS, F.lit(0).alias("load"))
    of_driver = Window.partitionBy("driver_id").orderBy("load")
    differs = reduce(lambda a, b: a | b, [_differs(F.lag(c).over(of_driver), F.col(c), cfg.literal_scd2_compare)
                                          for c in cfg.scd2_tracked])
    # a comparison with NULL (literal mode) is "unknown", i.e. no change
    opens = (F.col("load") > 0) & (F.lag("load").over(of_driver).isNull() | F.coalesce(differs, F.lit(False)))
    versions = active.unionByName(rows).withColumn("opens", opens).filter((F.col("load") == 0) | F.col("opens"))
    versions = (versions.withColumn("closed_by", F.lead("load").over(of_driver))
                .withColumn("_next_start", F.lead("start_eff_ts").over(of_driver)))
    closed = F.col("closed_by").isNotNull()
    return (versions
            .withColumn("end_eff_ts", F.when(closed, F.col("_next_start") - F.expr("INTERVAL 1 SECOND")).otherwise(F.col("end_eff_ts")))
            .withColumn("is_active", ~closed)
            .withColumn("last_modified_ts", F.when(closed, F.lit(as_of).cast("timestamp")).otherwise(F.col("last_modified_ts")))
            .drop("_next_start"))


def apply_loads(dim: DataFrame, incoming: DataFrame, as_of: str, cfg: EngagementConfig = DEFAULT) -> dict[str, DataFrame]:
    """All loads of ``incoming`` (numbered in ``load``) in one pass.

    Returns ``dim`` (new full table), ``closed``, ``opened`` (closed already if a later load of the pass did so) and
    ``changes`` (numbers of versions opened and closed, by load).
    """
    if cfg.literal_scd2_compare:
        return _one_by_one(dim, incoming, as_of, cfg)
    return _applied(dim, incoming, as_of, cfg)


def _applied(dim: DataFrame, incoming: DataFrame, as_of: str, cfg: EngagementConfig) -> dict[str, DataFrame]:
    # read by all that follows: computed once, and kept in the shared folder
    chains = cut_lineage(version_chains(dim, incoming, as_of, cfg))
    start = dim.agg(F.coalesce(F.max("dim_driver_id"), F.lit(0)).alias("m")).first()["m"]
    opened = with_consecutive_ids(chains.filter("opens").withColumn("_order", F.struct("load", "driver_id")),
                                  "_order", "dim_driver_id", start=int(start)).select(*DIM_COLUMNS)
    before = chains.filter("NOT opens").select(*DIM_COLUMNS)
    history = dim.filter(~F.col("is_active")).select(*DIM_COLUMNS)
    changes = (chains.filter("opens").select("load", F.lit(1).alias("opened"), F.lit(0).alias("closed"))
               .unionByName(chains.filter("closed_by IS NOT NULL")
                            .select(F.col("closed_by").alias("load"), F.lit(0).alias("opened"), F.lit(1).alias("closed")))
               .groupBy("load").agg(F.sum("opened").alias("opened"), F.sum("closed").alias("closed")))
    every = before.unionByName(opened)
    return {"dim": history.unionByName(every), "closed": every.filter(~F.col("is_active")), "opened": opened,
            "changes": changes}


def _one_by_one(dim: DataFrame, incoming: DataFrame, as_of: str, cfg: EngagementConfig) -> dict[str, DataFrame]:
    # literal: '!=' with NULL is no change, so a load is compared with the version, not with the load before
    loads = [r["load"] for r in incoming.select("load").distinct().orderBy("load").collect()]  # one row a load
    done: list[dict[str, DataFrame]] = []
    for load in loads or [0]:
        done.append(_applied(dim, incoming.filter(F.col("load") == load), as_of, cfg))
        dim = cut_lineage(done[-1]["dim"]) if load != (loads or [0])[-1] else done[-1]["dim"]
    return {"dim": dim} | {k: reduce(DataFrame.unionByName, [d[k] for d in done]) for k in ("closed", "opened", "changes")}


def apply_batch(dim: DataFrame, valid_drivers: DataFrame, as_of: str,
                cfg: EngagementConfig = DEFAULT) -> dict[str, DataFrame]:
    """One SCD2 load; ``apply_loads`` of a single one."""
    return apply_loads(dim, valid_drivers.withColumn("load", F.lit(1)), as_of, cfg)


def new_drivers(dim: DataFrame, valid_drivers: DataFrame, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    """Incoming drivers that have no active version left once the changed ones are closed (NOT EXISTS, J9)."""
    src = latest_per_key(valid_drivers.filter(~F.col("is_processed")), "driver_id", newest_first="raw_load_tz")
    t = dim.filter(F.col("is_active")).select(F.col("driver_id").alias("_t_driver_id"), *[F.col(c).alias(f"_t_{c}") for c in cfg.scd2_tracked])
    differs = reduce(lambda a, b: a | b, [_differs(F.col(f"_t_{c}"), F.col(c), cfg.literal_scd2_compare) for c in cfg.scd2_tracked])
    return src.join(t, (F.col("driver_id") == F.col("_t_driver_id")) & ~F.coalesce(differs, F.lit(False)), "left_anti")


def active_view(dim: DataFrame, cal: DataFrame | None, cfg: EngagementConfig = DEFAULT) -> DataFrame:
    """Current version per driver with calendar key of registration and tenure label."""
    act = with_date_key(dim.filter(F.col("is_active")), "registration_local_date", "registration_date_key", cal)
    if cfg.literal_calendar_tenure:
        veteran = F.col("registration_date_key") <= F.lit(cfg.tenure_cutoff_key)
    else:
        veteran = F.col("registration_local_date") <= F.to_date(F.lit(cfg.tenure_cutoff))
    return act.select(
        "dim_driver_id", "driver_id", "registration_date", "registration_local_date", "registration_date_key",
        F.when(veteran, "Veteran").otherwise("Rookie").alias("driver_type"),
        "driver_rating", "driver_rating_count", "country_name", "country_code")
