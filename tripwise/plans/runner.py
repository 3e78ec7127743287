"""Production run of the whole model: every layer written as a parquet table.

    python -m tripwise.plans.runner --out <shared folder> [--sf-dir DIR | --raw-csv DIR]
        [--as-of TS] [--window-start DAY --window-end DAY] [--tenure-cutoff DAY] [--window-days N]

``--raw-csv DIR`` reads ``DIR/drivers``, ``DIR/bookings`` and ``DIR/offers``
(CSV or CSV.gz extracts); otherwise the raw views are derived from the test
tables in ``--sf-dir``.  A run writes its tables to ``<out>/runs/<run id>`` and is
published (``published``) when all of them are there, so a run that fails midway
leaves the last one as it was.  The driver dimension is kept over runs in
``<out>/history``: each run is one more load of it.  ``--out`` defaults to ``<spark.checkpoint.dir>/model``.  "Now" in the
rules is the clock (UTC) unless ``--as-of`` sets it.
"""

from __future__ import annotations

import argparse
import datetime as dt
import uuid

from pyspark.sql import SparkSession

from ..config import DEFAULT, wide
from ..operators import analyses, audit
from ..session import prepare, shared_dir
from ..sources.csv import read_raw_csv
from ..sources.versioned import VersionedTable
from .layers import Layers


def run(spark: SparkSession, out: str, sf_dir: str | None = None, raw_csv: str | None = None,
        window_days: int | None = None, load_tz: str | None = None, as_of: str | None = None,
        window_start: str | None = None, window_end: str | None = None, tenure_cutoff: str | None = None,
        run_id: str | None = None) -> dict[str, str]:
    """Run the model; returns the folder of each analysis.  A failed run is done again with its ``run_id``."""
    prepare(spark)
    run_id = run_id or uuid.uuid4().hex
    runs, out = VersionedTable(spark, f"{out}/published"), out.rstrip("/")
    folder = f"{out}/runs/{run_id}"
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    given = {"window_start": window_start, "window_end": window_end, "tenure_cutoff": tenure_cutoff}
    cfg = (wide(window_days) if window_days else DEFAULT).with_(as_of=as_of or now, **{k: v for k, v in given.items() if v})
    raw = None
    if raw_csv:
        ts = load_tz or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        raw = {k: read_raw_csv(spark, f"{raw_csv}/{k}", k, load_tz=ts) for k in ("drivers", "bookings", "offers")}
    L = Layers(spark, sf_dir or "", cfg, store=folder, raw=raw, history=f"{out}/history", load_run=run_id)
    for layer in (L.stg_drivers, L.stg_bookings, L.stg_offers, L.dim_drivers, L.fact_bookings, L.fact_offers,
                  L.agg_driver_activity):
        layer()
    agg, dim, cal = L.agg_driver_activity(), L.dim_drivers_active(), L.dim_date()
    summary = analyses.driver_kpi_summary(agg, cfg)
    results = {
        "dq_rule_counts": audit.dq_rule_counts({"stg_drivers": L.stg_drivers(), "stg_bookings": L.stg_bookings(),
                                                "stg_offers": L.stg_offers()}),
        "driver_kpi_summary": summary,
        "weekend_vs_weekday": analyses.weekend_vs_weekday(agg, cal),
        "driver_tenure_engagement": analyses.driver_tenure_engagement(agg, dim),
        "kpi_histogram": analyses.kpi_histogram(summary, cfg),
        "kpi_overview": analyses.kpi_overview(summary),
        "abort_segments": analyses.abort_segments(agg, cfg),
        "segment_dim_coverage": analyses.segment_dim_coverage(agg, dim, cfg),
        "country_trend": analyses.country_trend(agg, dim),
        "daily_trend": analyses.daily_trend(agg),
    }
    paths = {}
    for name, df in results.items():
        paths[name] = f"{folder}/analyses/{name}"
        df.write.mode("overwrite").parquet(paths[name])
    runs.write(spark.createDataFrame([(run_id, folder, cfg.as_of)], "run_id string, folder string, as_of string"))
    return paths


def published(spark: SparkSession, out: str) -> str | None:
    """The folder of the last run that was completed; None before the first."""
    rows = VersionedTable(spark, f"{out.rstrip('/')}/published").read()
    return None if rows is None else rows.first()["folder"]


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--out")
    ap.add_argument("--sf-dir")
    ap.add_argument("--raw-csv")
    ap.add_argument("--window-days", type=int)
    for name in ("--as-of", "--window-start", "--window-end", "--tenure-cutoff"):
        ap.add_argument(name)
    a = ap.parse_args()
    spark = SparkSession.builder.appName("tripwise").getOrCreate()
    out = a.out or f"{shared_dir(spark)}/model"
    for name, path in run(spark, out, a.sf_dir, a.raw_csv, a.window_days, as_of=a.as_of, window_start=a.window_start,
                          window_end=a.window_end, tenure_cutoff=a.tenure_cutoff).items():
        print(name, path)


if __name__ == "__main__":
    main()
