"""Benchmark: the full engagement model at $BENCH_SF_DIR on local[$BENCH_CPUS].

Runs the production shape: every layer (staging, SCD2 dimension, facts,
driver-day table) is written as parquet into a fresh folder under the shared
checkpoint folder and read back by the next layer; analyses run on the stored
driver-day table.  The activity window is widened to 365 days (the calendar
covers it) so the dense table has drivers x 365 rows.  One warm-up, then the
median of 3 runs per step.  Prints one JSON line.  ``BENCH_EVENT_LOG_DIR``
writes Spark's event log there for stage and task times.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

from tripwise.config import wide
from tripwise.operators import analyses, audit
from tripwise.plans.layers import Layers
from tripwise.session import build_session, shared_dir

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
WINDOW_DAYS = int(os.environ.get("BENCH_WINDOW_DAYS", "365"))


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def one_run(spark, root: str) -> dict[str, float]:
    L = Layers(spark, SF_DIR, wide(WINDOW_DAYS), store=f"{root}/{uuid.uuid4().hex}")
    times: dict[str, float] = {}

    def step(name, fn):
        t = time.perf_counter()
        fn()
        times[name] = time.perf_counter() - t

    step("stg_drivers", L.stg_drivers)
    step("stg_bookings", L.stg_bookings)
    step("stg_offers", L.stg_offers)
    step("dq_rule_counts", lambda: _noop(audit.dq_rule_counts(
        {"stg_drivers": L.stg_drivers(), "stg_bookings": L.stg_bookings(), "stg_offers": L.stg_offers()})))
    step("scd2_dim_drivers", L.dim_drivers)
    step("scd2_batch2", lambda: _noop(L.scd2_batch2()["dim"]))
    step("fact_bookings", L.fact_bookings)
    step("fact_offers", L.fact_offers)
    step("agg_driver_activity", L.agg_driver_activity)
    agg, dim, cal = L.agg_driver_activity(), L.dim_drivers_active(), L.dim_date()
    summary = analyses.driver_kpi_summary(agg, L.cfg)
    step("driver_kpi_summary", lambda: _noop(summary))
    step("weekend_vs_weekday", lambda: _noop(analyses.weekend_vs_weekday(agg, cal)))
    step("driver_tenure_engagement", lambda: _noop(analyses.driver_tenure_engagement(agg, dim)))
    step("kpi_histogram", lambda: _noop(analyses.kpi_histogram(summary, L.cfg)))
    step("abort_segments", lambda: _noop(analyses.abort_segments(agg, L.cfg)))
    step("segment_dim_coverage", lambda: _noop(analyses.segment_dim_coverage(agg, dim, L.cfg)))
    step("country_trend", lambda: _noop(analyses.country_trend(agg, dim)))
    step("country_trend_pivot", lambda: _noop(analyses.country_trend_pivot(agg, dim)))
    step("daily_trend", lambda: _noop(analyses.daily_trend(agg)))
    return times


def main() -> None:
    extra = {"spark.ui.showConsoleProgress": "false"}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):
        # stage / task times for offline inspection (no UI server)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]})
    spark = build_session(f"local[{CPUS}]", shuffle_partitions=int(CPUS) * 2, extra=extra)
    root = f"{shared_dir(spark)}/bench"
    one_run(spark, root)  # warm-up
    runs = [one_run(spark, root) for _ in range(RUNS)]
    med = {k: round(statistics.median(r[k] for r in runs), 3) for k in runs[0]}
    sf = SF_DIR.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "engagement_model_total", "value": round(sum(med.values()), 3), "unit": "sec",
                      "queries": med, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(CPUS), "window_days": WINDOW_DAYS}))
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
