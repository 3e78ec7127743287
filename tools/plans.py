"""Write PLANS.md: physical plans of the main steps in the production shape.

    python tools/plans.py [sf_dir] [window_days]

Layers are stored (as in bench.py) so each plan starts from the previous
layer's table; the operator tree plus the scan lines (pushed filters, pruned
read schema) are kept.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripwise.config import wide  # noqa: E402
from tripwise.operators import activity, analyses, facts, staging  # noqa: E402
from tripwise.plans.layers import Layers  # noqa: E402
from tripwise.session import build_session, shared_dir  # noqa: E402


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    full = buf.getvalue()
    tree, _, details = full.partition("\n\n\n")
    keep = [ln for ln in details.splitlines()
            if re.match(r"^\(\d+\) Scan", ln) or ln.startswith(("PushedFilters", "PartitionFilters", "ReadSchema"))]
    return tree.strip() + "\n\n" + "\n".join(keep)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    days = int(sys.argv[2]) if len(sys.argv) > 2 else 365
    spark = build_session("local[4]", extra={"spark.ui.showConsoleProgress": "false"})
    L = Layers(spark, sf, wide(days), store=f"{shared_dir(spark)}/plans-{uuid.uuid4().hex}")
    L.stg_drivers(), L.stg_bookings(), L.stg_offers(), L.dim_drivers(), L.fact_bookings(), L.fact_offers()
    steps = {
        "stg_offers (dedup, rules, two reference checks)": staging.clean_offers(
            L.raw_offers(), L.valid_bookings(), L.valid_drivers(), L.cfg),
        "fact_offers": facts.fact_offers(L.valid_offers(), L.valid_bookings(), L.dim_drivers_active(), L.dim_date()),
        "agg_driver_activity (flagship)": activity.agg_driver_activity(
            L.registered_drivers(), L.fact_offers(), L.fact_bookings(), L.ccfg),
    }
    steps["SCD2 second load (one full outer join)"] = L.scd2_batch2()["dim"]
    agg = L.agg_driver_activity()
    steps["driver_tenure_engagement (aggregate, then join)"] = analyses.driver_tenure_engagement(
        agg, L.dim_drivers_active())
    steps["weekend_vs_weekday (aggregate, then join)"] = analyses.weekend_vs_weekday(agg, L.dim_date())
    out = ["# Physical plans (production shape, before adaptive re-planning)", "",
           f"Input `{sf}`, window {days} days, local[4]. Generated by `tools/plans.py`.", ""]
    for title, df in steps.items():
        out += [f"## {title}", "", "```", plan_text(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
