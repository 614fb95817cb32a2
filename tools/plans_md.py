"""Write PLANS.md: the compact physical plan tree of key queries (explain "formatted",
tree part only). usage: python tools/plans_md.py [sf_dir]"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from stationlake.operators import facts as FX  # noqa: E402
from stationlake.operators import quality as Q  # noqa: E402
from stationlake.plans import silver  # noqa: E402
from stationlake.session import build_session  # noqa: E402
from stationlake.sources import testdata as td  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n\n")[0].strip()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[4]")
    raw_st = td.raw_stations(spark, sf)
    av = silver.availability_silver(td.raw_availability(spark, sf), raw_st).df
    st = silver.station_silver(raw_st).df
    joined = FX.join_stations(av, st)
    cases = [
        ("Availability silver (raw → rules → dedup)", av),
        ("Daily top-5 saturated stations over the silver", FX.fact_top_saturated(joined, None)),
        ("Frozen stations (runs by station and day, edges stitched)", Q.frozen_stations(av)),
        ("Critical alerts (rows with their run's start)", Q.critical_alerts(Q.critical_readings(joined))),
    ]
    out = ["# PLANS", "",
           f"Physical plans (`explain(\"formatted\")`, tree part, before AQE re-planning) at `{sf}`,",
           "generated by `tools/plans_md.py`. Read bottom-up.", ""]
    for title, df in cases:
        out += [f"## {title}", "", "```", tree(df), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
