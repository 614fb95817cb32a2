"""Print the formatted physical plan of registered queries.

usage: python tools/explain.py [sf_dir] [name ...]   (default: a few headline queries)
Shows what the plan does at scale: pruned scans (ReadSchema), partial aggregation before
each Exchange, partial WindowGroupLimit for top-N, broadcast only of bounded dimensions.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stationlake.plans.registry import QUERIES  # noqa: E402
from stationlake.session import build_session  # noqa: E402

DEFAULT = ["silver_availability", "fact_top_array", "gold_daily", "frozen_stations"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or DEFAULT
    spark = build_session("local[4]")
    for n in names:
        print(f"===== {n} =====")
        QUERIES[n](spark, sf).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
