"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores.  Names given on the
command line replace the headline set; ``all`` times every query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from cadastra.queries import QUERIES
from cadastra.session import build_session

HEADLINE = [
    "latest_per_key", "best_complete_row", "asof_snapshots", "first_sighting", "unpivot_history",
    "concat_fragments", "participants_array", "unseen_only", "percentile_by_group", "rank_values",
    "ntile_segments", "range_by_group", "trailing_rate", "lateral_first", "reconcile", "ranked_sales",
    "sale_descriptions", "notices_of_sale", "land_valuation_history", "derive_legacy", "derive_addresses",
    "full_address", "legal_job_parcels", "best_parcel_per_block", "bbox_join", "overlap_share", "fuzzy_best",
    "feature_json", "sdmx_flatten", "page_links", "provenance_positions", "record_file_roundtrip", "fuzzy_assign",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = build_session("bench", cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    # Load classes and start the workers before the clock runs.
    QUERIES["latest_per_key"](spark, folder).write.format("noop").mode("overwrite").save()
    took: dict[str, float] = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
        print(f"{name}: {took[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total wall-clock of the headline queries",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
