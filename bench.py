"""Time the queries and print one JSON line.

``BENCH_SF_DIR`` is the folder of given tables, ``BENCH_CPUS`` the number of
local cores; ``BENCH_QUERIES`` restricts the run to some queries.
"""

from __future__ import annotations

import json
import os
import time

from storelens.catalog import CATALOG
from storelens.session import build_session

HEADLINE = (
    "top_sellers variant_sales listing_sales summary_by_type summary_by_markdown category_share "
    "type_share collection_analysis collection_heat collection_buried_rank "
    "collection_report_header customer_profiles order_features customer_send_hours "
    "segment_features segment_list bfcm_only_segment campaign_list process_table "
    "ship_date_clean order_groups order_items_enriched contact_match order_import "
    "master_unique stale_new_badges badge_applied tags_added collection_positions"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    CATALOG.queries["active_listings"].run(spark, folder).count()  # warm-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        result = CATALOG.queries[name].run(spark, folder)
        result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
