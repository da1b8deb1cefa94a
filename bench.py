"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from folioworks.session import local_session
from workloads.catalog import QUERIES

HEADLINE = (
    "url_manifest",
    "document_ids",
    "rest_metadata",
    "rest_pages",
    "landed_page_table",
    "dom_pages",
    "dom_text",
    "dom_metadata",
    "resolve_metadata",
    "work_orders",
    "document_manifest",
    "attempt_outcomes",
    "cert_logs",
    "cert_causes",
    "document_outcomes",
    "run_summary",
)


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench")
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        run(spark, "landed_page_table", warm)
        run(spark, "work_orders", warm)
    seconds = {}
    for name in HEADLINE:
        seconds[name] = round(run(spark, name, sf_dir), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
