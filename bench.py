"""Times the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# One or two queries per area: upserts, whole loads, conditional deletes, membership,
# flattening with and without children, scoring, masking, decoding, snapshots, rejects, tables.
HEADLINE = (
    "state_latest",
    "state_merge_base",
    "state_daily_load",
    "assignment_fold",
    "membership_apply",
    "flatten_role",
    "flatten_collection",
    "flatten_assignment_v1",
    "flatten_bundle",
    "score_statements",
    "policy_state_scored",
    "audit_masked",
    "message_decode",
    "delete_routing",
    "stale_rows",
    "snapshot_complete",
    "rejects_split",
    "state_table_loads",
    "state_reads_by_tenant",
    "history_append",
)


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    from grantlake.plans import catalog
    from grantlake.session import build_session

    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in names:
        # The first run also loads and compiles, so short queries run twice and the faster run counts.
        runs = []
        while not runs or (len(runs) < 2 and runs[0] < 20):
            started = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
