"""Bench: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is fully executed with the `noop` sink (no collect to the
driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from logsieve.plans.catalog import QUERIES  # noqa: E402
from logsieve.session import local_session  # noqa: E402

HEADLINE = [
    "raw_parse", "genlog_match", "syslog_docs", "genlog_docs", "user_rule_match",
    "event_match_name", "event_summary", "new_event_rules", "match_counts",
    "log_rule_assembly", "event_defs_system", "netflow_scan", "moniflow_scan",
    "ip_range_join", "cluster_points", "json_lower_keys", "unicode_codec",
    "new_rule_events", "rule_counts", "log_rejects", "stream_normalise",
    "device_rule_match", "user_rule_set_match",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus), app="logsieve-bench")
    # warm the JVM and the parquet readers once
    QUERIES["raw_parse"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
