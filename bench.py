"""Benchmark the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3; the first run is discarded, as in the reference's
measuring rule). Each run executes the whole plan through the ``noop``
sink, so nothing is collected to the driver. ``queries`` has the mean of the
counted runs, ``spread`` their range, and ``small`` one run of each at a tenth
of the size where that exists, so that noise and growth can be told apart.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "latest_per_key",        # W1 on the events change log
    "latest_composite_key",  # W1 on lineitem, composite key + full tie-break
    "current_state",         # flagship: log → current table
    "merge_replace",         # J1 on orders with a lineitem-derived batch
    "merge_update",          # J2
    "apply_batch",           # J8: two batches, ordered merge with tombstones
    "scd2_merge",            # J3 + J4
    "scd2_history",          # W2
    "scd2_as_of",            # J11
    "dq_violations",         # Q1 with FK checks
    "quarantine_split",      # Q4
    "lag_p95",               # A6
    "batch_job",             # full run: parse → dedup → route → sinks + ledger, read back
    "stream_current_state",  # T1: the same through a stream in micro-batches
]
# not timed at the tenth of the size: fixed costs of their many jobs say nothing there
WHOLE_ONLY = ("stream_current_state",)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = max(2, int(os.environ.get("BENCH_RUNS", "3")))
    from rowtide.session import local_session
    from rowtide.plans import QUERIES

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="rowtide-bench")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    result, spread, small = {}, {}, {}

    def once(name: str, where: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, where).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    m = re.search(r"sf([0-9.]+)", sf_dir)
    tenth = sf_dir[:m.start(1)] + f"{float(m.group(1)) / 10:g}" + sf_dir[m.end(1):] if m else ""
    for name in names:
        times = [once(name, sf_dir) for _ in range(runs)][1:]
        result[name] = round(statistics.mean(times), 3)
        spread[name] = round(max(times) - min(times), 3)
        if os.path.isdir(tenth) and name not in WHOLE_ONLY:
            small[name] = round(once(name, tenth), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(result.values()), 3),
        "unit": "sec",
        "queries": result,
        "spread": spread,
        "small": small,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
