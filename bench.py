"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (full execution, no
driver collection).  Prints ONE JSON line.  Extra fields: records/s of the
wide view and the number of Spark jobs it took (which must not grow with
the number of records or files).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eavflow.queries import QUERIES  # noqa: E402
from eavflow.session import get_session  # noqa: E402

HEADLINE = ["wide_view", "pivot_last", "token_names", "token_labels", "lookup_or_self",
            "link_control", "second_template", "convert_status", "ledger_upsert",
            "csv_scan", "csv_roundtrip", "backfill"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                        extra={"spark.driver.memory": "16g"})
    sc = spark.sparkContext
    # warm-up (JVM, JIT) on the same code path over the smallest tables; not timed
    warm = "/root/testdata/sf0.001" if os.path.isdir("/root/testdata/sf0.001") else sf_dir
    for name in ("wide_view", "second_template"):
        QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()

    times, jobs = {}, {}
    for name in HEADLINE:
        group = f"bench-{name}"
        sc.setJobGroup(group, name)
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        jobs[name] = len(sc.statusTracker().getJobIdsForGroup(group))
    n_records = QUERIES["pivot_last"](spark, sf_dir).count()
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {
        "metric": "eav_headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "wide_view_records": n_records,
        "wide_view_records_per_sec": round(n_records / times["wide_view"], 1),
        "spark_jobs": jobs,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
