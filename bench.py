"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion (rows written to a no-op sink, so the full plan executes
without collecting to the driver).  The first run of the session warms the JVM and is not
counted; every query then runs once as warm-up and ``BENCH_REPS`` (default 3) timed times, and
the best time is reported (single runs on a shared machine vary by up to 2x).  The session has
Spark's default settings but for the number of shuffle partitions.  A query's time includes the
intermediate tables that it writes; they are deleted after it, outside the time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chronoweave.session import local_session, release_scratch  # noqa: E402
from chronoweave.workloads import QUERIES  # noqa: E402

HEADLINE = [
    "align_multi_source",
    "csv_import",
    "resample_equal",
    "resample_slower",
    "resample_faster",
    "upsample_ffill",
    "resample_events",
    "resample_users",
    "resample_equal_ties",
    "downsample_avg",
    "next_gap",
    "next_gap_chunked",
    "infer_interval",
    "align_union_keys",
    "full_outer_offgrid",
    "align_multiply",
    "validate_drop",
    "pack_dataset",
    "unpack_dataset",
    "save_roundtrip",
    "rdbms_import",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - t0
    release_scratch(spark)
    return took


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")))
    run(spark, "align_multi_source", sf_dir)  # JVM warm-up
    times = {}
    reps = int(os.environ.get("BENCH_REPS", "3"))
    for name in HEADLINE:
        run(spark, name, sf_dir)
        times[name] = round(min(run(spark, name, sf_dir) for _ in range(reps)), 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_sec_headline_queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
