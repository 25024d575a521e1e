"""Benchmark: headline queries and the batch jobs at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line. Each query is forced to completion with the no-op
sink (full execution, nothing collected) and timed as the median of
``BENCH_REPEAT`` runs (default 3); the jobs read landed JSON and write
parquet tables to a scratch warehouse (best of two). Every timing follows a
warm-up of the same plan on the smallest test tables.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from reelstar import schemas, session  # noqa: E402
from reelstar.plans.batch import run_batch  # noqa: E402
from reelstar.plans.config import PipelineConfig  # noqa: E402
from reelstar.plans.queries import queries  # noqa: E402
from reelstar.sources import landing, testdata  # noqa: E402
from reelstar.sources.raw import read_raw_events  # noqa: E402

HEADLINE = ("fct_media_engagement", "fct_events", "dim_visitors", "dim_media",
            "dim_dates", "latest_per_key", "incremental_filter", "event_watch_time")
WARMUP_DIR = "/root/testdata/sf0.001"
# Landing days that the incremental job finds landed once more.
LATE_FROM = "2024-01-29"


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _land(spark, sf_dir: str) -> str:
    root = session.scratch_path(spark, "bench-raw")
    landing.land(testdata.raw_events(spark, sf_dir), root, "events", "adapter")
    landing.land(testdata.raw_media(spark, sf_dir), root, "media", "media")
    return root


def _jobs(spark, sf_dir: str) -> dict[str, float]:
    """A full run, then an incremental one after a new batch was landed."""
    root = _land(spark, sf_dir)
    db = f"bench_{int(time.time() * 1000)}"
    wh = session.scratch_path(spark, "bench-wh")
    run_date = read_raw_events(spark, root).agg(F.max(schemas.RAW_PARTITION_COL)).first()[0]
    out = {}
    t = time.perf_counter()
    run_batch(spark, PipelineConfig(source_path=root, target_db=db, warehouse_dir=wh,
                                    dates_end=run_date))
    out["job_full"] = time.perf_counter() - t
    late = testdata.raw_events(spark, sf_dir).where(F.col(schemas.RAW_PARTITION_COL) >= F.lit(LATE_FROM).cast("date"))
    landing.land(late, root, "events", "late")
    t = time.perf_counter()
    run_batch(spark, PipelineConfig(source_path=root, target_db=db, warehouse_dir=wh,
                                    mode="incremental", start_date="2024-01-20",
                                    dates_end=run_date))
    out["job_incremental"] = time.perf_counter() - t
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = session.local_session(cpus, shuffle_partitions=cpus, app="reelstar-bench")
    qs = queries()
    timings: dict[str, float] = {}
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    for name in HEADLINE:
        _noop(qs[name](spark, WARMUP_DIR))
    for name in HEADLINE:
        runs = []
        for _ in range(repeat):
            t = time.perf_counter()
            _noop(qs[name](spark, sf_dir))
            runs.append(time.perf_counter() - t)
        timings[name] = statistics.median(runs)
    _jobs(spark, WARMUP_DIR)
    first, second = _jobs(spark, sf_dir), _jobs(spark, sf_dir)
    timings.update({k: min(first[k], second[k]) for k in first})
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
