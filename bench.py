"""Benchmark the headline queries; prints ONE JSON line on stdout.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_REPEATS`` (default 5), ``BENCH_STREAM`` (default 1: also
time one real streaming run).

Each query is executed to completion with the ``noop`` sink (all rows
computed, nothing collected), three times to warm up and then ``BENCH_REPEATS``
times; the median is reported. The three input collections are derived from
the driver tables once per session beforehand (``load_sec``), as stored
collections would be in production.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from regiontally.plans.inspect import operator_counts  # noqa: E402
from regiontally.queries import queries  # noqa: E402
from regiontally.session import local_session  # noqa: E402
from regiontally.sources import testdata  # noqa: E402

HEADLINE = [
    "mortality_report",
    "top20_regions",
    "users_mapped",
    "total_population",
    "batch_deltas_with_parent",
    "merge_one_batch",
    "report_after_stream_with_baseline",
    "report_after_stream_empty",
]
STREAM_KEY = "stream_users_to_report"
WARM_UPS = 3
PLAN_OPS = ["file_scans", "hash_shuffles", "range_shuffles", "broadcast_joins", "sort_merge_joins"]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "5"))
    with_stream = os.environ.get("BENCH_STREAM", "1") != "0"
    match = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(match.group(1)) if match else None

    spark = local_session(
        master=f"local[{cpus}]",
        app_name="regiontally-bench",
        **{"spark.sql.shuffle.partitions": str(cpus), "spark.ui.showConsoleProgress": "false"},
    )
    qs = queries()
    load = _timed(
        lambda: (
            testdata.users(spark, sf_dir),
            testdata.regions(spark, sf_dir),
            testdata.user_events(spark, sf_dir),
        )
    )
    results: dict[str, float] = {}
    plans: dict[str, dict[str, int]] = {}
    errors: dict[str, str] = {}
    for key in HEADLINE:
        try:
            for _ in range(WARM_UPS):
                warm = qs[key](spark, sf_dir)
                _run(warm)
            warm.collect()
            counts = operator_counts(warm)  # the executed plan, after adaptive re-planning
            plans[key] = {k: counts[k] for k in PLAN_OPS}
            times = [_timed(lambda: _run(qs[key](spark, sf_dir))) for _ in range(repeats)]
        except Exception as exc:  # keep the other measurements; report the failure
            errors[key] = f"{type(exc).__name__}: {exc}"[:500]
            continue
        results[key] = round(statistics.median(times), 4)
        print(f"{key}: {results[key]}s", file=sys.stderr)
    stream_batches = stream = None
    if with_stream:
        try:
            stream = round(_timed(lambda: _run(qs[STREAM_KEY](spark, sf_dir))), 4)
            stream_batches = testdata.user_events(spark, sf_dir).select("batch_id").distinct().count()
            print(f"{STREAM_KEY}: {stream}s over {stream_batches} micro-batches", file=sys.stderr)
        except Exception as exc:
            errors[STREAM_KEY] = f"{type(exc).__name__}: {exc}"[:500]
    out = {
        "metric": "load_plus_sum_of_median_query_sec",
        "value": round(load + sum(results.values()), 4),
        "unit": "sec",
        "queries": results,
        "sf": sf,
        "load_sec": round(load, 4),
        "stream_sec": stream,
        "stream_micro_batches": stream_batches,
        "stream_sec_per_micro_batch": (
            round(stream / stream_batches, 4) if stream_batches else None
        ),
        "plans": plans,
        "errors": errors,
        "cpus": cpus,
        "repeats": repeats,
        "spark": spark.version,
    }
    spark.stop()
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    sys.exit(main())
