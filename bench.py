"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full through the ``noop`` sink (every row computed, nothing
collected to the driver). The headline set runs once untimed first (JVM start-up and JIT
compilation of each query shape are per-process costs, not data costs), then
$BENCH_REPEATS (default 2) timed passes; each query reports its best (minimum) time, since
run-to-run noise on a shared machine only ever adds time. The cold first-run total and the
median-pass total are reported too, and the seconds of a fixed calibration job, by which totals
of differently fast machines can be compared.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pidlink.plans import queries as Q  # noqa: E402
from pidlink.session import build_session  # noqa: E402

HEADLINE = [
    "map_all",
    "map_venues_untyped",
    "meta_responsible_agents",
    "pid_index_by_scheme",
    "flat_authorships",
    "upsert_keep_last",
    "mm_categories_works",
    "mm_categories_sources",
    "mm_category_counts",
    "prov_counts",
    "mm_distribution",
    "inverted_multi_mapped",
    "coverage_meta",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(spark, sf_dir, name):
    """Seconds for one query (plan building, eager checkpoints and execution); None on error."""
    t0 = time.perf_counter()
    try:
        run(Q.QUERIES[name](spark, sf_dir))
    except Exception as e:  # keep benchmarking the others; the failure is reported
        print(f"bench: {name} failed: {type(e).__name__}: {str(e)[:200]}", file=sys.stderr)
        return None
    return time.perf_counter() - t0


def calibration(spark) -> float:
    """Seconds of a fixed job (hash, shuffle, aggregate of generated rows) that no change of the
    library touches: the ratio of two machines' values is their relative speed."""
    t0 = time.perf_counter()
    run(spark.range(20_000_000).selectExpr("id", "md5(cast(id as string)) AS h").selectExpr("substr(h, 1, 4) AS k", "length(h) + id AS n")
        .groupBy("k").sum("n"))
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="pidlink-bench", shuffle_partitions=max(2 * cpus, 8),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    calibration(spark)
    machine = min(calibration(spark) for _ in range(2))
    cold = {name: timed(spark, sf_dir, name) for name in names}  # warm-up pass, reported as "cold_total"
    repeats = max(int(os.environ.get("BENCH_REPEATS", "2")), 1)
    passes = []
    for _ in range(repeats):
        passes.append({name: timed(spark, sf_dir, name) for name in names})
    ok = [n for n in names if all(p[n] is not None for p in passes)]
    times = {n: (round(min(p[n] for p in passes), 3) if n in ok else None) for n in names}
    totals = sorted(sum(p[n] for n in ok) for p in passes)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times[n] for n in ok), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cold_total": round(sum(v for v in cold.values() if v is not None), 3),
        "failed": [n for n in names if n not in ok],
        "median_pass_total": round(totals[len(totals) // 2], 3),
        "stat": f"min of {repeats} warm passes",
        "cpus": cpus,
        "calibration_sec": round(machine, 3),
        "value_per_calibration": round(sum(times[n] for n in ok) / machine, 2),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
