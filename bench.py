"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and BENCH_RUNS (default 2;
the best run counts) steer it. Every query is executed in full into a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillsight.session import builder  # noqa: E402
from tillsight.verify import queries as q  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

SCALE = os.path.basename(SF_DIR)
if SCALE not in q.LINEITEM_LIMITS:
    raise SystemExit(f"no thresholds are known for {SCALE}")
LIMITS = q.LINEITEM_LIMITS[SCALE]


def rule(*patterns):
    return lambda spark, sf: q.lineitem_detections(spark, sf, patterns, LIMITS)


def live(spark, sf):
    """The whole stream in chunks of the default size, all rules, 50-row files."""
    detector = q.live_run(
        spark, sf, ("upgrade", "gender_skew"), at_end=("child",), chunk_rows=10_000
    )
    return detector.emitted()


def cumulative(spark, sf):
    ws = q.Workspace(spark)
    txns = q.chunked_events(spark, sf, ws, 10_000)
    return q.cumulative(spark, sf, ws=ws, txns=txns)


HEADLINE = {
    "all_detections": rule("upgrade", "child", "gender_skew"),
    "upgrade": rule("upgrade"),
    "child": rule("child"),
    "gender_skew": rule("gender_skew"),
    "pair_txn_counts": q.pair_txn_counts,
    "gender_counts": q.gender_counts,
    "chunk_assign": q.chunk_assign,
    "chunk_detections": q.chunk_detections,
    "cumulative": cumulative,
    "stream": live,
}
ONCE = {"stream"}  # long enough to be timed once


def timed(spark, query) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        builder(
            "tillsight-bench",
            **{
                "spark.sql.shuffle.partitions": str(CPUS),
                "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
                "spark.ui.enabled": "false",
                "spark.ui.showConsoleProgress": "false",
            },
        )
        .master(f"local[{CPUS}]")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name, query in HEADLINE.items():
        runs = 1 if name in ONCE else RUNS
        times[name] = round(min(timed(spark, query) for _ in range(runs)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": SCALE.removeprefix("sf"),
        "cpus": CPUS,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
