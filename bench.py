"""Seconds per query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every catalog query runs once to warm up and is then timed; the median of
$BENCH_RUNS runs counts. Results go to a sink that computes all rows.

``python bench.py --made ROWS FOLDER query ...`` is the trial on a large made table:
it writes ROWS events to FOLDER, of which one name and one client hold a third each,
and times the queries there.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tallyfold.plans.catalog import QUERIES
from tallyfold.session import local_session


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def make_events(spark, rows: int, folder: str) -> None:
    """Many names and clients, and a hot one of each."""
    hot = lambda column, n: f"if(xxhash64(id, '{column}') % 3 = 0, 0, pmod(xxhash64('{column}', id), {n}))"
    spark.range(0, rows, 1, 64).selectExpr(
        "id as event_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id / 20) as ts",
        f"cast({hot('client', 1_000_000)} as bigint) as user_id",
        f"concat('name', {hot('name', 500_000)}) as event_type",
        "round(pmod(xxhash64(id), 10000) / 100, 2) as value",
        "concat('{\"k\": ', pmod(xxhash64(id, 1), 100), '}') as props",
    ).write.mode("overwrite").parquet(f"{folder}/events.parquet")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    arguments = sys.argv[1:]
    # What queries write lies below one folder of this run.
    work = os.environ.get("BENCH_WORK_DIR", os.path.join(os.getcwd(), "spark-warehouse", "bench"))
    spark = local_session(cpus, spark__checkpoint__dir=work)
    spark.sparkContext.setLogLevel("OFF")
    if arguments[:1] == ["--made"]:
        sf_dir, runs = arguments[2], 1
        make_events(spark, int(arguments[1]), sf_dir)
        arguments = arguments[3:]
    names = arguments or list(QUERIES)
    times = {}
    for name in names:
        seconds(QUERIES[name], spark, sf_dir)
        times[name] = round(
            statistics.median(seconds(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3
        )
    spark.stop()
    scale = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
