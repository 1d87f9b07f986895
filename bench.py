"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all cores) and
BENCH_RUNS (default 3, after one warm-up run) set the scene.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from ticktide import plans
from ticktide.session import local_session

HEADLINES = [
    "a02_stock_volume_bars", "a01_option_volume_bars", "a05_session_bars", "a06_throughput",
    "p13_published_equity_trades", "p36_published_option_trades", "s04_frames_to_trades",
    "p40_bull_bear_score", "j02_symbology_lookup", "j11_asof_last_quote", "x04_deduplicated_replay",
    "s17_compaction", "d10_black_76", "d11_implied_volatility", "c06_schedule", "c09_j10_open_at",
    "c17_j05_outer_merge", "c18_w04_trading_index", "c22_j11_last_session",
    "c25_a09_trading_minutes_between", "x01_streamed_equity_trades", "x06_streamed_bars",
]


def run(query, spark, sf_dir: str) -> float:
    began = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("bench", cpus)
    spark.conf.set("spark.sql.shuffle.partitions", cpus)
    queries, times = plans.queries(), {}
    for name in HEADLINES:
        run(queries[name], spark, sf_dir)
        times[name] = round(statistics.median(run(queries[name], spark, sf_dir) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "runs": runs}))


if __name__ == "__main__":
    main()
