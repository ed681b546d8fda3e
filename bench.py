"""Time the headline queries and print one JSON line.

Each query runs in full into Spark's `noop` sink, once to warm up and then `BENCH_RUNS` times; the best run
counts. Set BENCH_SF_DIR and BENCH_CPUS to choose data and cores, BENCH_QUERIES to choose queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = [
    "bars_from_trades", "last_50_bars", "incremental_new_bars", "bars_upsert",
    "indicator_table", "sma_all", "rsi_batch", "obv", "cci_rowwise", "macd_batch", "ema_recursive", "macd_realtime",
    "ema_adjusted", "macd_adjusted", "latest_indicators", "registry_table", "x_parabolic_sar", "weekly_bars",
    "bb_upper_touch", "bb_upper_touch_day", "multi_scan", "watchlist_sector_stats", "watchlist_top_symbols",
    "latest_quotes", "market_summary", "quote_signals", "quote_fallback", "tier_routing", "quote_dedup_30s",
    "api_call_sessions", "shard_stats", "call_report", "response_median", "log_event_counts",
    "catalog_profile", "bars_quarantine", "latest_quotes_stream",
]


def main() -> None:
    from candlewick.plans.registry import ENTRIES
    from candlewick.session import build_session

    spark = build_session(
        "bench", f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    seconds = {}
    for name in names:
        best = None
        for run in range(RUNS + 1):
            started = time.time()
            ENTRIES[name].build(spark, FOLDER).write.format("noop").mode("overwrite").save()
            taken = time.time() - started
            if run:
                best = taken if best is None else min(best, taken)
        seconds[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": FOLDER.rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
