"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then $BENCH_RUNS times; the median counts.
Every row and column of the result is computed (noop sink). $BENCH_QUERIES, a
comma-separated list, picks other registered queries, or ``all``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewire import catalog  # noqa: E402
from tidewire.session import build_session  # noqa: E402

HEADLINE = [
    "parse_ticks",
    "conform_posts",
    "quarantine",
    "listing_all",
    "content_id",
    "topic_split",
    "newest30_per_forum",
    "dedup_posts",
    "sentiment_lexicon",
    "zero_shot_embedding",
    "avg_price_by_time",
    "pct_change_lag",
    "pct_change_lag_global",
    "join_window_inner",
    "asof_price",
    "daily_ohlc",
    "forecast_trend",
    "speed_rows",
    "batch_rows",
    "upsert_latest",
    "stream_posts_5m",
    "stream_change",
    "stream_speed_rows",
    "stream_dedup",
    "stream_raw_sink",
]


def main() -> None:
    # Python workers of stateful streams print to the standard output they
    # inherit; only the result line may go there.
    result_out = os.fdopen(os.dup(1), "w")
    os.dup2(2, 1)
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    queries = catalog.all_queries()
    names = list(queries) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        taken = []
        for _ in range(1 + runs):
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        timings[name] = round(statistics.median(taken[1:]), 4)
    spark.stop()
    line = {
        "metric": "headline_queries_total_median",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "runs": runs,
    }
    print(json.dumps(line), file=result_out, flush=True)


if __name__ == "__main__":
    main()
