"""Time the headline queries at one scale and print one JSON line.

Each query is run once to warm up, then ``BENCH_RUNS`` times (2); the median is
reported. A run builds the query and computes every row and column of its result
without sending it to the driver. Lake tables are derived in the warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from newslake.plans import registry  # noqa: E402
from tests.session import local_session  # noqa: E402

HEADLINE = [
    "silver_trades",
    "trade_volume",
    "recent_avg_price",
    "partition_row_counts",
    "d_ohlcv_hourly",
    "d_top_trades",
    "d_moving_avg",
    "d_percentiles",
    "d_equi_join",
    "d_subquery",
    "news_refine",
    "html_paragraph_text",
    "page_metadata",
    "chunk_recursive",
    "chunk_fixed",
    "embed_hashed",
    "url_dedup_anti",
    "url_dedup_batch",
    "vector_topk",
    "batch_retrieval",
    "search_result_rows",
    "market_brief",
    "partition_slice_scan",
    "sql_tool_result",
    "ingest_metrics",
    "stream_news_refine",
]
# Long enough to be measured once.
ONCE = ["stream_trade_medallion", "stream_embed_upsert", "incremental_ingest"]


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    seconds = {}
    for name in HEADLINE:
        run(queries[name], spark, sf_dir)
        seconds[name] = statistics.median(run(queries[name], spark, sf_dir) for _ in range(runs))
    for name in ONCE:
        seconds[name] = run(queries[name], spark, sf_dir)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {n: round(s, 3) for n, s in seconds.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
