"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlark.session import local_session  # noqa: E402
from querybook import BOOK  # noqa: E402

HEADLINE = (
    "early_stop", "board_posts", "page_staleness", "crawl_stats", "board_feed", "board_items",
    "feed_flatten", "feed_discussions", "extract_tables_aligned", "extract_tables_inline", "table_title",
    "announcements", "merge_pages", "stock_result", "html_tokens", "extract_links", "page_profile",
    "hk_pivot", "label_join", "ffill_dates", "dedup_first", "ordinals", "bm25_topk", "vector_topk",
    "hybrid_topk", "phrase_match", "last_n_runs", "memory_state", "cache_split", "incremental_load",
    "request_stats", "route_logs",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()  # start-up is not part of a query
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        BOOK[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
