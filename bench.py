"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8)
choose the data and the cores; ``BENCH_QUERIES`` may name a subset.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from webtab.queries import QUERIES  # noqa: E402
from webtab.session import build_session  # noqa: E402

HEADLINE = [
    "q_page_title", "q_page_links", "q_page_tag_counts", "q_page_metrics",
    "q_books_extract", "q_books_crawl", "q_books_structure",
    "q_articles_extract", "q_articles_crawl", "q_wiki_structure", "q_wiki_structure_crawl",
    "q_bfs_nodes", "q_graph_degrees", "q_validate_books", "q_item_stats", "q_stream_extract",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    # start the Python workers before the clock
    QUERIES["q_page_title"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(folder).removeprefix("sf")}))


if __name__ == "__main__":
    main()
