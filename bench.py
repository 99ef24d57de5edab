"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query runs once to warm up, then
three times (once if it takes long); the median counts. Results go to a sink that discards them.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from pubweave.plans.catalog import QUERIES
from pubweave.session import local_session

HEADLINE = (
    "year_topics year_topic_counts year_topic_pivot country_topic_counts country_topic_pivot "
    "keyword_counts keyword_top5 clean_numeric clean_locations article_dates metric_parse "
    "titles_publisher affiliations coauthor_edges coauthor_vertices author_pagerank top_authors "
    "new_by_doi insert_new_null_safe merge_keep_last ingest_report quartile_asof "
    "top_cited_per_year page_scalar_fields page_list_fields page_items page_links ranking_rows "
    "csv_roundtrip json_roundtrip parquet_append"
).split()
LONG_SECONDS = 5.0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    taken = {}
    for name in HEADLINE:
        runs = 1 if seconds(name) > LONG_SECONDS else 3
        taken[name] = round(statistics.median(seconds(name) for _ in range(runs)), 3)
    result = {
        "metric": "sum of median query times",
        "value": round(sum(taken.values()), 3),
        "unit": "sec",
        "queries": taken,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
