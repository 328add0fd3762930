"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``: one JSON line.

Each query is run once to completion into the no-op sink, after one warm-up
scan of the session. Names on the command line select queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from recoflow.plans.catalog import QUERIES
from recoflow.session import local_session

BENCH_QUERIES = [
    "user_article_basic", "interest_top10", "profile_basics", "window_merge", "strip_html",
    "idf_table", "tfidf_top20", "textrank_top20", "article_profile", "article_vector_mean",
    "similar_top10", "content_recall", "history_anti", "hot_top10", "hot_parts", "recall_union",
    "user_features", "article_features", "ctr_samples", "auc_accuracy", "feed_split",
    "serve_waiting", "history_page", "track_payload", "latest_upsert", "stream_hot", "stream_recall",
    "similar_incremental", "wait_split", "als_recall", "ctr_scores", "word2vec_vocabulary",
    "nearest_top10", "nearest_indexed", "serve_lines", "stream_recall_state",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus, partitions=cpus)
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in sys.argv[1:] or BENCH_QUERIES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline queries, total time", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
