"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query
runs once to warm up and then ``BENCH_RUNS`` times; the fastest run counts. All
output columns are computed: the rows go to Spark's ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import time

import pyspark

from newsflow.plans.catalog import QUERIES
from newsflow.session import local_session

HEADLINE = (
    "language_stats", "extract_articles", "extract_pages", "decode_doc_id", "date_int_writeback",
    "split_sentences", "tokens", "annotated_documents", "explode_sentences", "publish_json",
    "decode_message", "code_actors", "code_verbs", "phrases_by_doc", "phrases_by_sentence",
    "flatten_events", "skip_processed", "merge_annotations", "shuffled_cap", "xml_articles",
    "batch_stats", "progress", "stream_annotate",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, app="newsflow-bench")
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        once(name)
        seconds[name] = round(min(once(name) for _ in range(runs)), 3)
    size = QUERIES["language_stats"](spark, sf_dir).groupBy().sum("documents", "sentences", "words", "bytes").first()
    documents, sentences, words, volume = size
    per_second = {
        name: {
            "documents": round(documents / seconds[name]),
            "sentences": round(sentences / seconds[name]),
            "mb": round(volume / seconds[name] / 1e6, 2),
        }
        for name in ("split_sentences", "annotated_documents", "code_actors", "phrases_by_doc", "stream_annotate")
    }
    print(json.dumps({
        "metric": "headline_total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "input": {"documents": documents, "sentences": sentences, "words": words, "bytes": volume},
        "per_second": per_second, "cpus": cpus, "spark": pyspark.__version__,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
