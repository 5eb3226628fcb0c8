"""Wall-clock seconds per query: prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` choose data and cores.  Results go to the noop
sink, so every column of every row is computed and nothing is written.
"""

from __future__ import annotations

import json
import os
import sys
import time

from reviewmill.queries import tables
from reviewmill.queries.catalog import QUERIES
from reviewmill.session import local_session

# Whole-table operators of every family, and every fit.
HEADLINE = [
    "course_sentiment_top40", "normalize_reviews", "union_sources", "source_audit", "mask_pii", "mask_counts",
    "clean_dedupe", "removed_rows", "label_5class_3class", "label_distribution", "sample_fixed_n", "stratified_split",
    "course_holdout", "balanced_sample", "token_counts", "bigram_counts", "vocabulary_topk", "doc_term_counts",
    "tfidf_weights", "naive_bayes_model", "naive_bayes_predict", "train_logreg", "metrics_sentiment",
    "metrics_multilabel", "confusion_matrix", "topic_keywords", "topic_summary", "improvement_matrix", "lda_topics",
    "error_taxonomy", "error_cases_topn", "data_summary", "train_linear_svm", "train_random_forest", "train_multilabel_ovr",
    "train_multilabel_variant", "train_embedding_classifier", "ablation_grid",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    tables.PARTS = int(cores)  # each given table is one small file
    QUERIES["label_distribution"](spark, sf_dir).count()  # start the JVM's compilers
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total wall-clock of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
