"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = [
    "count_nonblank",
    "group_count_sorted",
    "topk_count",
    "intersect_sorted",
    "csv_malformed_audit",
    "scan_documents_sgml",
    "row_index",
    "topk_per_group",
    "profile_table",
    "box_summary",
    "numeric_facet",
    "cluster_keys",
    "fingerprint_ngram_char",
    "token_doc_pairs",
    "inverted_index_sorted",
    "inverted_index_single_pass",
    "search_or",
    "search_batch",
    "informativeness",
    "afinn_score_doc",
    "page_texts",
    "html_record_extract",
    "kmeans_pages",
    "means_and_interaction",
    "bias_only_rmse",
    "als_bias_rmse",
    "onehot_shared_vocab",
    "decision_tree_churn",
    "classification_report",
    "incremental_append_stream",
    "random_forest",
    "logreg_multinomial",
    "cluster_report",
    "search_saved_index",
    "merge_spellings",
    "boosted_trees",
    "median_exact",
    "search_segments",
    "csv_repair",
    "html_references",
    "anti_join_bucketed",
    "sketches_by_day",
    "pivot_sparse",
]


def main() -> None:
    from tamarack.plans import REGISTRY
    from tamarack.session import drop_scratch, local_session

    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    REGISTRY["count_rows"].run(spark, root).collect()  # start-up is not measured
    wanted = sys.argv[1:] or HEADLINES
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        REGISTRY[name].run(spark, root).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        drop_scratch(spark)
    scale = os.path.basename(root.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
