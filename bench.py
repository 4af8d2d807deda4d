"""Wall time of the headline queries.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1), runs on
local[$BENCH_CPUS] and prints one JSON line. Each query is run once to warm up
and then timed over $BENCH_RUNS runs (default 3, one for runs of 20 s or more);
the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerleaf import catalog  # noqa: E402
from ledgerleaf.session import build_session  # noqa: E402

HEADLINE = (
    "feat_customer",
    "feat_mode_wide",
    "feat_agg_wide",
    "job_customer_features",
    "feat_assemble_train",
    "join_fold_left",
    "join_enrich",
    "join_find_duplicates",
    "agg_history",
    "agg_mode",
    "agg_pivot_tags",
    "agg_summary",
    "agg_dedup_key",
    "sort_composite",
    "set_subtract",
    "clean_null_sentinel",
    "src_text_raw",
    "src_quarantine_valid",
    "label_minmax_weighted",
    "label_multi_task",
    "split_hash",
    "feat_dictionary",
    "feat_encode",
    "job_libsvm",
    "job_import_join",
    "eval_confusion",
    "eval_ks",
    "eval_auc_rounded",
    "eval_auc_exact",
    "eval_aupr",
    "eval_ndcg",
    "fn_stopwords",
    "fn_tokenize",
    "vec_dot",
    "mat_multiply",
    "stream_word_count_batch",
    "stream_sliding_3_2",
    "ml_gbt_classifier",
    "ml_kmeans",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:] or HEADLINE
    partitions = os.cpu_count() if cpus == "*" else int(cpus)
    spark = build_session(
        "ledgerleaf-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=partitions,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "6g"),
        spark__checkpoint__dir=os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="ledgerleaf-bench-"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = catalog.queries()

    def once(name: str) -> float:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in chosen:
        # Every query is warmed up; one that takes long is then timed once.
        first = once(name)
        timed = [once(name) for _ in range(runs if first < 20 else 1)]
        seconds[name] = round(statistics.median(timed), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
