"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local threads.
Each query is planned and run to completion without collecting its rows; the best of
BENCH_RUNS (default 2) runs counts, so that JVM warm-up is not measured. BENCH_ALL=1 times every query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from granary.plans import catalog  # noqa: E402
from granary.session import get_session  # noqa: E402

HEADLINE = [
    "a01_session_rollup",
    "a02_card_rollup",
    "a03_card_profile",
    "a04_aggregate_per_month",
    "a12_numeric_profile",
    "a18_box_statistics",
    "a20_group_median",
    "a25_long_to_wide",
    "j01_card_features",
    "j02_star_join",
    "j10_fill_brand",
    "j13_fuzzy_pairs",
    "w01_running_index",
    "w03_group_mean",
    "w05_running_product",
    "w07_trailing_mean",
    "w11_run_lengths",
    "u04_rows_occurring_once",
    "p14_percentile_stretch",
    "e01_factorize",
    "m03_standardise",
    "t05_tokens",
    "t12_ngrams_2",
    "t14_id_sequences",
    "t15_common_words",
    "f02_count_vectors",
    "f03_tf_idf",
    "f07_feature_union",
    "f09c_cluster_terms",
    "f10_lda_topics",
    "f11_bm25",
    "l05_repeated_splits",
    "l06d_listing_price_model",
    "l07_series_regressions",
    "l08_boosted_regression",
    "l10_out_of_fold",
    "l13b_permutation_importances",
    "l15_threshold_sweep",
    "x02_session_summary",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog()
    chosen = list(queries) if os.environ.get("BENCH_ALL") else HEADLINE
    times: dict[str, float] = {}
    for name in chosen:
        best = None
        for _ in range(runs):
            started = time.perf_counter()
            queries[name].run(spark, sf).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - started
            best = spent if best is None else min(best, spent)
        times[name] = round(best, 3)
        if os.environ.get("BENCH_ALL"):
            print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
             "sf": os.path.basename(sf.rstrip("/")).replace("sf", "")}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
