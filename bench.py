"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the local cores. Every
query writes its whole result to the no-op sink, so nothing is pruned away or collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tabloom.queries import QUERIES  # noqa: E402
from tabloom.session import local_session  # noqa: E402

HEADLINE = """
s08_read_ratings s19_save_partitioned f01_parse_log f15_normalize_text f17_tokenize w11_top_error_endpoints
a07_daily_hosts a14_word_count a25_longtail a32_mean_median a36_autocorrelation j01_rating_view j03_co_ratings
j05_unseen_items w01_topn_rank w04_last_items w06_norm_rating w14_split_per_user e04_percentile_scale
e05_index_strings e08_bag_of_words e10_tfidf r02_popular_unseen r04_assoc_confidence r08_frequent_itemsets
r13_user_sim_pearson r14_cosine_items r18_matrix_factorisation r24_rank_metrics m02_tree_classifier m07_knn
m11_naive_bayes m12_compare_models m17_auc m34_dbscan m37_pagerank m39_matrix_product m40_kalman_ma2
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM and code generation warm-up
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
