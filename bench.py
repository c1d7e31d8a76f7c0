"""Time the headline queries; prints one JSON line.

Settings: BENCH_SF_DIR (tables), BENCH_CPUS (cores), BENCH_QUERIES (comma list, ``all`` for every query).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gleaner.plans.queries import queries  # noqa: E402
from gleaner.session import get_session, scratch_scope  # noqa: E402

HEADLINE = [
    "q_review_stats", "q_top_users", "q_top_words", "q_category_avg", "q_category_avg_all", "q_popular",
    "q_partition_stats", "q_semi_state",
    "q_baskets", "q_itemsets", "q_itemsets_son", "q_itemsets_fpgrowth", "q_pcy_buckets", "q_pcy_pairs",
    "q_tfidf", "q_tfidf_profile", "q_tfidf_top", "q_doc_top_words", "q_content_predict",
    "q_token_dict", "q_minhash", "q_lsh_candidates", "q_jaccard_lsh", "q_jaccard_exact",
    "q_ratings_dedup", "q_pearson_item", "q_pearson_user", "q_cf_item_predict", "q_cf_user_predict",
    "q_cooccur_edges", "q_communities", "q_bloom_probe", "q_fm", "q_fm_windows", "q_reservoir_tags",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    wanted = os.environ.get("BENCH_QUERIES")
    available = queries()
    names = list(available) if wanted == "all" else wanted.split(",") if wanted else HEADLINE

    spark = get_session("bench", f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    available["q_category_avg"](spark, sf_dir).count()  # start the workers
    times = {}
    for name in names:
        start = time.perf_counter()
        with scratch_scope(spark):
            available[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "total wall time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
