"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query writes its whole result to the no-op sink.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mlframe.plans.catalog import QUERIES  # noqa: E402
from tests.session import make_session  # noqa: E402

HEADLINE = [
    "labeled_points_parse", "bow_term_counts", "vector_sums", "bernoulli_sample", "random_sphere", "kmeans_assign",
    "kmeans_3_rounds", "kmeans_dedupe", "kmeans_pp", "kmeans_pp_2d", "kmeans_bow_step", "logreg_theta",
    "logreg_theta_sgd", "logreg_score", "entropy_by_group", "best_split", "forest_votes", "forest_lineitem",
    "canopy_euclidean", "canopy_jaccard", "doc_jaccard_pairs", "doc_dot_similarity", "hac_single_history",
    "hac_order_edges", "hac_centroid",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = make_session()
    spark.read.parquet(f"{sf_dir}/region.parquet").count()  # start the executors
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


main()
