"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from checks.queries import QUERIES
from quern.session import build_session, drop_stages

HEADLINE = [
    "word_count",
    "topk_common_words",
    "user_preferences",
    "cooccurrence_counts",
    "recommendations",
    "question_answer_join",
    "posting_vectors",
    "kmeans_3_iterations",
    "kmeans_converged",
    "tokens_clean",
    "top_tokens_by_group",
    "silhouette_by_label",
    "ml_kmeans",
    "text_cluster_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = build_session(
        "quern-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": str(cpus),
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf_dir}/region.parquet").count()  # start-up is not part of a query
    times = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline query time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    drop_stages(spark)
    spark.stop()


if __name__ == "__main__":
    main()
