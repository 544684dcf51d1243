"""Time the headline queries; prints one JSON line.

Settings: BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
Each query runs once to warm up and then BENCH_RUNS times (default 2); the best
run counts. Results go to the no-op sink, so every row is computed. Queries of
PIPELINE derive everything from the raw tables; those of PREPARED start from the
stored table of indexed ratings, as evaluation and serving do.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ratingloom import catalog, fixtures  # noqa: E402
from ratingloom.session import build_session  # noqa: E402

PIPELINE = (
    "clean_ratings",
    "dataset_statistics",
    "filter_inactive",
    "indexed_ratings",
    "top_rated_movies",
    "explore_summary",
    "prepare_job",
    "cold_warm_rmse",
)
PREPARED = (
    "topn_from_factors",
    "topn_exclude_seen",
    "batch_recommend",
    "precision_recall_at_k",
    "catalog_coverage",
    "popularity_bias",
    "evaluation_suite",
    "als_topn_counts",
    "train_job",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in PIPELINE + PREPARED:
        if name == PREPARED[0]:
            fixtures.prepare_once(spark, folder)
        timed(name)
        seconds[name] = round(min(timed(name) for _ in range(runs)), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
