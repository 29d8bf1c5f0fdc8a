"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of cores.
Every query is built and run in full; the rows go to Spark's "noop" sink.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from scoreline.catalog import QUERIES
from scoreline.session import build_session

HEADLINE = [
    "src_projected_scan", "src_json_flatten", "src_html_extract", "agg_mean_by_keys", "agg_mode", "agg_count_pivot",
    "agg_team_record", "join_left", "join_role_playing", "join_map_lookup", "win_rank_average_desc",
    "win_rolling_last_n_mean", "dedupe_keep_last", "upsert_latest", "upsert_delete_append", "sample_n_seeded", "topk",
    "stat_minmax_scale", "stat_corr_matrix", "stat_player_rank", "eval_roc_auc", "ml_stratified_folds",
    "flow_match_features", "flow_role_matchup", "stream_upsert_latest", "ml_rf_classifier", "pred_noise_ensemble",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    with tempfile.TemporaryDirectory(prefix="scoreline-bench-") as shared:
        measure(build_session(f"local[{cpus}]", max(cpus, 4), "scoreline-bench", shared), folder, cpus)


def measure(spark: SparkSession, folder: str, cpus: int) -> None:
    spark.sparkContext.setLogLevel("OFF")
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("topk")  # start the JVM's compiler and the file readers
    seconds = {name: run(name) for name in names}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
