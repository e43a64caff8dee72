"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from gridcast.plans.queries import QUERIES
from gridcast.store import release

HEADLINE = (
    "count_by_session",
    "silver",
    "row_loss",
    "gold",
    "label_join",
    "driver_leaders",
    "session_profile",
    "feature_summary_approx",
    "feature_corr_by_session",
    "weight_audit",
    "session_scores",
    "rank_drivers",
    "subsample_uncertainty",
    "winner_history",
    "roundtrip_partitioned",
    "train_score",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gridcast-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        # Wide generated methods are compiled, too.
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods -XX:+UseParallelGC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="gridcast-bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Start the engine itself before the clock.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()

    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        start = time.perf_counter()
        # Every row and column is computed; nothing is collected.
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        release(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
