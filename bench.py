"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the test data, BENCH_CPUS the local cores. The derived loan
tables are staged before the clock starts; each query is timed from its call to
its last row, including any tables it stages itself. ``pair_scores`` and ``whole_job`` link
the table anew; of the other queries on the linkage the first one stages it for all.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from loanclean import fixture
from loanclean.catalog import QUERIES
from loanclean.session import SETTINGS

HEADLINE = [
    "clean_layer1",
    "purpose_match",
    "date_solver",
    "solver_outcomes",
    "pair_scores",
    "crowded_pairs",
    "dup_triage",
    "duplicate_flags",
    "final_merge",
    "escalation_batches",
    "accuracy",
    "note_repair",
    "category_profile",
    "jaro_winkler_values",
    "whole_job",
    "dirt_log",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("loanclean-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    start = time.perf_counter()
    rows = fixture.raw_loans(spark, sf_dir).count()
    fixture.clean_loans(spark, sf_dir)
    fixture.layer2(spark, sf_dir)
    QUERIES["jaro_winkler_values"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the workers
    setup = time.perf_counter() - start

    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    line = {
        "metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
        "rows": rows, "setup_sec": round(setup, 3), "final_merge_rows_per_sec": round(rows / times["final_merge"]) if "final_merge" in times else None,
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
