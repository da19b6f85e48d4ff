"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR: the tables (default sf0.1). BENCH_CPUS: threads of the local master (default 8).
Each query's result goes to Spark's no-op sink. Every query runs once to warm up and is then timed once.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from veilframe import queries

HEADLINES = [
    "q_k_anonymize_full", "q_best_node", "q_lattice_scores", "q_histogram_categorical", "q_suppress_small_ec", "q_ec_stats",
    "q_hash_salted", "q_mask_positions", "q_mask_regex_literal", "q_mask_class_fixed", "q_mask_mail_in_text",
    "q_charcloak_shape", "q_tokenize", "q_token_vault", "q_fpe_digits_roundtrip", "q_encrypt_xor_roundtrip",
]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINES:
        for _ in range(2):
            began = time.perf_counter()
            queries.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took[name] = round(time.perf_counter() - began, 3)
    sys.stdout.flush()
    print(json.dumps({"metric": "total seconds of the headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
