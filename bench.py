"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: folder of the tables (default /root/testdata/sf0.1). BENCH_CPUS: cores (default 8).
BENCH_RUNS: timed runs per query, of which the median counts (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = """match_phonetic_block match_prefix_block match_multi_pass match_top_k_per_record match_salted
    scores_all_components block_skew_report name_search_phonetic name_search_full name_search_matches
    name_search_batch served_documents search_document search_name_fuzzy match_stats score_histogram
    dataset_fingerprint changed_files incremental_match lsh_candidates embedding_matches entity_clusters
    pair_quality person_quality_profile generated_persons hourly_user_counts file_stream_match""".split()


def main() -> None:
    from workload.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times, counts = {}, {}
    for name in chosen:
        taken = []
        for run in range(runs + 1):   # the first run warms up
            start = time.perf_counter()
            df = QUERIES[name](spark, sf_dir)
            # All columns are produced and counted; nothing is gathered on the driver.
            df.write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
        print(name, times[name], "first", round(taken[0], 3), file=sys.stderr, flush=True)
    people = spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    match_time = times.get("match_phonetic_block") or times.get("match_prefix_block")
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": int(cpus), "rows_per_table": people,
        "matched_rows_per_minute": round(people / match_time * 60) if match_time else None,
    }))


if __name__ == "__main__":
    main()
