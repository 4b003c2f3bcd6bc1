"""Benchmark: the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion into Spark's ``noop`` sink (the reference's
``--no-save`` mode: compute everything, write nothing).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "top10_pairs",                     # exact Jaccard, global top 10
    "jaccard_threshold",               # exact Jaccard > 0.9, all pairs
    "jaccard_threshold_len_filtered",  # the same with --length-filter
    "minhash_bucketed",                # MinHash LSH per length bucket
    "minhash_len_filtered",            # the same with --length-filter
    "length_band_pairs",               # length-filtered pair generation
    "sample_per_dataset",              # multi-dataset sampling
    "kmer_vocabulary",                 # k-mer extraction + aggregation over all texts
    "run_config",                      # run-log parsing
]


def main() -> None:
    from kmerscope.plans import registry
    from kmerscope.plans.tables import SCAN_PARTITIONS
    from kmerscope.session import get_session
    from kmerscope.sources.sinks import run_noop

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", app="kmerscope-bench", shuffle_partitions=cpus * 2,
                        extra={"spark.driver.memory": "16g"})
    spark.conf.set(SCAN_PARTITIONS, str(cpus * 2))  # the table is one file
    names = sys.argv[1:] or HEADLINE
    qs = registry.queries()
    times = {}
    for name in names:
        t0 = time.time()
        run_noop(qs[name](spark, sf_dir))
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
        spark.catalog.clearCache()
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
