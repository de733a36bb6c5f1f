"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion through the ``noop`` sink (every row computed, nothing
collected): one warm-up run, then the median of $BENCH_REPEATS timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = [
    "scd2_apply",
    "temporal_apply",
    "temporal_key_master",
    "temporal_hot_keys",
    "keygen_target",
    "land_batch_parquet",
    "variant_flatten_array",
    "period_normalise",
    "explode_tokens_docs",
]


def run(spark, name: str, sf: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="tidemark-bench")
    out = {}
    for name in names:
        run(spark, name, sf)  # warm-up
        out[name] = round(statistics.median(run(spark, name, sf) for _ in range(repeats)), 3)
    sf_label = Path(sf).name.replace("sf", "")
    print(json.dumps({
        "metric": "sum_median_wall_sec", "value": round(sum(out.values()), 3), "unit": "sec",
        "queries": out, "sf": float(sf_label) if sf_label.replace(".", "").isdigit() else sf,
        "cpus": cpus, "repeats": repeats,
    }))


if __name__ == "__main__":
    main()
