"""Benchmark: run the headline queries at one scale and print one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
    BENCH_QUERIES (optional comma list to run a subset).

Each query is forced with the ``noop`` sink (full execution, nothing sent to
the driver) and timed end to end, including any driver-side iteration.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from assayspark.plans import QUERIES  # noqa: E402
from assayspark.session import get_session  # noqa: E402

HEADLINE = [
    "m03_variance_select",        # flagship: moments + variance filter + top-n select
    "a04_global_moments",
    "a12_mean_corr_features",
    "a15_median_impute",
    "a17_log2_cpm",
    "u06_keep_first",
    "j06_flag_pairs",
    "j09_extract_sequences",
    "f07_f08_motif_hits",         # motif featurisation (the reference's heaviest data step)
    "a32_generation_stats",
    "f09_f10_encode_decode",
    "x02_stratified_split",
    "x07_weighted_sample",
    "j12_p11_binned_track",
    "w04_bin_means",
    "a36_auc_per_fold",
    "m22_m23_nmf_factors",        # iterative factorisation with smoothing
    "m04_m10_k01_k02_predictions",  # mutation classifier end to end
    "m11_m12_a35_cluster_cells",  # cells: variable genes, PCA, k-means, AMI
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="assayspark-bench")
    # Session warm-up (JVM start, first-job setup) is not charged to the first query.
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {timings[name]:.2f}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total_wall",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "n_queries": len(timings),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
