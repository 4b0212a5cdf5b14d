"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import load  # noqa: E402
from catalog.base import QUERIES  # noqa: E402
from somaloom.session import build_session  # noqa: E402

HEADLINE = [
    "explode_pileup", "pileup_metrics", "variant_pass", "prefilter_aggregate", "nv_nr_long", "complete_grid", "focal_pileup",
    "first_pass", "first_pass_verdict", "second_pass", "betabinom_rho", "bh_adjust", "cell_pvalues", "average_rank",
    "vaf_split", "vaf_split_cell_counts", "scheme_membership", "master_table", "germline_labels", "filter_funnel",
    "best_annotation", "assign_intervals", "mark_duplicates", "coverage_profile", "target_coverage", "threshold_sweep",
    "copy_number_grid", "cnv_summary_metrics", "gc_correct", "log_normalize", "dispersion_topn", "bray_curtis",
    "signature_refit", "place_variants", "alignment_strings", "parse_vcf",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", master=f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR"})
    load()
    spark.range(1000).selectExpr("sum(id)").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
