"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

A query's time covers building it, any staged intermediate and reading every
result row (a no-op sink). Domain tables are written first and timed on their own.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from locuspark.session import build_session
from locuspark.suite.catalog_of_queries import QUERIES
from locuspark.suite.domain import Domain

HEADLINE = (
    "agg05_mapping_thresholds agg06_qtl_regions agg07_detection_summary_direct pip01_analyze "
    "win01_marker_index joi01_mapping_data joi04_score_causal joi05_peak_causal_overlap "
    "joi11_causal_pvalues agg08_variance_explained agg09_marker_r2 pip04_assess pip06_performance "
    "pip07_verify pip09_legacy_intervals sca05_id_chain win05_dedup_first agg13_allele_frequency "
    "agg14_independent_tests agg15_ld_pairs agg27_process_stats src01_read_gwa snk01_write_mappings "
    "str01_stream_ingest"
).split()
TABLES = (
    "markers marker_set_metadata metadata traits mappings genotypes phenotypes causal_variants "
    "causal_genotypes id_rows raw_rows d_calls d_variants work_tasks work_usage work_files"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", 2 * cpus)
    spark.sparkContext.setLogLevel("ERROR")
    started = time.perf_counter()
    domain = Domain(spark, sf_dir)
    for table in TABLES:
        domain.path(table)
    load = time.perf_counter() - started
    seconds: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall-clock",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "load_tables": round(load, 3),
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
