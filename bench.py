"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is executed to completion with the ``noop`` sink (every row computed, nothing gathered
on the driver); the time includes building the plan (the size measurements are actions). Before
timing, every headline query runs once, untimed, on the smallest test tables, so JVM start-up, JIT
and code generation are not charged to whichever query happens to run first. Each query is then
timed once at the target scale, plus the original's end-to-end job (filter, sort, gzip TSV write)
as ``filter_and_write_tsv``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from varsift.params import FilterParams  # noqa: E402
from varsift.plans.fixtures import FLAGSHIP_GENES, FLAGSHIP_STUDIES, mapped_tables  # noqa: E402
from varsift.plans.gene_filter import VariantTables, plan_gene_filter  # noqa: E402
from varsift.plans.jobs import write_result  # noqa: E402
from varsift.plans.queries import QUERIES  # noqa: E402
from varsift.session import ensure_checkpoint_dir, local_session  # noqa: E402


def filter_and_write(spark, sf_dir: str, out_dir: str) -> None:
    """P1 + P2 end to end, as the original job runs: filter, sort, write a gzip TSV."""
    t = mapped_tables(spark, sf_dir)
    tables = VariantTables(t.consequences, t.variants, t.dbnsfp, t.occurrences, t.diagnoses, t.phenotypes,
                           t.clinvar, t.hgmd, t.studies)
    plan = plan_gene_filter(tables, FLAGSHIP_GENES, FLAGSHIP_STUDIES, FilterParams())
    try:
        write_result(plan.result, out_dir, list(FLAGSHIP_STUDIES))
    finally:
        plan.release()


WARMUP_DIR = "/root/testdata/sf0.001"
HEADLINE = [
    "gene_based_filter",
    "gene_based_filter_old",
    "sorted_result",
    "combined_results",
    "flagged_carriers",
    "carrier_calls",
    "clinical_enrichment",
    "phenotypes_combined",
    "diagnoses_combined",
    "rare_damaging_flag",
    "known_variant_override",
    "multi_study_union",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="varsift-bench")
    warm = WARMUP_DIR if os.path.isdir(WARMUP_DIR) else sf_dir
    for name in names:
        QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()
    out_root = os.path.join(ensure_checkpoint_dir(spark), "bench-output")
    filter_and_write(spark, warm, os.path.join(out_root, "warmup"))
    timings = {}
    if not sys.argv[1:]:
        t0 = time.perf_counter()
        filter_and_write(spark, sf_dir, os.path.join(out_root, "timed"))
        timings["filter_and_write_tsv"] = round(time.perf_counter() - t0, 3)
        spark.catalog.clearCache()
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
        spark.catalog.clearCache()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
