"""Command line for ``spark-submit``: ``filter`` (P1 + P2) and ``combine``.

    spark-submit -m varsift.cli filter --gene-list genes.txt --occurrences .../occurrences_sd_abc_re_01 \\
        --consequences ... --variants ... --dbnsfp ... --clinvar ... --hgmd ... \\
        --diagnoses ... --phenotypes ... --studies ... --out results/
    spark-submit -m varsift.cli combine --out merged/ results/run1 results/run2 ...

Session sizing (memory, cores, executors) belongs to ``spark-submit``; the job only reads the
session it is given.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from varsift.params import (
    CLINVAR_SIGNIFICANCE,
    DEFAULT_AAF,
    DEFAULT_BASENAME,
    DEFAULT_DPC_L,
    DEFAULT_DPC_U,
    DEFAULT_MAF,
    FilterParams,
)
from varsift.plans.gene_filter import VariantTables, plan_gene_filter
from varsift.plans.jobs import COMBINED_TIE_COLUMNS, combine_results, write_combined, write_result
from varsift.session import ensure_checkpoint_dir
from varsift.sources import readers as RD

TABLES = ("consequences", "variants", "dbnsfp", "clinvar", "hgmd", "occurrences", "diagnoses", "phenotypes",
          "studies")


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="varsift")
    sub = p.add_subparsers(dest="command", required=True)
    f = sub.add_parser("filter", help="gene-based variant filter for one study")
    f.add_argument("--gene-list", required=True, help="text file, one gene symbol per line")
    for t in TABLES:
        f.add_argument(f"--{t}", help=f"{t} table location")
        f.add_argument(f"--{t}-format", default="parquet", help=f"{t} table format (parquet, delta, ...)")
    f.add_argument("--study", action="append", help="study id (default: taken from the occurrences path)")
    f.add_argument("--maf", default=DEFAULT_MAF)
    f.add_argument("--dpc-l", default=DEFAULT_DPC_L)
    f.add_argument("--dpc-u", default=DEFAULT_DPC_U)
    f.add_argument("--aaf", default=DEFAULT_AAF)
    f.add_argument("--known-variants", nargs="+", default=["ClinVar", "HGMD"])
    f.add_argument("--clinvar-significance", nargs="+", default=list(CLINVAR_SIGNIFICANCE),
                   help="ClinVar levels that count as known (add Uncertain_significance for VUS)")
    f.add_argument("--occurrences-parent", help="folder of occurrences_*/study_id=<id> tables, instead of --occurrences")
    f.add_argument("--restrict-occurrences-to-study", action=argparse.BooleanOptionalAction, default=None,
                   help="keep only genotype rows of the listed studies (prunes a study-partitioned table); "
                        "default: if --study is given and the genotype table has a study_id column")
    f.add_argument("--broadcast-max-keys", type=int, default=FilterParams.broadcast_max_keys)
    f.add_argument("--broadcast-max-rows", type=int, default=FilterParams.broadcast_max_rows)
    f.add_argument("--region-bin-size", type=int, default=FilterParams.region_bin_size)
    f.add_argument("--profile", default="new", choices=["new", "old"])
    f.add_argument("--output-basename", default=DEFAULT_BASENAME)
    f.add_argument("--out", required=True, help="output directory")
    f.add_argument("--single-file", action="store_true", help="join the part files to one file")
    f.add_argument("--explain", action="store_true", help="print the physical plan before writing")
    c = sub.add_parser("combine", help="merge the results of many runs")
    c.add_argument("paths", nargs="+", help="run outputs or glob patterns (e.g. results/*.tsv.gz)")
    c.add_argument("--sort-column", action="append", help="tie columns after chromosome and start")
    c.add_argument("--out", required=True)
    c.add_argument("--single-file", action="store_true", help="join the part files to one file")
    return p


def run_filter(spark: SparkSession, args: argparse.Namespace) -> str:
    params = FilterParams(maf=args.maf, dpc_l=args.dpc_l, dpc_u=args.dpc_u, aaf=args.aaf,
                          known_variants=tuple(args.known_variants), profile=args.profile,
                          clinvar_significance=tuple(args.clinvar_significance),
                          broadcast_max_keys=args.broadcast_max_keys, broadcast_max_rows=args.broadcast_max_rows,
                          region_bin_size=args.region_bin_size, output_basename=args.output_basename)
    needed = {"consequences", "variants", "dbnsfp", "occurrences", "diagnoses", "phenotypes"}
    needed |= {"clinvar"} if params.use_clinvar else set()
    needed |= {"hgmd"} if params.use_hgmd else set()
    needed |= {"studies"} if params.profile.has_studies_table else set()
    if args.occurrences_parent:
        needed -= {"occurrences"}
        if not args.study:
            raise SystemExit("--occurrences-parent needs --study")
    missing = sorted(t for t in needed if not getattr(args, t))
    if missing:
        raise SystemExit(f"missing table locations: {', '.join(missing)}")
    frames = {t: RD.read_table(spark, getattr(args, t), getattr(args, f"{t}_format")) if getattr(args, t) else None
              for t in TABLES}
    studies = args.study or [RD.study_from_path(args.occurrences)]
    if args.occurrences_parent:
        frames["occurrences"] = RD.read_study_partitions(spark, args.occurrences_parent, studies, args.occurrences_format)
    restrict = args.restrict_occurrences_to_study
    if restrict is None:
        restrict = bool(args.study) and "study_id" in frames["occurrences"].columns
    genes = RD.gene_values(RD.read_gene_list(spark, args.gene_list))
    plan = plan_gene_filter(VariantTables(**frames), genes, studies, params, restrict)
    if args.explain:
        plan.result.explain("formatted")
    try:
        return write_result(plan.result, args.out, studies, params, single_file=args.single_file)
    finally:
        plan.release()


def run_combine(spark: SparkSession, args: argparse.Namespace) -> str:
    ties = tuple(args.sort_column) if args.sort_column else None
    paths = RD.expand_result_paths(spark, args.paths)
    if not paths:
        raise SystemExit(f"no result files match {args.paths}")
    ties = ties or COMBINED_TIE_COLUMNS
    return write_combined(combine_results(spark, paths, ties), args.out, single_file=args.single_file)


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(f"varsift-{args.command}").getOrCreate()
    ensure_checkpoint_dir(spark)
    out = run_filter(spark, args) if args.command == "filter" else run_combine(spark, args)
    print(out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
