"""Registered queries: one per operator group of the inventory, run over the mapped test tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column names equal those of
the matching oracle statement in ``varsift.plans.oracle``. Arrays are rendered as ``|``-joined text
so both engines print the same cells.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varsift.functions import expressions as X
from varsift.operators import annotations as A
from varsift.operators import clinical as C
from varsift.operators import flags as FL
from varsift.operators import occurrences as O
from varsift.operators import ordering as R
from varsift.operators.annotations import KEY, GeneSet
from varsift.params import CLINVAR_SIGNIFICANCE_WITH_VUS, FilterParams
from varsift.plans.fixtures import FLAGSHIP_GENES, FLAGSHIP_STUDIES, MappedTables, mapped_tables
from varsift.plans.gene_filter import (
    AnnotationPlan,
    GeneFilterPlan,
    VariantTables,
    plan_annotations,
    plan_gene_filter,
    plan_seen,
)
from varsift.plans.incremental import ResultLedger, StudyRelease, merged_results, update_results
from varsift.plans.jobs import combine_results, write_combined, write_result
from varsift.plans.thresholds import ThresholdGrid, threshold_surface
from varsift.session import ensure_checkpoint_dir
from varsift.sources import readers as RD
from varsift.sources.sinks import bucket_count, write_clustered, write_tsv

Query = Callable[[SparkSession, str], DataFrame]

GENES = GeneSet(FLAGSHIP_GENES)
STUDIES = list(FLAGSHIP_STUDIES)
PARAMS = FilterParams()


def render(df: DataFrame) -> DataFrame:
    """Array columns as ``|``-joined text."""
    return df.select(*[X.render_list(f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
                       for f in df.schema.fields])


def _tables(spark: SparkSession, sf_dir: str) -> MappedTables:
    return mapped_tables(spark, sf_dir)


def _variant_tables(t: MappedTables) -> VariantTables:
    return VariantTables(t.consequences, t.variants, t.dbnsfp, t.occurrences, t.diagnoses, t.phenotypes,
                         t.clinvar, t.hgmd, t.studies)


def _gene_consequences(t: MappedTables) -> DataFrame:
    return A.canonical_consequences(t.consequences, GENES, STUDIES)


def _flagship(t: MappedTables, **params) -> GeneFilterPlan:
    return plan_gene_filter(_variant_tables(t), GENES, STUDIES, FilterParams(**params) if params else PARAMS)


def _annotations(t: MappedTables, **params) -> AnnotationPlan:
    return plan_annotations(_variant_tables(t), GENES, STUDIES, FilterParams(**params) if params else PARAMS)


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder for a query's files, in the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _ranked_as_written(spark: SparkSession, path: str, options: RD.ResultReadOptions, keys: list[R.SortKey],
                       name: str) -> DataFrame:
    """A written result with each row's place in the files turned into a rank: the place of the first row
    that has its sort key. Equal to SQL's rank() only if the files hold the rows in order.

    Places are counted within each split of a file and shifted by the sizes of the splits before it.
    """
    split = F.concat_ws(":", F.input_file_name(), F.lpad(F.input_file_block_start().cast("string"), 20, "0"))
    rows = RD.read_result(spark, path, options).withColumn("__file", split).withColumn(
        "__at", F.monotonically_increasing_id())
    sizes = rows.groupBy("__file").count().orderBy("__file").collect()  # one row for each split
    before, total = [], 0
    for r in sizes:
        before.append((r["__file"], total))
        total += r["count"]
    offsets = spark.createDataFrame(before, "__file string, __before long")
    names = [f"__k{i}" for i in range(len(keys))]
    within = F.row_number().over(Window.partitionBy("__file").orderBy("__at"))
    placed = rows.withColumn("__within", within).join(F.broadcast(offsets), "__file").withColumn(
        "__place", F.col("__before") + F.col("__within")).select("*", *[k.expr.alias(n) for k, n in zip(keys, names)])
    first = F.min("__place").over(Window.partitionBy(*names))
    return placed.withColumn(name, first.cast("long"))


# --- queries --------------------------------------------------------------------------------

def q_gene_list_clean(spark, sf_dir):
    """A1 over gene-list lines made from every part row (some with U+00A0 / newline inside)."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    k = F.col("p_partkey")
    line = F.concat(
        F.when(k % 5 == 0, F.concat(F.lit("\u00a0"), F.col("p_brand"))).otherwise(F.col("p_brand")),
        F.when(k % 4 == 1, F.lit("\u00a0")).when(k % 4 == 2, F.lit("\n")).when(k % 4 == 3, F.lit(" ")).otherwise(
            F.lit("")))
    return part.select(k.alias("p_partkey"), X.clean_gene_line(line).alias("gene"))


def q_canonical_gene_filter(spark, sf_dir):
    """Canonical consequences of the listed genes."""
    return render(_gene_consequences(_tables(spark, sf_dir)))


def q_study_overlap(spark, sf_dir):
    """Study overlap of every variant (never null)."""
    t = _tables(spark, sf_dir)
    return t.variants.select(*KEY, X.overlaps_any("studies.study_id", ["SD_B", "SD_Z"]).alias("in_study"))


def q_chromosome_restrict(spark, sf_dir):
    """B4 + E4: dbNSFP rows on the chromosomes of the gene consequences (as the filter of the plan)."""
    t = _tables(spark, sf_dir)
    return A.chromosome_filter(_gene_consequences(t))(t.dbnsfp).select(*KEY, "DamagePredCount")


def q_damage_ratio(spark, sf_dir):
    """Damaging-to-total prediction ratio of every dbNSFP row."""
    t = _tables(spark, sf_dir)
    return A.damage_predictions(t.dbnsfp).select(*KEY, "DamagePredCount", "PredCountRatio_D2T")


def q_max_population_af(spark, sf_dir):
    """C2 + C3: flattened frequencies and their maximum for every variant."""
    t = _tables(spark, sf_dir)
    return A.variant_frequencies(t.variants, None)


def q_clinvar_first_gene(spark, sf_dir):
    """First gene of every ClinVar record."""
    t = _tables(spark, sf_dir)
    return t.clinvar.select(*KEY, F.col("name").alias("VariationID"), X.first_gene("geneinfo").alias("first_gene"))


def q_clinvar_significance(spark, sf_dir):
    """ClinVar records with a pathogenic / likely pathogenic element."""
    t = _tables(spark, sf_dir)
    df = t.clinvar.where(X.has_significance("clin_sig"))
    return render(df.select(*KEY, F.col("name").alias("VariationID"), "clin_sig"))


def q_hgmd_class(spark, sf_dir):
    """HGMD records of a disease-causing class."""
    t = _tables(spark, sf_dir)
    return t.hgmd.where(X.is_disease_causing_class("variant_class")).select(
        *KEY, F.col("id").alias("HGMDID"), "variant_class")


def q_allele_fraction(spark, sf_dir):
    """Variant allele fraction of every genotype row."""
    t = _tables(spark, sf_dir)
    return render(t.occurrences.select(*KEY, "biospecimen_id", "ad",
                                       X.allele_fraction("ad").alias("variant_allele_fraction")))


def q_adjusted_calls(spark, sf_dir):
    """Adjusted calls of every genotype row."""
    t = _tables(spark, sf_dir)
    df = O.with_adjusted_calls(t.occurrences, PARAMS.aaf)
    return render(df.select(*KEY, "biospecimen_id", "calls", "variant_allele_fraction", "adjusted_calls"))


def q_participant_id_norm(spark, sf_dir):
    """Normalised participant ids of every diagnosis row."""
    t = _tables(spark, sf_dir)
    return t.diagnoses.select("participant_fhir_id",
                              X.normalise_participant("participant_fhir_id").alias("participant_id"))


def q_chromosome_sort_key(spark, sf_dir):
    """C11 + C12: sort key, level and rank of every variant's chromosome."""
    t = _tables(spark, sf_dir)
    return t.variants.select(
        *KEY, X.chromosome_sort_key("chromosome").alias("chromosome_key"),
        X.chromosome_level("chromosome").alias("chromosome_level"),
        X.chromosome_rank("chromosome").alias("chromosome_rank"))


def q_study_from_path(spark, sf_dir):
    """A4 over directory names built from every genotype row (some without the ``_re_`` marker)."""
    t = _tables(spark, sf_dir)
    path = F.concat(
        F.lit("s3a://lake/genotypes/occurrences_"), F.lower("study_id"),
        F.when(F.col("is_hi_conf_denovo"), F.lit("_v")).otherwise(F.lit("_re_")),
        F.lpad((F.col("dp") % 100).cast("string"), 3, "0"), F.lit("/part-0.parquet"))
    return t.occurrences.select("biospecimen_id", path.alias("path")).select(
        "biospecimen_id", "path", X.study_id_from_path("path").alias("study_id"))


def q_sorted_result(spark, sf_dir):
    """P2 + F1 + A6 + A7 + A9: the result sorted and written by the job, read back with the result reader; the
    rank column is each row's place in the files."""
    plan = _flagship(_tables(spark, sf_dir))
    try:
        path = write_result(plan.result, _scratch(spark, "result"), STUDIES, PARAMS)
    finally:
        plan.release()
    ranked = _ranked_as_written(spark, path, RD.ResultReadOptions(), R.result_keys(), "result_rank")
    return ranked.select("result_rank", "chromosome", "start", "study_code", "family_id", "is_proband",
                         "participant_id", "biospecimen_id")


def q_result_round_trip(spark, sf_dir):
    """A6 + A7 + S8: awkward cells written and read back: line breaks, tabs, quotes, empty text and nulls in quoted
    cells, whole numbers written as ``30.0`` and ``1e3``."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    k = F.col("p_partkey")
    awkward = part.select(
        F.col("p_brand").alias("symbol"), k.cast("string").alias("participant_id"),
        F.when(k % 3 == 0, F.concat((k % 1000).cast("string"), F.lit(".0"))).when(k % 3 == 1, F.lit("1e3"))
        .otherwise((k % 1000).cast("string")).alias("dp"),
        F.concat((k * 10).cast("string"), F.when(k % 2 == 0, F.lit(".0")).otherwise(F.lit(""))).alias("start"),
        F.when(k % 6 == 0, F.concat(F.lit("a\nb"), F.col("p_name"))).when(k % 6 == 1, F.lit("tab\there"))
        .when(k % 6 == 2, F.lit('say "yes"')).when(k % 6 == 3, F.lit("")).when(k % 6 == 4, F.lit(None).cast("string"))
        .otherwise(F.col("p_name")).alias("phen"))
    path = _scratch(spark, "round-trip")
    write_tsv(awkward, path)
    return RD.read_result(spark, path)


def q_result_cells(spark, sf_dir):
    """A6 + A7 + D8: array and struct cells of every genotype row written and read back: known columns by their types,
    others by the schema that all cells of the column allow."""
    t = _tables(spark, sf_dir)
    rows = t.occurrences.select(
        *KEY, "biospecimen_id", "ad", "calls", F.when(F.col("dp") % 3 == 0, F.array(F.lit("Pathogenic"), F.col("filter")))
        .when(F.col("dp") % 3 == 1, F.array().cast("array<string>")).alias("clin_sig"),
        F.when(F.col("dp") % 4 > 0, F.array((F.col("dp") / 4), F.lit(None).cast("double"))).alias("shares"),
        F.when(F.col("dp") % 5 > 0, F.array(F.struct(F.col("dp").alias("depth"), F.col("filter")))).alias("notes"),
        F.struct(F.col("has_alt").alias("alternate"), F.col("is_proband")).alias("site"))
    path = _scratch(spark, "cells")
    write_tsv(rows, path)
    back = RD.read_typed_results(spark, [path])
    kinds = [F.lit(back.schema[c].dataType.simpleString()).alias(f"{c}_type") for c in ("ad", "calls", "clin_sig", "shares", "notes", "site")]
    note = F.col("notes")[0]
    return render(back.select(
        *KEY, "biospecimen_id", "ad", "calls", "clin_sig", F.try_element_at("shares", F.lit(1)).alias("share"),
        F.size("shares").alias("n_shares"), note["depth"].alias("depth"), note["filter"].alias("note_filter"),
        F.col("site.alternate").alias("site_alternate"), F.col("site.is_proband").alias("site_proband"), *kinds))


def q_result_types(spark, sf_dir):
    """The types guessed for the columns of three runs' files, for each run and for all of them together, from every
    genotype row (the runs disagree: whole numbers, fractions, more than 64 bits, true/false, text, nothing)."""
    t = _tables(spark, sf_dir)
    dp = F.col("dp").cast("long")
    rows = t.occurrences.select("study_id", F.concat("biospecimen_id", F.lit("")).alias("sample"), dp.alias("depth"),
                                (dp / 8).alias("level"), F.concat(dp.cast("string"), F.lit("0" * 20)).alias("large"),
                                F.col("is_proband").alias("carrier"), F.lit(None).cast("string").alias("empty"), "filter")
    out = _scratch(spark, "typed")
    first = rows.where("study_id = 'SD_A'").drop("study_id")
    second = rows.where("study_id <> 'SD_A'").drop("study_id")
    write_tsv(first, f"{out}/one")
    write_tsv(second.withColumn("depth", F.col("level")).withColumn("carrier", F.col("carrier").cast("string")), f"{out}/two")
    write_tsv(second.withColumn("large", F.col("depth")).withColumn("carrier", F.col("depth")).drop("level"), f"{out}/three")
    paths = [f"{out}/{n}" for n in ("one", "two", "three")]
    merged, runs = RD.guess_result_types(spark, paths)
    found = [("all", c, k.simpleString()) for c, k in merged.items()]
    found += [(p.rsplit("/", 1)[-1], c, k.simpleString()) for p, own in runs.items() for c, k in own.items()]
    return spark.createDataFrame(found, "run string, column_name string, type string")


def q_single_file_result(spark, sf_dir):
    """A8 + F1: every credible carrier sorted by all tasks and joined to one plain TSV file, read back; the rank column
    is each row's place in that file."""
    t = _tables(spark, sf_dir)
    rows = O.credible_carriers(t.occurrences, PARAMS.aaf).select(
        *KEY, "participant_id", "biospecimen_id", "study_id", "family_id", "is_proband")
    ties = ("study_id", "family_id", "is_proband")
    path = f"{_scratch(spark, 'single')}/carriers.tsv"
    write_tsv(rows, path, compression="none", quote=False, single_file=True, order=R.result_row_order(rows, ties))
    ranked = _ranked_as_written(spark, path, RD.ResultReadOptions(quote=""), R.result_keys(ties), "result_rank")
    return ranked.select("result_rank", *KEY, "participant_id", "biospecimen_id", "study_id", "family_id", "is_proband")


def q_join_consequence_variant(spark, sf_dir):
    """J1 (+ D5): gene consequences x the study's variants."""
    plan = _annotations(_tables(spark, sf_dir))
    return plan.detached(render(plan.gene_variants))


def q_join_damage_left(spark, sf_dir):
    """J2 + C1 + C8: left join of damage predictions and the rarity flag."""
    plan = _annotations(_tables(spark, sf_dir))
    return plan.detached(plan.annotated.select(*KEY, "max_gnomad_topmed", *A.DAMAGE_COLUMNS, "flag"))


def q_clinvar_seen(spark, sf_dir):
    """J3 + B5 + B6 + C4: ClinVar records of the genes seen in the study's variants."""
    t = _tables(spark, sf_dir)
    plan = plan_seen(A.clinvar_candidates(t.clinvar, GENES, PARAMS.clinvar_significance), t.variants, STUDIES, PARAMS)
    return plan.detached(render(plan.seen))


def q_hgmd_seen(spark, sf_dir):
    """J4 + B8 + C4: HGMD records of the genes seen in the study's variants."""
    t = _tables(spark, sf_dir)
    plan = plan_seen(A.hgmd_candidates(t.hgmd, GENES), t.variants, STUDIES, PARAMS)
    return plan.detached(render(plan.seen))


def q_clinvar_seen_with_vus(spark, sf_dir):
    """As clinvar_seen, with uncertain significance counted as known."""
    plan = _annotations(_tables(spark, sf_dir), clinvar_significance=CLINVAR_SIGNIFICANCE_WITH_VUS)
    return plan.detached(render(plan.clinvar_seen))


def q_rare_damaging_flag(spark, sf_dir):
    """C8 over every variant of both studies (not only the listed genes)."""
    t = _tables(spark, sf_dir)
    cand = FL.annotate_candidates(A.variant_frequencies(t.variants, None), A.damage_predictions(t.dbnsfp),
                                  PARAMS.maf, PARAMS.dpc_l, PARAMS.dpc_u)
    return cand.select(*KEY, "max_gnomad_topmed", "PredCountRatio_D2T", "flag")


def q_known_variant_override(spark, sf_dir):
    """J5 + J6 + C9 + B15: flags after the ClinVar and HGMD overrides."""
    plan = _annotations(_tables(spark, sf_dir))
    return plan.detached(plan.candidates.select(*KEY, "VariationID", "HGMDID", "flag"))


def q_carrier_calls(spark, sf_dir):
    """C6 + C7 + B9-B11: credible carriers among all genotype rows."""
    t = _tables(spark, sf_dir)
    df = O.credible_carriers(t.occurrences, PARAMS.aaf)
    return render(df.select(*KEY, "biospecimen_id", "participant_id", "variant_allele_fraction", "adjusted_calls"))


def q_flagged_carriers(spark, sf_dir):
    """J7 + B12 + C5: carriers of the flagged variants."""
    plan = _flagship(_tables(spark, sf_dir))
    return plan.detached(render(plan.carriers.select(*KEY, "participant_id", "biospecimen_id", "symbol", "VariationID",
                                                     "HGMDID", "adjusted_calls")))


def q_flagged_carriers_large_sets(spark, sf_dir):
    """J7 as it runs beyond all broadcast bounds: genotype rows cut by a Bloom filter of the flagged keys, then the
    exact join; J1, J2, J5 and J6 by shuffle joins."""
    plan = _flagship(_tables(spark, sf_dir), broadcast_max_keys=0, broadcast_max_rows=0)
    return plan.detached(render(plan.carriers.select(*KEY, "participant_id", "biospecimen_id", "symbol", "VariationID",
                                                     "HGMDID", "adjusted_calls")))


def q_clustered_genotype_join(spark, sf_dir):
    """A2 + J7: the genotype table written once in buckets by variant key, then joined beyond the broadcast bounds with
    no exchange of the genotypes."""
    t = _tables(spark, sf_dir)
    name = f"genotypes_{uuid.uuid4().hex}"
    clustered = write_clustered(t.occurrences, name, KEY, bucket_count(t.occurrences), _scratch(spark, "clustered"))
    tables = replace(_variant_tables(t), occurrences=clustered)
    plan = plan_gene_filter(tables, GENES, STUDIES, FilterParams(broadcast_max_keys=0, broadcast_max_rows=0))
    return plan.detached(render(plan.carriers.select(*KEY, "participant_id", "biospecimen_id", "symbol", "VariationID",
                                                     "HGMDID", "adjusted_calls")))


def q_diagnoses_combined(spark, sf_dir):
    """E1 + C10: sorted distinct diagnosis texts per participant."""
    return render(C.diagnoses_combined(_tables(spark, sf_dir).diagnoses))


def q_hpo_codes(spark, sf_dir):
    """E6 + E7 + B14: HPO codes of every phenotype row."""
    return C.hpo_codes(_tables(spark, sf_dir).phenotypes)


def q_phenotypes_combined(spark, sf_dir):
    """E2 + J9 + B13: phenotype texts and HPO codes per participant."""
    return render(C.phenotypes_combined(_tables(spark, sf_dir).phenotypes))


def q_clinical_enrichment(spark, sf_dir):
    """J10-J12 over every credible carrier (not only the flagged ones)."""
    t = _tables(spark, sf_dir)
    carriers = O.credible_carriers(t.occurrences, PARAMS.aaf).select(
        *KEY, "participant_id", "biospecimen_id", "study_id")
    return render(C.enrich(carriers, t.diagnoses, t.phenotypes, t.studies))


def q_combined_results(spark, sf_dir):
    """P3 + F2 + F3 + A6 + A8 + C12: two runs with different column sets, each written by its job, merged from
    their files and written as one plain TSV; the rank column is each row's place in the merged files."""
    vt = _variant_tables(_tables(spark, sf_dir))
    out = _scratch(spark, "combined")
    for study, database in (("SD_A", "ClinVar"), ("SD_B", "HGMD")):
        plan = plan_gene_filter(vt, GENES, [study], FilterParams(known_variants=(database,)))
        try:
            write_result(plan.result, f"{out}/runs", [study])
        finally:
            plan.release()
    merged = combine_results(spark, RD.expand_result_paths(spark, [f"{out}/runs/*.tsv.gz"]))
    path = write_combined(merged, f"{out}/merged")
    ranked = _ranked_as_written(spark, path, RD.ResultReadOptions(quote=""),
                                R.combined_keys(["study_code", "family_id", "is_proband"]), "combined_rank")
    return ranked.select("study_id", "participant_id", "biospecimen_id", "chromosome", "start", "family_id", "is_proband",
                         "study_code", "VariationID", "HGMDID", "combined_rank")


def q_multi_study_union(spark, sf_dir):
    """A5 + F4: genotype rows of two studies from one read."""
    t = _tables(spark, sf_dir)
    return RD.occurrences_for_studies(t.occurrences, ["SD_A", "SD_B"]).select(*KEY, "biospecimen_id", "study_id")


def q_study_partitions(spark, sf_dir):
    """A5 + F4: the genotype table written as two folders of study partitions and read back for both studies."""
    t = _tables(spark, sf_dir)
    parent = _scratch(spark, "lake")
    rows = t.occurrences.select(*KEY, "biospecimen_id", "is_proband", "study_id")
    for name, own in (("occurrences_sd_a_re_1", F.col("is_proband")), ("occurrences_sd_b_re_2", ~F.col("is_proband"))):
        rows.where(own).drop("is_proband").write.partitionBy("study_id").parquet(f"{parent}/{name}")
    return RD.read_study_partitions(spark, parent, ["SD_A", "SD_B"]).select(*KEY, "biospecimen_id", "study_id")


def q_gene_based_filter(spark, sf_dir):
    """P1, the flagship: the full result of the filter with the flagship parameters."""
    plan = _flagship(_tables(spark, sf_dir))
    return plan.detached(render(plan.result))


def q_gene_based_filter_old(spark, sf_dir):
    """P1 on the earlier table layout (top-level frequency structs, study list on consequences, flat
    clinical tables, no study codes, unsorted)."""
    t = _tables(spark, sf_dir)
    vt = VariantTables(t.old_consequences, t.old_variants, t.dbnsfp, t.occurrences, t.old_diagnoses,
                       t.old_phenotypes, t.clinvar, t.hgmd, None)
    plan = plan_gene_filter(vt, GENES, STUDIES, FilterParams(profile="old"))
    return plan.detached(render(plan.result))


def q_gene_based_filter_multi_study(spark, sf_dir):
    """P1 for several studies at once (A5): variants of any listed study; genotype rows restricted to
    the listed studies (partition pruning on a study-partitioned table)."""
    vt = _variant_tables(_tables(spark, sf_dir))
    plan = plan_gene_filter(vt, GENES, ["SD_A", "SD_B"], PARAMS, restrict_occurrences_to_studies=True)
    return plan.detached(render(plan.result))


THRESHOLDS = ThresholdGrid(maf=(0.0001, 0.001, 0.01, 0.5), dpc_l=(0.0, 0.3, 0.5), dpc_u=(0.4, 0.8, 1.0), aaf=(0.0, 0.2, 0.45))


def q_threshold_surface(spark, sf_dir):
    """The rows of the filter at each of 108 settings of its four thresholds, from one genotype scan."""
    rows, plan = threshold_surface(_variant_tables(_tables(spark, sf_dir)), GENES, STUDIES, THRESHOLDS)
    return plan.detached(rows)


def q_incremental_results(spark, sf_dir):
    """A5 + P1 + P3 by release: one study's genotypes are filtered, then both studies are wanted and only the second one
    is run; the ledger tells in which of the two updates each study was run."""
    t = _tables(spark, sf_dir)
    parent, out = _scratch(spark, "releases"), _scratch(spark, "ledgered")
    paths = [f"{parent}/occurrences_sd_a_re_0004", f"{parent}/occurrences_sd_b_re_0011"]
    for path in paths:
        t.occurrences.where(F.col("study_id") == RD.study_from_path(path)).write.partitionBy("study_id").parquet(path)
    sources = [StudyRelease.at(p) for p in paths]
    tables = replace(_variant_tables(t), occurrences=None)
    first = update_results(spark, tables, FLAGSHIP_GENES, sources[:1], out)
    second = update_results(spark, tables, FLAGSHIP_GENES, sources, out)
    updates = spark.createDataFrame([(s.study, k) for k, u in (("first", first), ("second", second)) for s in u.ran],
                                    "study string, ran_in string")
    entries = ResultLedger(spark, out).entries().select("study", "release").join(updates, "study")
    rows = merged_results(spark, second).join(F.broadcast(entries), F.col("study_id") == F.col("study"), "left")
    return rows.select("study_id", "participant_id", "biospecimen_id", "chromosome", "start", "family_id", "is_proband",
                       "study_code", "VariationID", "HGMDID", "release", "ran_in")


QUERIES: dict[str, Query] = {
    "gene_list_clean": q_gene_list_clean,
    "canonical_gene_filter": q_canonical_gene_filter,
    "study_overlap": q_study_overlap,
    "chromosome_restrict": q_chromosome_restrict,
    "damage_ratio": q_damage_ratio,
    "max_population_af": q_max_population_af,
    "clinvar_first_gene": q_clinvar_first_gene,
    "clinvar_significance": q_clinvar_significance,
    "hgmd_class": q_hgmd_class,
    "allele_fraction": q_allele_fraction,
    "adjusted_calls": q_adjusted_calls,
    "participant_id_norm": q_participant_id_norm,
    "chromosome_sort_key": q_chromosome_sort_key,
    "study_from_path": q_study_from_path,
    "sorted_result": q_sorted_result,
    "result_round_trip": q_result_round_trip,
    "result_cells": q_result_cells,
    "result_types": q_result_types,
    "single_file_result": q_single_file_result,
    "join_consequence_variant": q_join_consequence_variant,
    "join_damage_left": q_join_damage_left,
    "clinvar_seen": q_clinvar_seen,
    "hgmd_seen": q_hgmd_seen,
    "clinvar_seen_with_vus": q_clinvar_seen_with_vus,
    "rare_damaging_flag": q_rare_damaging_flag,
    "known_variant_override": q_known_variant_override,
    "carrier_calls": q_carrier_calls,
    "flagged_carriers": q_flagged_carriers,
    "flagged_carriers_large_sets": q_flagged_carriers_large_sets,
    "clustered_genotype_join": q_clustered_genotype_join,
    "diagnoses_combined": q_diagnoses_combined,
    "hpo_codes": q_hpo_codes,
    "phenotypes_combined": q_phenotypes_combined,
    "clinical_enrichment": q_clinical_enrichment,
    "combined_results": q_combined_results,
    "multi_study_union": q_multi_study_union,
    "study_partitions": q_study_partitions,
    "gene_based_filter": q_gene_based_filter,
    "gene_based_filter_old": q_gene_based_filter_old,
    "gene_based_filter_multi_study": q_gene_based_filter_multi_study,
    "threshold_surface": q_threshold_surface,
    "incremental_results": q_incremental_results,
}
