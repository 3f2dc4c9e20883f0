"""Golden test of the earlier table layout, on the hand-made tables reshaped."""

import pytest
from pyspark.sql import functions as F

import golden as G
from varsift.params import FilterParams
from varsift.plans.gene_filter import VariantTables, plan_gene_filter

OLD_COLUMNS = (
    "participant_id chromosome start reference alternate consequences rsID impact symbol ensembl_gene_id "
    "refseq_mrna_id hgvsg hgvsc hgvsp study_ids topmed_af gnomad_genomes_2_1_af gnomad_exomes_2_1_af "
    "gnomad_genomes_3_0_af gnomad_genomes_3_1_1_af max_gnomad_topmed DamagePredCount PredCountRatio_D2T TWINSUK_AF "
    "ALSPAC_AF UK10K_AF VariationID clin_sig conditions HGMDID variant_class phen ad dp variant_allele_fraction "
    "calls adjusted_calls filter is_lo_conf_denovo is_hi_conf_denovo is_proband affected_status gender "
    "biospecimen_id mother_id father_id family_id diagnoses_combined phenotypes_combined hpos_combined").split()


@pytest.fixture(scope="module")
def old_tables(spark):
    return make_old_tables(spark)


def make_old_tables(spark) -> VariantTables:
    """The hand-made tables reshaped into the earlier layout."""
    t = G.tables(spark)
    studies = t.variants.select("chromosome", "start", "reference", "alternate",
                                F.col("studies.study_id").alias("study_ids"))
    csq = (t.consequences.join(studies, ["chromosome", "start", "reference", "alternate"])
           .select("chromosome", "start", "reference", "alternate", "original_canonical",
                   F.col("consequence").alias("consequences"), F.col("hgvsc").alias("name"),
                   F.lit("SNV").alias("variant_class"), F.col("vep_impact").alias("impact"), "symbol",
                   "ensembl_gene_id", "refseq_mrna_id", F.col("hgvsc").alias("hgvsg"), "hgvsc", "hgvsp", "study_ids"))
    ef = "external_frequencies"
    var = t.variants.select(
        "chromosome", "start", "reference", "alternate", F.col(f"{ef}.topmed_bravo").alias("topmed"),
        F.col(f"{ef}.gnomad_genomes_2_1_1").alias("gnomad_genomes_2_1"),
        F.col(f"{ef}.gnomad_exomes_2_1_1").alias("gnomad_exomes_2_1"),
        F.col(f"{ef}.gnomad_genomes_3").alias("gnomad_genomes_3_0"),
        F.col(f"{ef}.gnomad_genomes_3").alias("gnomad_genomes_3_1_1"),
        F.col("studies.study_id").alias("studies"))
    dgn = t.diagnoses.select(F.upper(F.translate("participant_fhir_id", "-", "_")).alias("participant_id"),
                             F.col("source_text").alias("source_text_diagnosis"))
    pht = t.phenotypes.select(F.upper(F.translate("participant_fhir_id", "-", "_")).alias("participant_id"),
                              F.col("source_text").alias("source_text_phenotype"),
                              F.explode_outer("condition_coding.code").alias("hpo_id_phenotype"))
    return VariantTables(csq, var, t.dbnsfp, t.occurrences.drop("study_id"), dgn, pht, t.clinvar, t.hgmd, None)


def test_old_layout_rows_and_columns(old_tables):
    plan = plan_gene_filter(old_tables, G.GENES, [G.STUDY], FilterParams(profile="old"))
    rows = plan.result.collect()
    assert plan.result.columns == OLD_COLUMNS and len(OLD_COLUMNS) == 50
    assert G.pairs(rows) == G.EXPECTED
    s1 = next(r for r in rows if r["biospecimen_id"] == "s1")
    assert s1["study_ids"] == [G.STUDY] and s1["rsID"] == "c.v1"
    assert s1["diagnoses_combined"] == ["a", "b"]
    # No 'confirmed' filter in this layout: the negative phenotype and ICD codes are kept.
    assert "neg" in s1["phenotypes_combined"] and "X1" in s1["hpos_combined"]
    plan.release()


def test_old_layout_study_filter_on_consequences(old_tables):
    plan = plan_gene_filter(old_tables, G.GENES, ["SD_OTHER"], FilterParams(profile="old"))
    assert plan.gene_consequences.count() == 1  # only v10 (canonical) is in SD_OTHER
    plan.release()
