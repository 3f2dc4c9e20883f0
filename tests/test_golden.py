"""End-to-end golden test of the new layout on hand-made tables."""

import pytest

import golden as G
from varsift.params import FilterParams
from varsift.plans.gene_filter import output_columns, plan_gene_filter

NEW_COLUMNS = (
    "study_id participant_id chromosome start reference alternate consequence vep_impact symbol ensembl_gene_id "
    "refseq_mrna_id hgvsc hgvsp topmed_bravo_af gnomad_genomes_2_1_1_af gnomad_exomes_2_1_1_af gnomad_genomes_3_af "
    "max_gnomad_topmed DamagePredCount PredCountRatio_D2T TWINSUK_AF ALSPAC_AF UK10K_AF VariationID clin_sig "
    "conditions HGMDID variant_class phen ad dp variant_allele_fraction calls adjusted_calls filter "
    "is_lo_conf_denovo is_hi_conf_denovo is_proband affected_status gender biospecimen_id mother_id father_id "
    "family_id diagnoses_combined phenotypes_combined hpos_combined study_code").split()


@pytest.fixture(scope="module")
def tables(spark):
    return G.tables(spark)


def run(tables, params=FilterParams(), genes=G.GENES):
    plan = plan_gene_filter(tables, genes, [G.STUDY], params)
    rows = plan.result.collect()
    plan.release()
    return plan.result.columns, rows


def test_expected_rows_and_columns(tables, ansi):
    cols, rows = run(tables)
    assert cols == NEW_COLUMNS
    assert len(NEW_COLUMNS) == 48
    assert G.pairs(rows) == G.EXPECTED
    assert len(rows) == len(G.EXPECTED)


def test_row_values(tables, ansi):
    _, rows = run(tables)
    by = {r["biospecimen_id"]: r for r in rows}
    s1 = by["s1"]
    assert s1["variant_allele_fraction"] == pytest.approx(0.2)
    assert s1["adjusted_calls"] == [0, 1]
    assert s1["PredCountRatio_D2T"] == pytest.approx(0.6)
    assert s1["max_gnomad_topmed"] == pytest.approx(0.00001)
    assert s1["diagnoses_combined"] == ["a", "b"]
    assert s1["phenotypes_combined"] == ["p-text1", "p-text1", "p-text2", "p-text2"]
    assert s1["hpos_combined"] == ["HP:1", "HP:2", "HP:3"]
    assert s1["study_code"] == "CODE_X"
    assert s1["VariationID"] is None and s1["HGMDID"] is None
    s5 = by["s5"]
    assert s5["VariationID"] == "VCV2" and s5["clin_sig"] == ["Pathogenic"]
    assert s5["variant_allele_fraction"] is None and s5["adjusted_calls"] == [1, 1]
    assert s5["diagnoses_combined"] is None and s5["phenotypes_combined"] is None
    s7 = by["s7"]
    assert s7["HGMDID"] == "CM3" and s7["variant_class"] == "DM?"
    assert s7["adjusted_calls"] == [-1, -1]
    assert s7["diagnoses_combined"] == ["c"]
    assert s7["phenotypes_combined"] == [] and s7["hpos_combined"] == []
    assert by["s8"]["variant_allele_fraction"] is None
    assert by["s9"]["ad"] is None and by["s9"]["max_gnomad_topmed"] == 0.0
    assert by["s11"]["PredCountRatio_D2T"] is None


def test_only_hgmd_drops_clinvar_rows_and_columns(tables):
    cols, rows = run(tables, FilterParams(known_variants=("hgmd",)))
    assert "VariationID" not in cols and "HGMDID" in cols
    assert G.pairs(rows) == G.EXPECTED - {("v2", "s5")}


def test_no_database(tables):
    cols, rows = run(tables, FilterParams(known_variants=()))
    assert "VariationID" not in cols and "HGMDID" not in cols
    assert G.pairs(rows) == G.EXPECTED - {("v2", "s5"), ("v3", "s7")}


def test_requested_database_without_match_keeps_columns(tables):
    cols, rows = run(tables, FilterParams(), genes=["GENE1"])
    assert cols == output_columns(FilterParams())
    assert {p for p in G.pairs(rows)} == {("v1", "s1"), ("v2", "s5"), ("v5", "s8"), ("v6", "s9"), ("v11", "s11")}
    assert all(r["HGMDID"] is None for r in rows)


def test_unknown_database_rejected():
    with pytest.raises(ValueError):
        FilterParams(known_variants=("dbSNP",))


def test_missing_table_rejected(tables):
    from dataclasses import replace

    with pytest.raises(ValueError, match="hgmd"):
        plan_gene_filter(replace(tables, hgmd=None), G.GENES, [G.STUDY], FilterParams())


def test_string_thresholds_are_numeric():
    p = FilterParams(maf="0.0001", dpc_l="0.5", dpc_u="1", aaf="0.2")
    assert (p.maf, p.dpc_l, p.dpc_u, p.aaf) == (0.0001, 0.5, 1.0, 0.2)


def test_empty_gene_list_gives_empty_result(tables):
    cols, rows = run(tables, genes=[])
    assert cols == NEW_COLUMNS and rows == []
