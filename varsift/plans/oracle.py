"""Oracle statements (DuckDB dialect) for every registered query.

Each statement reads the driver's pre-registered test tables through the flat views of
``varsift.plans.fixtures`` and restates the operator in plain SQL. Lists are ``|``-joined text in a
fixed order, matching ``varsift.plans.queries.render``.
"""

from __future__ import annotations

from varsift.plans.fixtures import FLAGSHIP_GENES, oracle_ctes

K = "chromosome, start, reference, alternate"
LEVELS = ", ".join(f"'{i}'" for i in range(1, 23)) + ", 'X', 'Y'"
GENES = ", ".join(f"'{g}'" for g in FLAGSHIP_GENES)
ALL_VIEWS = ("f_variants", "f_consequences", "f_dbnsfp", "f_clinvar", "f_hgmd", "f_occ", "f_diagnoses",
             "f_phenotypes", "f_codings", "f_studies")


def _has(column: str, *values: str) -> str:
    """Whether the ``|``-joined list holds one of the values; false for a null list."""
    return f"coalesce(list_has_any(string_split({column}, '|'), [{', '.join(repr(v) for v in values)}]), false)"


def _on(a: str, b: str) -> str:
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in ("chromosome", "start", "reference", "alternate"))


def _k(alias: str) -> str:
    return ", ".join(f"{alias}.{c}" for c in ("chromosome", "start", "reference", "alternate"))


CSQ = (f"csq AS (SELECT {K}, consequence, vep_impact, symbol, ensembl_gene_id, refseq_mrna_id, hgvsc, hgvsp "
       f"FROM f_consequences WHERE original_canonical AND symbol IN ({GENES}))")


def _vrt(name: str, study_filter: str | None) -> str:
    where = f" WHERE {study_filter}" if study_filter else ""
    return (f"{name} AS (SELECT topmed_af AS topmed_bravo_af, gnomad_af AS gnomad_genomes_2_1_1_af, "
            f"exomes_af AS gnomad_exomes_2_1_1_af, gnomad_af AS gnomad_genomes_3_af, {K}, "
            f"greatest(CAST(0 AS DOUBLE), topmed_af, gnomad_af, exomes_af) AS max_gnomad_topmed "
            f"FROM f_variants{where})")


DBN = (f"dbn AS (SELECT {K}, damage AS DamagePredCount, "
       "CASE WHEN regexp_matches(split_part(damage, '_', 2), '^\\s*[+-]?(0+(\\.[0-9]*)?|\\.[0-9]*)\\s*$') THEN NULL "
       "ELSE TRY_CAST(split_part(damage, '_', 1) AS DOUBLE) / NULLIF(TRY_CAST(split_part(damage, '_', 2) AS DOUBLE), 0) "
       "END AS PredCountRatio_D2T, twinsuk_af AS TWINSUK_AF, alspac_af AS ALSPAC_AF, uk10k_af AS UK10K_AF "
       "FROM f_dbnsfp)")

FLAG = ("CASE WHEN max_gnomad_topmed < CAST(0.0001 AS DOUBLE) AND (PredCountRatio_D2T IS NULL OR "
        "(PredCountRatio_D2T >= CAST(0.5 AS DOUBLE) AND PredCountRatio_D2T <= CAST(1 AS DOUBLE))) THEN 1 ELSE 0 END")


def _cand(name: str, vrt: str) -> str:
    return (f"{name} AS (SELECT {_k('c')}, c.consequence, c.vep_impact, c.symbol, c.ensembl_gene_id, "
            f"c.refseq_mrna_id, c.hgvsc, c.hgvsp, v.topmed_bravo_af, v.gnomad_genomes_2_1_1_af, "
            f"v.gnomad_exomes_2_1_1_af, v.gnomad_genomes_3_af, v.max_gnomad_topmed, d.DamagePredCount, "
            f"d.PredCountRatio_D2T, d.TWINSUK_AF, d.ALSPAC_AF, d.UK10K_AF, "
            f"{FLAG.replace('max_gnomad_topmed', 'v.max_gnomad_topmed').replace('PredCountRatio_D2T', 'd.PredCountRatio_D2T')} AS flag "
            f"FROM csq c JOIN {vrt} v ON {_on('c', 'v')} LEFT JOIN dbn d ON {_on('c', 'd')})")


def _clv(name: str, vrt: str, sigs: tuple[str, ...] = ("Pathogenic", "Likely_pathogenic")) -> str:
    return (f"{name} AS (SELECT {_k('x')}, x.name AS VariationID, x.sig AS clin_sig, x.condition AS conditions "
            f"FROM f_clinvar x JOIN {vrt} v ON {_on('x', 'v')} "
            f"WHERE split_part(split_part(x.geneinfo, '|', 1), ':', 1) IN ({GENES}) AND {_has('x.sig', *sigs)})")


def _hgm(name: str, vrt: str) -> str:
    return (f"{name} AS (SELECT {_k('h')}, h.id AS HGMDID, h.variant_class, h.phen "
            f"FROM f_hgmd h JOIN {vrt} v ON {_on('h', 'v')} "
            f"WHERE h.symbol IN ({GENES}) AND starts_with(h.variant_class, 'DM'))")


def _over(name: str, cand: str, clv: str | None, hgm: str | None) -> str:
    cols = [f"{_k('c')}", "c.consequence, c.vep_impact, c.symbol, c.ensembl_gene_id, c.refseq_mrna_id, c.hgvsc",
            "c.hgvsp, c.topmed_bravo_af, c.gnomad_genomes_2_1_1_af, c.gnomad_exomes_2_1_1_af, c.gnomad_genomes_3_af",
            "c.max_gnomad_topmed, c.DamagePredCount, c.PredCountRatio_D2T, c.TWINSUK_AF, c.ALSPAC_AF, c.UK10K_AF"]
    joins = ""
    flag = "c.flag"
    if clv:
        cols.append("k1.VariationID, k1.clin_sig, k1.conditions")
        joins += f" LEFT JOIN {clv} k1 ON {_on('c', 'k1')}"
        flag = f"CASE WHEN k1.VariationID IS NOT NULL THEN 1 ELSE {flag} END"
    if hgm:
        cols.append("k2.HGMDID, k2.variant_class, k2.phen")
        joins += f" LEFT JOIN {hgm} k2 ON {_on('c', 'k2')}"
        flag = f"CASE WHEN k2.HGMDID IS NOT NULL THEN 1 ELSE {flag} END"
    return f"{name} AS (SELECT {', '.join(cols)}, {flag} AS flag FROM {cand} c{joins})"


OCC = (f"occ AS (SELECT *, CASE WHEN vaf < CAST(0.2 AS DOUBLE) THEN 0 ELSE call0 END AS adj0, "
       f"CASE WHEN vaf < CAST(0.2 AS DOUBLE) THEN 0 ELSE call1 END AS adj1 FROM "
       f"(SELECT *, CASE WHEN ad0 + ad1 <> 0 THEN ad1 / (ad0 + ad1) END AS vaf FROM f_occ))")
CARRIERS = "carriers AS (SELECT * FROM occ WHERE NOT is_multi_allelic AND has_alt = 1 AND NOT (adj0 = 0 AND adj1 = 0))"

DGN = ("dgn AS (SELECT participant_id, coalesce(string_agg(text, '|' ORDER BY text), '') AS diagnoses_combined "
       "FROM (SELECT DISTINCT replace(upper(participant_fhir_id), '-', '_') AS participant_id, source_text AS text "
       "FROM f_diagnoses) GROUP BY participant_id)")
HPO = "hpo AS (SELECT phenotype_id, code FROM f_codings WHERE category = 'HPO')"
PHT = ("pht AS (SELECT participant_id, "
       "coalesce(string_agg(text, '|' ORDER BY text NULLS FIRST, code NULLS FIRST), '') AS phenotypes_combined, "
       "coalesce(string_agg(code, '|' ORDER BY text NULLS FIRST, code NULLS FIRST), '') AS hpos_combined "
       "FROM (SELECT DISTINCT replace(upper(p.participant_fhir_id), '-', '_') AS participant_id, "
       "p.source_text AS text, h.code FROM f_phenotypes p LEFT JOIN hpo h ON p.phenotype_id = h.phenotype_id "
       "WHERE p.observed = 'confirmed') GROUP BY participant_id)")
STD = "std AS (SELECT DISTINCT study_id, study_code FROM f_studies)"

RESULT_COLS = (
    "o.study_id, o.participant_id, {k}, f.consequence, f.vep_impact, f.symbol, f.ensembl_gene_id, "
    "f.refseq_mrna_id, f.hgvsc, f.hgvsp, f.topmed_bravo_af, f.gnomad_genomes_2_1_1_af, f.gnomad_exomes_2_1_1_af, "
    "f.gnomad_genomes_3_af, f.max_gnomad_topmed, f.DamagePredCount, f.PredCountRatio_D2T, f.TWINSUK_AF, "
    "f.ALSPAC_AF, f.UK10K_AF, {known}"
    "CAST(o.ad0 AS VARCHAR) || '|' || CAST(o.ad1 AS VARCHAR) AS ad, o.dp, o.vaf AS variant_allele_fraction, "
    "CAST(o.call0 AS VARCHAR) || '|' || CAST(o.call1 AS VARCHAR) AS calls, "
    "CAST(o.adj0 AS VARCHAR) || '|' || CAST(o.adj1 AS VARCHAR) AS adjusted_calls, o.filter, o.is_lo_conf_denovo, "
    "o.is_hi_conf_denovo, o.is_proband, o.affected_status, o.gender, o.biospecimen_id, o.mother_id, o.father_id, "
    "o.family_id, g.diagnoses_combined, p.phenotypes_combined, p.hpos_combined, s.study_code"
)


def _result(name: str, over: str, clinvar: bool, hgmd: bool) -> str:
    known = ""
    if clinvar:
        known += "f.VariationID, f.clin_sig, f.conditions, "
    if hgmd:
        known += "f.HGMDID, f.variant_class, f.phen, "
    cols = RESULT_COLS.format(k=_k("f"), known=known)
    return (f"{name} AS (SELECT {cols} FROM {over} f JOIN carriers o ON {_on('f', 'o')} "
            f"LEFT JOIN dgn g ON o.participant_id = g.participant_id "
            f"LEFT JOIN pht p ON o.participant_id = p.participant_id "
            f"LEFT JOIN std s ON o.study_id = s.study_id WHERE f.flag = 1)")


def _with(*ctes: str) -> str:
    """``WITH`` clause: the fixture views followed by ``ctes``."""
    if not ctes:
        return oracle_ctes(*ALL_VIEWS)
    return oracle_ctes(*ALL_VIEWS).rstrip("\n") + ",\n" + ",\n".join(ctes) + "\n"


FLAGSHIP_CTES = (CSQ, _vrt("vrt", _has("study", "SD_A")), DBN, _cand("cand", "vrt"), _clv("clv", "vrt"),
                 _hgm("hgm", "vrt"), _over("over", "cand", "clv", "hgm"), OCC, CARRIERS, DGN, HPO, PHT, STD,
                 _result("res", "over", True, True))

F1_ORDER = ("CASE WHEN chromosome IN ('X', 'Y', 'x', 'y') THEN lpad(chromosome, 2, '2') ELSE lpad(chromosome, 2, '0') "
            "END ASC NULLS FIRST, start ASC NULLS FIRST, study_code ASC NULLS FIRST, family_id ASC NULLS FIRST, "
            "is_proband ASC NULLS FIRST")
RANK_EXPR = ("CASE WHEN chromosome = 'X' THEN 23 WHEN chromosome = 'Y' THEN 24 "
             f"WHEN chromosome IN ({LEVELS}) THEN CAST(chromosome AS INTEGER) END")
F2_ORDER = (f"{RANK_EXPR} ASC NULLS LAST, start ASC NULLS LAST, study_code ASC NULLS LAST, "
            "family_id ASC NULLS LAST, is_proband ASC NULLS LAST")

COMBINED_KEEP = "study_id, participant_id, biospecimen_id, chromosome, start, family_id, is_proband, study_code"

SQL: dict[str, str] = {
    "gene_list_clean": (
        "SELECT p_partkey, replace(replace(line, chr(160), ''), chr(10), '') AS gene FROM ("
        "SELECT p_partkey, concat(CASE WHEN p_partkey % 5 = 0 THEN concat(chr(160), p_brand) ELSE p_brand END, "
        "CASE WHEN p_partkey % 4 = 1 THEN chr(160) WHEN p_partkey % 4 = 2 THEN chr(10) "
        "WHEN p_partkey % 4 = 3 THEN ' ' ELSE '' END) AS line FROM part)"),
    "canonical_gene_filter": _with(CSQ) + "SELECT * FROM csq",
    "study_overlap": _with() + "SELECT " + K + f", {_has('study', 'SD_B', 'SD_Z')} AS in_study FROM f_variants",
    "chromosome_restrict": _with(CSQ) + (
        f"SELECT {K}, damage AS DamagePredCount FROM f_dbnsfp WHERE chromosome IN (SELECT chromosome FROM csq)"),
    "damage_ratio": _with(DBN) + f"SELECT {K}, DamagePredCount, PredCountRatio_D2T FROM dbn",
    "max_population_af": _with(_vrt("vrt_all", None)) + "SELECT * FROM vrt_all",
    "clinvar_first_gene": _with() + (
        f"SELECT {K}, name AS VariationID, split_part(split_part(geneinfo, '|', 1), ':', 1) AS first_gene "
        "FROM f_clinvar"),
    "clinvar_significance": _with() + (
        f"SELECT {K}, name AS VariationID, sig AS clin_sig FROM f_clinvar "
        f"WHERE {_has('sig', 'Pathogenic', 'Likely_pathogenic')}"),
    "hgmd_class": _with() + (
        f"SELECT {K}, id AS HGMDID, variant_class FROM f_hgmd WHERE starts_with(variant_class, 'DM')"),
    "allele_fraction": _with(OCC) + (
        f"SELECT {K}, biospecimen_id, CAST(ad0 AS VARCHAR) || '|' || CAST(ad1 AS VARCHAR) AS ad, "
        "vaf AS variant_allele_fraction FROM occ"),
    "adjusted_calls": _with(OCC) + (
        f"SELECT {K}, biospecimen_id, CAST(call0 AS VARCHAR) || '|' || CAST(call1 AS VARCHAR) AS calls, "
        "vaf AS variant_allele_fraction, CAST(adj0 AS VARCHAR) || '|' || CAST(adj1 AS VARCHAR) AS adjusted_calls "
        "FROM occ"),
    "participant_id_norm": _with() + (
        "SELECT participant_fhir_id, replace(upper(participant_fhir_id), '-', '_') AS participant_id "
        "FROM f_diagnoses"),
    "chromosome_sort_key": _with() + (
        f"SELECT {K}, CASE WHEN chromosome IN ('X', 'Y', 'x', 'y') THEN lpad(chromosome, 2, '2') "
        "ELSE lpad(chromosome, 2, '0') END AS chromosome_key, "
        f"CASE WHEN chromosome IN ({LEVELS}) THEN chromosome END AS chromosome_level, "
        f"CAST({RANK_EXPR} AS INTEGER) AS chromosome_rank FROM f_variants"),
    "study_from_path": _with() + (
        "SELECT biospecimen_id, path, CASE WHEN regexp_extract(path, 'occurrences_(sd.*?)_re_', 1) <> '' "
        "THEN upper(regexp_extract(path, 'occurrences_(sd.*?)_re_', 1)) END AS study_id FROM ("
        "SELECT biospecimen_id, concat('s3a://lake/genotypes/occurrences_', lower(study_id), "
        "CASE WHEN is_hi_conf_denovo THEN '_v' ELSE '_re_' END, lpad(CAST(dp % 100 AS VARCHAR), 3, '0'), "
        "'/part-0.parquet') AS path FROM f_occ)"),
    "sorted_result": _with(*FLAGSHIP_CTES) + (
        f"SELECT rank() OVER (ORDER BY {F1_ORDER}) AS result_rank, chromosome, start, study_code, family_id, "
        "is_proband, participant_id, biospecimen_id FROM res"),
    "result_cells": _with() + (
        f"SELECT {K}, biospecimen_id, CAST(ad0 AS VARCHAR) || '|' || CAST(ad1 AS VARCHAR) AS ad, "
        "CAST(call0 AS VARCHAR) || '|' || CAST(call1 AS VARCHAR) AS calls, "
        "CASE dp % 3 WHEN 0 THEN concat('Pathogenic|', filter) WHEN 1 THEN '' END AS clin_sig, "
        "CASE WHEN dp % 4 > 0 THEN dp / 4 END AS share, CASE WHEN dp % 4 > 0 THEN 2 END AS n_shares, "
        "CASE WHEN dp % 5 > 0 THEN CAST(dp AS BIGINT) END AS depth, CASE WHEN dp % 5 > 0 THEN filter END AS note_filter, "
        "CAST(has_alt AS BIGINT) AS site_alternate, is_proband AS site_proband, 'array<int>' AS ad_type, 'array<int>' AS calls_type, "
        "'array<string>' AS clin_sig_type, 'array<double>' AS shares_type, "
        "'array<struct<depth:bigint,filter:string>>' AS notes_type, 'struct<alternate:bigint,is_proband:boolean>' AS site_type "
        "FROM f_occ"),
    "result_types": _with() + (
        "SELECT run, column_name, CASE WHEN bool_and(cell IS NULL) THEN 'string' "
        "WHEN bool_and(cell IN ('true', 'false')) THEN 'boolean' "
        "WHEN bool_and(TRY_CAST(cell AS BIGINT) IS NOT NULL AND NOT contains(cell, '.')) FILTER (cell IS NOT NULL) THEN 'bigint' "
        "WHEN bool_and(TRY_CAST(cell AS DOUBLE) IS NOT NULL AND NOT contains(cell, '.')) FILTER (cell IS NOT NULL) "
        "THEN 'decimal(38,0)' WHEN bool_and(TRY_CAST(cell AS DOUBLE) IS NOT NULL) FILTER (cell IS NOT NULL) THEN 'double' ELSE 'string' END AS type "
        "FROM (SELECT unnest([run, 'all']) AS run, c.column_name AS column_name, c.cell AS cell FROM (SELECT run, unnest(["
        "{'column_name': 'sample', 'cell': biospecimen_id}, "
        "{'column_name': 'depth', 'cell': CASE run WHEN 'two' THEN CAST(dp / 8 AS VARCHAR) ELSE CAST(dp AS VARCHAR) END}, "
        "{'column_name': 'level', 'cell': CASE run WHEN 'three' THEN NULL ELSE CAST(dp / 8 AS VARCHAR) END}, "
        "{'column_name': 'large', 'cell': CASE run WHEN 'three' THEN CAST(dp AS VARCHAR) "
        "ELSE concat(CAST(dp AS VARCHAR), repeat('0', 20)) END}, "
        "{'column_name': 'carrier', 'cell': CASE run WHEN 'three' THEN CAST(dp AS VARCHAR) ELSE CAST(is_proband AS VARCHAR) END}, "
        "{'column_name': 'empty', 'cell': NULL}, {'column_name': 'filter', 'cell': filter}]) AS c "
        "FROM (SELECT *, unnest(CASE WHEN study_id = 'SD_A' THEN ['one'] ELSE ['two', 'three'] END) AS run FROM f_occ))) "
        "GROUP BY run, column_name"),
    "single_file_result": _with(OCC, CARRIERS) + (
        f"SELECT rank() OVER (ORDER BY {F1_ORDER.replace('study_code', 'study_id')}) AS result_rank, {K}, participant_id, "
        "biospecimen_id, study_id, family_id, is_proband FROM carriers"),
    "join_consequence_variant": _with(CSQ, _vrt("vrt", _has("study", "SD_A"))) + (
        f"SELECT {_k('c')}, c.consequence, c.vep_impact, c.symbol, c.ensembl_gene_id, c.refseq_mrna_id, c.hgvsc, "
        "c.hgvsp, v.topmed_bravo_af, v.gnomad_genomes_2_1_1_af, v.gnomad_exomes_2_1_1_af, v.gnomad_genomes_3_af, "
        f"v.max_gnomad_topmed FROM csq c JOIN vrt v ON {_on('c', 'v')}"),
    "join_damage_left": _with(CSQ, _vrt("vrt", _has("study", "SD_A")), DBN, _cand("cand", "vrt")) + (
        f"SELECT {K}, max_gnomad_topmed, DamagePredCount, PredCountRatio_D2T, TWINSUK_AF, ALSPAC_AF, UK10K_AF, flag "
        "FROM cand"),
    "clinvar_seen": _with(_vrt("vrt", _has("study", "SD_A")), _clv("clv", "vrt")) + "SELECT * FROM clv",
    "hgmd_seen": _with(_vrt("vrt", _has("study", "SD_A")), _hgm("hgm", "vrt")) + "SELECT * FROM hgm",
    "clinvar_seen_with_vus": _with(
        _vrt("vrt", _has("study", "SD_A")),
        _clv("clv", "vrt", ("Pathogenic", "Likely_pathogenic", "Uncertain_significance"))) + "SELECT * FROM clv",
    "rare_damaging_flag": _with(_vrt("vrt_all", None), DBN) + (
        f"SELECT {_k('v')}, v.max_gnomad_topmed, d.PredCountRatio_D2T, "
        f"{FLAG.replace('max_gnomad_topmed', 'v.max_gnomad_topmed').replace('PredCountRatio_D2T', 'd.PredCountRatio_D2T')}"
        f" AS flag FROM vrt_all v LEFT JOIN dbn d ON {_on('v', 'd')}"),
    "known_variant_override": _with(*FLAGSHIP_CTES[:7]) + f"SELECT {K}, VariationID, HGMDID, flag FROM over",
    "carrier_calls": _with(OCC, CARRIERS) + (
        f"SELECT {K}, biospecimen_id, participant_id, vaf AS variant_allele_fraction, "
        "CAST(adj0 AS VARCHAR) || '|' || CAST(adj1 AS VARCHAR) AS adjusted_calls FROM carriers"),
    "flagged_carriers": _with(*FLAGSHIP_CTES[:9]) + (
        f"SELECT {_k('f')}, o.participant_id, o.biospecimen_id, f.symbol, f.VariationID, f.HGMDID, "
        "CAST(o.adj0 AS VARCHAR) || '|' || CAST(o.adj1 AS VARCHAR) AS adjusted_calls "
        f"FROM over f JOIN carriers o ON {_on('f', 'o')} WHERE f.flag = 1"),
    "diagnoses_combined": _with(DGN) + "SELECT * FROM dgn",
    "hpo_codes": _with(HPO) + "SELECT * FROM hpo",
    "phenotypes_combined": _with(HPO, PHT) + "SELECT * FROM pht",
    "clinical_enrichment": _with(OCC, CARRIERS, DGN, HPO, PHT, STD) + (
        f"SELECT o.study_id, o.participant_id, {_k('o')}, o.biospecimen_id, g.diagnoses_combined, "
        "p.phenotypes_combined, p.hpos_combined, s.study_code FROM carriers o "
        "LEFT JOIN dgn g ON o.participant_id = g.participant_id "
        "LEFT JOIN pht p ON o.participant_id = p.participant_id LEFT JOIN std s ON o.study_id = s.study_id"),
    "combined_results": _with(
        CSQ, DBN, OCC, CARRIERS, DGN, HPO, PHT, STD,
        _vrt("vrt_a", _has("study", "SD_A")), _cand("cand_a", "vrt_a"), _clv("clv_a", "vrt_a"),
        _over("over_a", "cand_a", "clv_a", None), _result("res_a", "over_a", True, False),
        _vrt("vrt_b", _has("study", "SD_B")), _cand("cand_b", "vrt_b"), _hgm("hgm_b", "vrt_b"),
        _over("over_b", "cand_b", None, "hgm_b"), _result("res_b", "over_b", False, True),
        f"merged AS (SELECT {COMBINED_KEEP}, VariationID, CAST(NULL AS VARCHAR) AS HGMDID FROM res_a "
        f"UNION ALL SELECT {COMBINED_KEEP}, CAST(NULL AS VARCHAR) AS VariationID, HGMDID FROM res_b)") + (
        f"SELECT study_id, participant_id, biospecimen_id, CASE WHEN chromosome IN ({LEVELS}) THEN chromosome END AS chromosome, "
        "start, family_id, is_proband, study_code, VariationID, HGMDID, "
        f"rank() OVER (ORDER BY {F2_ORDER}) AS combined_rank FROM merged"),
    "multi_study_union": _with() + (
        f"SELECT {K}, biospecimen_id, study_id FROM f_occ WHERE study_id IN ('SD_A') "
        f"UNION ALL SELECT {K}, biospecimen_id, study_id FROM f_occ WHERE study_id IN ('SD_B')"),
    "study_partitions": _with() + f"SELECT {K}, biospecimen_id, study_id FROM f_occ",
    "result_round_trip": (
        "SELECT p_brand AS symbol, CAST(p_partkey AS VARCHAR) AS participant_id, "
        "CAST(CASE WHEN p_partkey % 3 = 1 THEN 1000 ELSE p_partkey % 1000 END AS INTEGER) AS dp, "
        "CAST(p_partkey * 10 AS BIGINT) AS start, "
        "CASE p_partkey % 6 WHEN 0 THEN concat('a', chr(10), 'b', p_name) WHEN 1 THEN concat('tab', chr(9), 'here') "
        "WHEN 2 THEN 'say \"yes\"' WHEN 3 THEN '' WHEN 4 THEN NULL ELSE p_name END AS phen FROM part"),
    "gene_based_filter": _with(*FLAGSHIP_CTES) + "SELECT * FROM res",
}


# --- the earlier ("old") layout -------------------------------------------------------------
_OLD_CSQ = (f"csq_o AS (SELECT {K}, consequence AS consequences, refseq_mrna_id AS rsID, vep_impact AS impact, "
            "symbol, ensembl_gene_id, refseq_mrna_id, hgvsc AS hgvsg, hgvsc, hgvsp, study AS study_ids "
            f"FROM f_consequences WHERE original_canonical AND symbol IN ({GENES}) AND {_has('study', 'SD_A')})")
_OLD_VRT = (f"vrt_o AS (SELECT topmed_af, gnomad_af AS gnomad_genomes_2_1_af, exomes_af AS gnomad_exomes_2_1_af, "
            f"CAST(NULL AS DOUBLE) AS gnomad_genomes_3_0_af, gnomad_af AS gnomad_genomes_3_1_1_af, {K}, "
            "greatest(CAST(0 AS DOUBLE), topmed_af, gnomad_af, exomes_af) AS max_gnomad_topmed "
            f"FROM f_variants WHERE {_has('study', 'SD_A')})")
_OLD_CAND = (
    f"cand_o AS (SELECT {_k('c')}, c.consequences, c.rsID, c.impact, c.symbol, c.ensembl_gene_id, c.refseq_mrna_id, "
    "c.hgvsg, c.hgvsc, c.hgvsp, c.study_ids, v.topmed_af, v.gnomad_genomes_2_1_af, v.gnomad_exomes_2_1_af, "
    "v.gnomad_genomes_3_0_af, v.gnomad_genomes_3_1_1_af, v.max_gnomad_topmed, d.DamagePredCount, "
    "d.PredCountRatio_D2T, d.TWINSUK_AF, d.ALSPAC_AF, d.UK10K_AF, "
    f"{FLAG.replace('max_gnomad_topmed', 'v.max_gnomad_topmed').replace('PredCountRatio_D2T', 'd.PredCountRatio_D2T')}"
    f" AS flag FROM csq_o c JOIN vrt_o v ON {_on('c', 'v')} LEFT JOIN dbn d ON {_on('c', 'd')})")
_OLD_OVER = (
    f"over_o AS (SELECT c.*, k1.VariationID, k1.clin_sig, k1.conditions, k2.HGMDID, k2.variant_class, k2.phen, "
    "CASE WHEN k2.HGMDID IS NOT NULL OR k1.VariationID IS NOT NULL THEN 1 ELSE c.flag END AS flag2 "
    f"FROM cand_o c LEFT JOIN clv_o k1 ON {_on('c', 'k1')} LEFT JOIN hgm_o k2 ON {_on('c', 'k2')})")
_OLD_PHT = ("pht_o AS (SELECT participant_id, "
            "coalesce(string_agg(text, '|' ORDER BY text NULLS FIRST, code NULLS FIRST), '') AS phenotypes_combined, "
            "coalesce(string_agg(code, '|' ORDER BY text NULLS FIRST, code NULLS FIRST), '') AS hpos_combined "
            "FROM (SELECT DISTINCT replace(upper(p.participant_fhir_id), '-', '_') AS participant_id, "
            "p.source_text AS text, h.code FROM f_phenotypes p LEFT JOIN hpo h ON p.phenotype_id = h.phenotype_id) "
            "GROUP BY participant_id)")
_OLD_RESULT = (
    f"SELECT o.participant_id, {_k('f')}, f.consequences, f.rsID, f.impact, f.symbol, f.ensembl_gene_id, "
    "f.refseq_mrna_id, f.hgvsg, f.hgvsc, f.hgvsp, f.study_ids, f.topmed_af, f.gnomad_genomes_2_1_af, "
    "f.gnomad_exomes_2_1_af, f.gnomad_genomes_3_0_af, f.gnomad_genomes_3_1_1_af, f.max_gnomad_topmed, "
    "f.DamagePredCount, f.PredCountRatio_D2T, f.TWINSUK_AF, f.ALSPAC_AF, f.UK10K_AF, f.VariationID, f.clin_sig, "
    "f.conditions, f.HGMDID, f.variant_class, f.phen, "
    "CAST(o.ad0 AS VARCHAR) || '|' || CAST(o.ad1 AS VARCHAR) AS ad, o.dp, o.vaf AS variant_allele_fraction, "
    "CAST(o.call0 AS VARCHAR) || '|' || CAST(o.call1 AS VARCHAR) AS calls, "
    "CAST(o.adj0 AS VARCHAR) || '|' || CAST(o.adj1 AS VARCHAR) AS adjusted_calls, o.filter, o.is_lo_conf_denovo, "
    "o.is_hi_conf_denovo, o.is_proband, o.affected_status, o.gender, o.biospecimen_id, o.mother_id, o.father_id, "
    "o.family_id, g.diagnoses_combined, p.phenotypes_combined, p.hpos_combined "
    f"FROM over_o f JOIN carriers o ON {_on('f', 'o')} LEFT JOIN dgn g ON o.participant_id = g.participant_id "
    "LEFT JOIN pht_o p ON o.participant_id = p.participant_id WHERE f.flag2 = 1")

SQL["gene_based_filter_old"] = _with(
    _OLD_CSQ, _OLD_VRT, DBN, _OLD_CAND, _clv("clv_o", "vrt_o"), _hgm("hgm_o", "vrt_o"), _OLD_OVER, OCC, CARRIERS,
    DGN, HPO, _OLD_PHT) + _OLD_RESULT


# --- several studies at once (A5) -----------------------------------------------------------
SQL["gene_based_filter_multi_study"] = _with(
    CSQ, _vrt("vrt", _has("study", "SD_A", "SD_B")), DBN, _cand("cand", "vrt"), _clv("clv", "vrt"), _hgm("hgm", "vrt"),
    _over("over", "cand", "clv", "hgm"), OCC,
    "carriers AS (SELECT * FROM occ WHERE study_id IN ('SD_A', 'SD_B') AND NOT is_multi_allelic AND has_alt = 1 "
    "AND NOT (adj0 = 0 AND adj1 = 0))",
    DGN, HPO, PHT, STD, _result("res", "over", True, True)) + "SELECT * FROM res"
SQL["flagged_carriers_large_sets"] = SQL["flagged_carriers"]
SQL["clustered_genotype_join"] = SQL["flagged_carriers"]


# --- thresholds as a surface (P4): every setting restated over the rows before any threshold ----------------------
def _values(name: str, *values: float) -> str:
    return f"(SELECT CAST(unnest([{', '.join(map(str, values))}]) AS DOUBLE) AS {name})"


SQL["threshold_surface"] = _with(
    *FLAGSHIP_CTES[:8],
    "pool AS (SELECT f.max_gnomad_topmed, f.PredCountRatio_D2T, o.vaf, f.VariationID IS NOT NULL OR f.HGMDID IS NOT NULL AS known "
    f"FROM over f JOIN occ o ON {_on('f', 'o')} WHERE NOT o.is_multi_allelic AND o.has_alt = 1 AND NOT (o.call0 = 0 AND o.call1 = 0))",
    f"settings AS (SELECT * FROM {_values('maf', 0.0001, 0.001, 0.01, 0.5)}, {_values('dpc_l', 0.0, 0.3, 0.5)}, "
    f"{_values('dpc_u', 0.4, 0.8, 1.0)}, {_values('aaf', 0.0, 0.2, 0.45)})") + (
    "SELECT s.maf, s.dpc_l, s.dpc_u, s.aaf, count(p.known) AS n_rows, count(*) FILTER (p.known) AS n_known FROM settings s "
    "LEFT JOIN pool p ON (p.known OR (p.max_gnomad_topmed < s.maf AND (p.PredCountRatio_D2T IS NULL OR "
    "p.PredCountRatio_D2T BETWEEN s.dpc_l AND s.dpc_u))) AND coalesce(p.vaf >= s.aaf, true) GROUP BY ALL")


# --- study releases one by one: each study's own genotypes with the variants of that study ------------------------
def _study_run(tag: str, study: str) -> tuple[str, ...]:
    return (_vrt(f"vrt_{tag}", _has("study", study)), _cand(f"cand_{tag}", f"vrt_{tag}"), _clv(f"clv_{tag}", f"vrt_{tag}"),
            _hgm(f"hgm_{tag}", f"vrt_{tag}"), _over(f"over_{tag}", f"cand_{tag}", f"clv_{tag}", f"hgm_{tag}"),
            _result(f"res_{tag}", f"over_{tag}", True, True))


_RUN_COLS = (f"study_id, participant_id, biospecimen_id, CASE WHEN chromosome IN ({LEVELS}) THEN chromosome END AS chromosome, "
             "start, family_id, is_proband, study_code, VariationID, HGMDID")
SQL["incremental_results"] = _with(CSQ, DBN, OCC, CARRIERS, DGN, HPO, PHT, STD, *_study_run("a", "SD_A"),
                                   *_study_run("b", "SD_B")) + (
    f"SELECT {_RUN_COLS}, '0004' AS release, 'first' AS ran_in FROM res_a WHERE study_id = 'SD_A' "
    f"UNION ALL SELECT {_RUN_COLS}, '0011' AS release, 'second' AS ran_in FROM res_b WHERE study_id = 'SD_B'")
