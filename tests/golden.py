"""Hand-made tables in the new layout; every row is kept or dropped for one stated reason."""

from pyspark.sql import types as T

from varsift.plans.gene_filter import VariantTables

GENES = ["GENE1", "GENE2"]
STUDY = "SD_X"

KEY = [T.StructField("chromosome", T.StringType()), T.StructField("start", T.LongType()),
       T.StructField("reference", T.StringType()), T.StructField("alternate", T.StringType())]
AF = T.StructType([T.StructField("af", T.DoubleType())])

CSQ_SCHEMA = T.StructType(KEY + [T.StructField(n, t) for n, t in [
    ("original_canonical", T.BooleanType()), ("consequence", T.ArrayType(T.StringType())),
    ("vep_impact", T.StringType()), ("symbol", T.StringType()), ("ensembl_gene_id", T.StringType()),
    ("refseq_mrna_id", T.StringType()), ("hgvsc", T.StringType()), ("hgvsp", T.StringType())]])
VAR_SCHEMA = T.StructType(KEY + [
    T.StructField("external_frequencies", T.StructType([T.StructField(d, AF) for d in (
        "topmed_bravo", "gnomad_genomes_2_1_1", "gnomad_exomes_2_1_1", "gnomad_genomes_3")])),
    T.StructField("studies", T.ArrayType(T.StructType([T.StructField("study_id", T.StringType())])))])
DBN_SCHEMA = T.StructType(KEY + [T.StructField("DamagePredCount", T.StringType()),
                                 T.StructField("TWINSUK_AF", T.DoubleType()), T.StructField("ALSPAC_AF", T.DoubleType()),
                                 T.StructField("UK10K_AF", T.DoubleType())])
CLV_SCHEMA = T.StructType(KEY + [T.StructField("name", T.StringType()), T.StructField("geneinfo", T.StringType()),
                                 T.StructField("clin_sig", T.ArrayType(T.StringType())),
                                 T.StructField("conditions", T.ArrayType(T.StringType()))])
HGMD_SCHEMA = T.StructType(KEY + [T.StructField(n, T.StringType()) for n in ("id", "symbol", "variant_class", "phen")])
OCC_SCHEMA = T.StructType(KEY + [T.StructField(n, t) for n, t in [
    ("ad", T.ArrayType(T.IntegerType())), ("dp", T.IntegerType()), ("calls", T.ArrayType(T.IntegerType())),
    ("filter", T.StringType()), ("is_lo_conf_denovo", T.BooleanType()), ("is_hi_conf_denovo", T.BooleanType()),
    ("is_proband", T.BooleanType()), ("affected_status", T.StringType()), ("gender", T.StringType()),
    ("study_id", T.StringType()), ("biospecimen_id", T.StringType()), ("participant_id", T.StringType()),
    ("mother_id", T.StringType()), ("father_id", T.StringType()), ("family_id", T.StringType()),
    ("is_multi_allelic", T.BooleanType()), ("has_alt", T.IntegerType())]])
DGN_SCHEMA = T.StructType([T.StructField("participant_fhir_id", T.StringType()),
                           T.StructField("source_text", T.StringType())])
CODING = T.ArrayType(T.StructType([T.StructField("category", T.StringType()), T.StructField("code", T.StringType())]))
PHT_SCHEMA = T.StructType([T.StructField("phenotype_id", T.StringType()),
                           T.StructField("participant_fhir_id", T.StringType()),
                           T.StructField("source_text", T.StringType()), T.StructField("observed", T.StringType()),
                           T.StructField("condition_coding", CODING)])
STD_SCHEMA = T.StructType([T.StructField("study_id", T.StringType()), T.StructField("study_code", T.StringType())])

# name: (key, gene, canonical, max af, study, damage)
VARIANTS = {
    "v1": (("1", 100, "A", "G"), "GENE1", True, 0.00001, STUDY, "3_5"),    # rare, ratio 0.6: kept
    "v2": (("1", 200, "C", "T"), "GENE1", True, 0.01, STUDY, "3_5"),       # common: kept by ClinVar only
    "v3": (("2", 300, "G", "A"), "GENE2", True, 0.01, STUDY, None),        # common: kept by HGMD only (DM?)
    "v4": (("2", 400, "T", "C"), "GENE2", True, 0.0001, STUDY, "3_5"),     # max af == maf: dropped
    "v5": (("X", 500, "A", "C"), "GENE1", True, 0.0, STUDY, "1_2"),        # ratio == dpc_l: kept
    "v6": (("X", 600, "A", "T"), "GENE1", True, None, STUDY, "4_4"),       # ratio == dpc_u: kept
    "v7": (("3", 700, "C", "G"), "GENE1", True, 0.00001, STUDY, "1_4"),    # ratio < dpc_l: dropped
    "v8": (("3", 800, "C", "A"), "GENE3", True, 0.00001, STUDY, "3_5"),    # gene not listed: dropped
    "v9": (("4", 900, "G", "T"), "GENE1", False, 0.00001, STUDY, "3_5"),   # not canonical: dropped
    "v10": (("5", 1000, "T", "G"), "GENE2", True, 0.00001, "SD_OTHER", "3_5"),  # other study: dropped
    "v11": (("6", 1100, "A", "G"), "GENE1", True, 0.00001, STUDY, "0_0"),  # ratio null: kept
    "v12": (("7", 1200, "A", "G"), "GENE2", True, 0.01, STUDY, "3_5"),     # ClinVar combined element: dropped
    "v13": (("8", 1300, "A", "G"), "GENE2", True, 0.01, STUDY, "3_5"),     # HGMD DFP, ClinVar first gene GENE9
}

# biospecimen: (variant, ad, calls, multi, has_alt, participant)
SAMPLES = {
    "s1": ("v1", [8, 2], [0, 1], False, 1, "PT_1"),      # vaf == aaf: kept
    "s2": ("v1", [9, 1], [0, 1], False, 1, "PT_1"),      # vaf < aaf: adjusted [0,0], dropped
    "s3": ("v1", [5, 5], [0, 1], True, 1, "PT_1"),       # multi-allelic: dropped
    "s4": ("v1", [5, 5], [0, 1], False, 0, "PT_1"),      # no alternate: dropped
    "s5": ("v2", [0, 0], [1, 1], False, 1, "PT_2"),      # zero depth: vaf null, calls kept
    "s6": ("v3", [5, 5], [0, 0], False, 1, "PT_3"),      # reference call: dropped
    "s7": ("v3", [5, 5], [-1, -1], False, 1, "PT_3"),    # no-call [-1,-1] passes
    "s8": ("v5", [3], [0, 1], False, 1, "PT_4"),         # one-element ad: vaf null, kept
    "s9": ("v6", None, [1, 1], False, 1, "PT_5"),        # null ad: kept
    "s10": ("v4", [5, 5], [0, 1], False, 1, "PT_6"),     # variant not flagged: dropped
    "s11": ("v11", [5, 5], [0, 1], False, 1, "PT_1"),    # kept
    "s12": ("v7", [5, 5], [0, 1], False, 1, "PT_7"),     # variant not flagged: dropped
}

EXPECTED = {("v1", "s1"), ("v2", "s5"), ("v3", "s7"), ("v5", "s8"), ("v6", "s9"), ("v11", "s11")}


def tables(spark) -> VariantTables:
    csq, var, dbn = [], [], []
    for name, (key, gene, canonical, af, study, damage) in VARIANTS.items():
        csq.append((*key, canonical, ["missense_variant"], "MODERATE", gene, f"ENSG_{gene}", f"NM_{name}",
                    f"c.{name}", None))
        csq.append((*key, False, ["upstream_gene_variant"], "MODIFIER", gene, f"ENSG_{gene}", None, None, None))
        freqs = ((af,), None, (None,), (af / 2 if af else af,))
        var.append((*key, freqs, [(study,)]))
        if damage is not None:
            dbn.append((*key, damage, 0.1, None, 0.2))
    k = {n: v[0] for n, v in VARIANTS.items()}
    clv = [
        (*k["v2"], "VCV2", "GENE1:1|OTHER:2", ["Pathogenic"], ["Cond A"]),
        (*k["v12"], "VCV12", "GENE2:1", ["Pathogenic/Likely_pathogenic"], ["Cond B"]),
        (*k["v13"], "VCV13", "GENE9:1|GENE2:2", ["Likely_pathogenic"], ["Cond C"]),
        (*k["v8"], "VCV8", "GENE3:1", ["Pathogenic"], None),
    ]
    hgmd = [
        (*k["v3"], "CM3", "GENE2", "DM?", "Phen 3"),
        (*k["v13"], "CM13", "GENE2", "DFP", "Phen 13"),
        (*k["v4"], "CM4", "GENE2", "dm", "Phen 4"),
    ]
    occ = []
    for bs, (v, ad, calls, multi, has_alt, pt) in SAMPLES.items():
        occ.append((*k[v], ad, sum(ad) if ad else None, calls, "PASS", False, False, bs == "s1", "affected",
                    "Female", STUDY, bs, pt, "PT_M", "PT_F", f"FM_{pt}", multi, has_alt))
    dgn = [("pt-1", "b"), ("pt-1", "a"), ("pt-1", "a"), ("pt-1", None), ("pt-3", "c")]
    pht = [
        ("ph1", "pt-1", "p-text1", "confirmed", [("HPO", "HP:1"), ("ICD", "X1")]),
        ("ph2", "pt-1", "p-text2", "confirmed", [("HPO", "HP:2"), ("HPO", "HP:3")]),
        ("ph3", "pt-1", "neg", "negative", [("HPO", "HP:9")]),
        ("ph4", "pt-1", "p-text1", "confirmed", None),
        ("ph5", "pt-3", None, "confirmed", [("ICD", "X2")]),
    ]
    std = [(STUDY, "CODE_X"), (STUDY, "CODE_X"), ("SD_OTHER", "CODE_O")]
    mk = spark.createDataFrame
    return VariantTables(
        consequences=mk(csq, CSQ_SCHEMA), variants=mk(var, VAR_SCHEMA), dbnsfp=mk(dbn, DBN_SCHEMA),
        occurrences=mk(occ, OCC_SCHEMA), diagnoses=mk(dgn, DGN_SCHEMA), phenotypes=mk(pht, PHT_SCHEMA),
        clinvar=mk(clv, CLV_SCHEMA), hgmd=mk(hgmd, HGMD_SCHEMA), studies=mk(std, STD_SCHEMA))


def key_to_variant():
    return {(v[0][0], v[0][1]): n for n, v in VARIANTS.items()}


def pairs(rows):
    kv = key_to_variant()
    return {(kv[(r["chromosome"], r["start"])], r["biospecimen_id"]) for r in rows}
