"""Mapping of the driver's test tables onto the genomic tables of the filter.

The test tables (``part``, ``lineitem``, ``orders``, ``events``, ``region``) hold no genomic data,
so each genomic table is defined as a SQL view over them. The view text is accepted unchanged by
Spark SQL and by DuckDB: the oracle queries embed it as common table expressions, while the Spark
side runs it with ``spark.sql`` and then wraps the flat columns into the nested shapes of the real
tables (structs, arrays of structs, arrays of calls). Every view keeps every row of its test table
(no row filters), so the work grows with the scale factor; which records "exist" in a database is
expressed through values (a non-pathogenic significance, a non-disease class, null annotations or
texts) that the library's own predicates then filter.
"""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Four variant-key columns derived from an integer column: one in 50 repeats its neighbour's key, a few lie on
# MT or lack their alternate.
_KEY = (
    "CASE WHEN {x} % 240 = 5 THEN 'MT' WHEN {x} % 24 = 22 THEN 'X' WHEN {x} % 24 = 23 THEN 'Y' "
    "ELSE CAST({x} % 24 + 1 AS STRING) END AS chromosome, "
    "{x} * 10 AS start, substr('ACGT', CAST({x} % 4 + 1 AS INT), 1) AS reference, "
    "CASE WHEN {x} % 233 <> 7 THEN substr('ACGT', CAST(({x} + 1) % 4 + 1 AS INT), 1) END AS alternate"
)
_STUDY = ("CASE WHEN p_partkey % 97 = 3 THEN NULL WHEN p_partkey % 10 = 5 THEN 'SD_A|SD_B' "
          "WHEN p_partkey % 10 = 0 THEN 'SD_B' ELSE 'SD_A' END")


def _key(x: str) -> str:
    return _KEY.replace("{x}", f"({x} - CASE WHEN {x} % 50 = 1 THEN 1 ELSE 0 END)")


# View text; ``{table}`` marks a test table.
VIEW_SQL: dict[str, str] = {
    "f_variants": f"""
SELECT {_key('p_partkey')},
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE CAST(p_partkey % 20 AS DOUBLE) / 100000 END AS topmed_af,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_partkey % 30 AS DOUBLE) / 200000 END AS gnomad_af,
  CASE WHEN p_partkey % 9 = 0 THEN CAST(p_partkey % 4 AS DOUBLE) / 50000 ELSE NULL END AS exomes_af,
  {_STUDY} AS study
FROM {{part}}""",
    "f_consequences": f"""
SELECT {_key('p_partkey')}, p_brand AS symbol, p_type AS consequence, p_size % 5 <> 0 AS original_canonical,
  CASE p_size % 4 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MODERATE' WHEN 2 THEN 'LOW' ELSE 'MODIFIER' END AS vep_impact,
  concat('ENSG', CAST(p_partkey AS STRING)) AS ensembl_gene_id,
  concat('NM_', CAST(p_partkey AS STRING)) AS refseq_mrna_id,
  concat('c.', CAST(p_size AS STRING), substr('ACGT', CAST(p_partkey % 4 + 1 AS INT), 1), '>',
         substr('ACGT', CAST((p_partkey + 1) % 4 + 1 AS INT), 1)) AS hgvsc,
  CASE WHEN p_size % 3 = 0 THEN NULL ELSE concat('p.', CAST(p_size AS STRING), 'X') END AS hgvsp,
  {_STUDY} AS study
FROM {{part}}
UNION ALL
SELECT {_key('p_partkey')}, p_brand, 'UPSTREAM', false, 'MODIFIER', concat('ENSG', CAST(p_partkey AS STRING)),
  NULL, NULL, NULL, {_STUDY}
FROM {{part}}""",
    "f_dbnsfp": f"""
SELECT {_key('p_partkey')},
  CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 11 = 0 THEN '.'
       WHEN p_partkey % 7 = 1 THEN '1_5' WHEN p_partkey % 7 = 2 THEN '7_4'
       ELSE concat(CAST(p_partkey % 6 AS STRING), '_', CAST((p_partkey % 6) * (p_size % 3) AS STRING)) END AS damage,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_partkey % 13 AS DOUBLE) / 1000 END AS twinsuk_af,
  CASE WHEN p_partkey % 3 = 0 OR p_partkey % 2 = 0 THEN NULL ELSE CAST(p_partkey % 17 AS DOUBLE) / 1000 END
    AS alspac_af,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) / 10000 END AS uk10k_af
FROM {{part}}""",
    "f_clinvar": f"""
SELECT {_key('p_partkey')}, CAST(1000 + p_partkey AS STRING) AS name,
  concat(p_brand, ':', CAST(p_partkey AS STRING), '|OTHER:1') AS geneinfo,
  CASE WHEN p_partkey % 29 = 0 THEN NULL WHEN p_partkey % 13 <> 0 THEN 'not_provided'
       WHEN p_size % 8 = 0 THEN 'Benign|Pathogenic' WHEN p_size % 4 = 0 THEN 'Pathogenic'
       WHEN p_size % 4 = 1 THEN 'Likely_pathogenic' WHEN p_size % 4 = 2 THEN 'Uncertain_significance'
       ELSE 'Benign' END AS sig,
  concat('COND_', CAST(p_size % 7 AS STRING)) AS condition
FROM {{part}}""",
    "f_hgmd": f"""
SELECT {_key('p_partkey')}, concat('CM', CAST(p_partkey AS STRING)) AS id, p_brand AS symbol,
  CASE WHEN p_partkey % 17 <> 0 THEN 'FP' WHEN p_size % 3 = 0 THEN 'DM' WHEN p_size % 3 = 1 THEN 'DM?'
       ELSE 'DFP' END AS variant_class,
  concat('PHEN_', CAST(p_size % 5 AS STRING)) AS phen
FROM {{part}}""",
    "f_occ": f"""
SELECT {_key('l_partkey')}, CASE WHEN l_orderkey % 101 = 0 THEN 0 ELSE CAST(l_quantity AS INT) END AS ad0,
  CASE WHEN l_orderkey % 101 = 0 THEN 0 ELSE l_linenumber END AS ad1,
  CASE l_returnflag WHEN 'R' THEN 1 ELSE 0 END AS call0,
  CASE l_returnflag WHEN 'N' THEN 0 ELSE 1 END AS call1,
  l_linenumber = 2 AS is_multi_allelic,
  CASE l_linestatus WHEN 'F' THEN 1 ELSE 0 END AS has_alt,
  CASE WHEN l_suppkey % 2 = 0 THEN 'SD_A' ELSE 'SD_B' END AS study_id,
  concat('PT_', CAST(l_suppkey AS STRING)) AS participant_id,
  concat('FM_', CAST(l_suppkey % 30 AS STRING)) AS family_id,
  l_linenumber = 1 AS is_proband,
  CAST(l_quantity AS INT) + l_linenumber AS dp,
  CASE WHEN l_discount >= 0.05 THEN 'PASS' ELSE 'LowQual' END AS filter,
  l_tax > 0.06 AS is_lo_conf_denovo,
  l_linenumber = 7 AS is_hi_conf_denovo,
  CASE l_returnflag WHEN 'A' THEN 'affected' ELSE 'not_affected' END AS affected_status,
  CASE WHEN l_suppkey % 3 = 0 THEN 'Female' ELSE 'Male' END AS gender,
  concat('BS_', CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING)) AS biospecimen_id,
  concat('PT_M', CAST(l_suppkey % 30 AS STRING)) AS mother_id,
  concat('PT_F', CAST(l_suppkey % 30 AS STRING)) AS father_id
FROM {{lineitem}}""",
    "f_diagnoses": """
SELECT concat('pt-', CAST(o_custkey AS STRING)) AS participant_fhir_id,
  CASE WHEN o_orderkey % 10 = 0 THEN o_orderpriority END AS source_text
FROM {orders}""",
    "f_phenotypes": """
SELECT event_id AS phenotype_id, concat('pt-', CAST(user_id AS STRING)) AS participant_fhir_id,
  event_type AS source_text, CASE WHEN event_id % 4 = 0 THEN 'negative' ELSE 'confirmed' END AS observed
FROM {events}""",
    "f_codings": """
SELECT event_id AS phenotype_id, CASE WHEN event_id % 3 = 0 THEN 'HPO' ELSE 'ICD' END AS category,
  concat('HP:', CAST(event_id % 50 AS STRING)) AS code FROM {events}
UNION ALL
SELECT event_id, CASE WHEN (event_id + 1) % 3 = 0 THEN 'HPO' ELSE 'ICD' END,
  concat('HP:', CAST((event_id + 1) % 50 AS STRING)) FROM {events}""",
    "f_studies": """
SELECT CASE r_regionkey WHEN 0 THEN 'SD_A' WHEN 1 THEN 'SD_B' ELSE concat('SD_', CAST(r_regionkey AS STRING)) END
  AS study_id, r_name AS study_code
FROM {region}""",
}

VIEW_TABLES: dict[str, tuple[str, ...]] = {
    "f_variants": ("part",),
    "f_consequences": ("part",),
    "f_dbnsfp": ("part",),
    "f_clinvar": ("part",),
    "f_hgmd": ("part",),
    "f_occ": ("lineitem",),
    "f_diagnoses": ("orders",),
    "f_phenotypes": ("events",),
    "f_codings": ("events",),
    "f_studies": ("region",),
}

# Flagship parameters on the mapped tables.
FLAGSHIP_GENES = ("Brand#1", "Brand#2", "Brand#3")
FLAGSHIP_STUDIES = ("SD_A",)


def oracle_ctes(*views: str) -> str:
    """``WITH`` clause defining the requested views over DuckDB's pre-registered tables."""
    parts = []
    for v in views:
        text = VIEW_SQL[v].format(**{t: t for t in VIEW_TABLES[v]})
        parts.append(f"{v} AS ({text.strip()})")
    return "WITH " + ",\n".join(parts) + "\n"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def flat_view(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """The flat view as Spark runs it (same SQL text as the oracle)."""
    tables = {t: _read(spark, sf_dir, t) for t in VIEW_TABLES[view]}
    return spark.sql(VIEW_SQL[view], **tables)


def _list(column: str):
    """``|``-joined text as an array; null stays null."""
    return F.split(column, r"\|")


_KEYS = ["chromosome", "start", "reference", "alternate"]


class MappedTables:
    """Genomic-shaped tables (new profile) built lazily from the test tables.

    Each table is defined on first use and kept, so several queries on the same session and
    directory share the definitions (plans only; no data is cached).
    """

    NAMES = ("consequences", "variants", "dbnsfp", "clinvar", "hgmd", "occurrences", "diagnoses", "phenotypes",
             "studies", "old_consequences", "old_variants", "old_diagnoses", "old_phenotypes")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark = spark
        self._sf_dir = sf_dir.rstrip("/")
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in MappedTables.NAMES:
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = getattr(self, f"_build_{name}")()
        return self._built[name]

    def stopped(self) -> bool:
        """Whether the session's context is no longer the one these definitions were made with."""
        return self._spark._jsc.sc().isStopped()

    def _fv(self, view: str) -> DataFrame:
        return flat_view(self._spark, self._sf_dir, view)

    def _build_variants(self) -> DataFrame:
        return self._fv("f_variants").select(
            *_KEYS,
            F.struct(
                F.struct(F.col("topmed_af").alias("af")).alias("topmed_bravo"),
                F.struct(F.col("gnomad_af").alias("af")).alias("gnomad_genomes_2_1_1"),
                F.struct(F.col("exomes_af").alias("af")).alias("gnomad_exomes_2_1_1"),
                F.when(F.col("gnomad_af").isNotNull(), F.struct(F.col("gnomad_af").alias("af")))
                .alias("gnomad_genomes_3"),
            ).alias("external_frequencies"),
            F.transform(_list("study"), lambda s: F.struct(s.alias("study_id"))).alias("studies"),
        )

    def _build_consequences(self) -> DataFrame:
        return self._fv("f_consequences").select(
            *_KEYS, "original_canonical", F.array("consequence").alias("consequence"), "vep_impact", "symbol",
            "ensembl_gene_id", "refseq_mrna_id", "hgvsc", "hgvsp",
        )

    def _build_dbnsfp(self) -> DataFrame:
        return self._fv("f_dbnsfp").select(
            *_KEYS, F.col("damage").alias("DamagePredCount"), F.col("twinsuk_af").alias("TWINSUK_AF"),
            F.col("alspac_af").alias("ALSPAC_AF"), F.col("uk10k_af").alias("UK10K_AF"),
        )

    def _build_clinvar(self) -> DataFrame:
        return self._fv("f_clinvar").select(
            *_KEYS, "name", "geneinfo", _list("sig").alias("clin_sig"), F.array("condition").alias("conditions"),
        )

    def _build_hgmd(self) -> DataFrame:
        return self._fv("f_hgmd").select(*_KEYS, "id", "symbol", "variant_class", "phen")

    def _build_occurrences(self) -> DataFrame:
        return self._fv("f_occ").select(
            *_KEYS,
            F.array("ad0", "ad1").alias("ad"), "dp", F.array("call0", "call1").alias("calls"), "filter",
            "is_lo_conf_denovo", "is_hi_conf_denovo", "is_proband", "affected_status", "gender", "study_id",
            "biospecimen_id", "participant_id", "mother_id", "father_id", "family_id", "is_multi_allelic",
            "has_alt",
        )

    def _build_diagnoses(self) -> DataFrame:
        return self._fv("f_diagnoses")

    def _build_phenotypes(self) -> DataFrame:
        # Each event carries exactly the two codings of the f_codings union, so the coding array is
        # built per row (no grouping needed); the oracle keeps the flat union.
        events = _read(self._spark, self._sf_dir, "events")
        eid = F.col("event_id")
        coding = F.array(
            F.struct(F.when(eid % 3 == 0, F.lit("HPO")).otherwise(F.lit("ICD")).alias("category"),
                     F.concat(F.lit("HP:"), (eid % 50).cast("string")).alias("code")),
            F.struct(F.when((eid + 1) % 3 == 0, F.lit("HPO")).otherwise(F.lit("ICD")).alias("category"),
                     F.concat(F.lit("HP:"), ((eid + 1) % 50).cast("string")).alias("code")),
        )
        return events.select(
            eid.alias("phenotype_id"),
            F.concat(F.lit("pt-"), F.col("user_id").cast("string")).alias("participant_fhir_id"),
            F.col("event_type").alias("source_text"),
            F.when(eid % 4 == 0, F.lit("negative")).otherwise(F.lit("confirmed")).alias("observed"),
            coding.alias("condition_coding"),
        )

    def _build_studies(self) -> DataFrame:
        return self._fv("f_studies")


    # --- the earlier ("old") layout --------------------------------------------------------

    def _build_old_consequences(self) -> DataFrame:
        return self._fv("f_consequences").select(
            *_KEYS, "original_canonical", F.array("consequence").alias("consequences"),
            F.col("refseq_mrna_id").alias("name"), F.lit("SNV").alias("variant_class"),
            F.col("vep_impact").alias("impact"), "symbol", "ensembl_gene_id", "refseq_mrna_id",
            F.col("hgvsc").alias("hgvsg"), "hgvsc", "hgvsp", _list("study").alias("study_ids"),
        )

    def _build_old_variants(self) -> DataFrame:
        af = lambda c: F.struct(F.col(c).alias("af"))
        return self._fv("f_variants").select(
            *_KEYS, af("topmed_af").alias("topmed"), af("gnomad_af").alias("gnomad_genomes_2_1"),
            af("exomes_af").alias("gnomad_exomes_2_1"), F.lit(None).cast("struct<af:double>").alias("gnomad_genomes_3_0"),
            af("gnomad_af").alias("gnomad_genomes_3_1_1"), _list("study").alias("studies"),
        )

    def _build_old_diagnoses(self) -> DataFrame:
        return self._fv("f_diagnoses").select(
            F.translate(F.upper("participant_fhir_id"), "-", "_").alias("participant_id"),
            F.col("source_text").alias("source_text_diagnosis"))

    def _build_old_phenotypes(self) -> DataFrame:
        hpo = F.filter("condition_coding", lambda c: c["category"] == "HPO")
        return self.phenotypes.select(
            F.translate(F.upper("participant_fhir_id"), "-", "_").alias("participant_id"),
            F.col("source_text").alias("source_text_phenotype"),
            F.explode_outer(F.transform(hpo, lambda c: c["code"])).alias("hpo_id_phenotype"))


_MAPPED: WeakKeyDictionary[SparkSession, dict[str, MappedTables]] = WeakKeyDictionary()


def mapped_tables(spark: SparkSession, sf_dir: str) -> MappedTables:
    """The mapped tables of ``sf_dir`` for this session (definitions shared between queries)."""
    own = _MAPPED.setdefault(spark, {})
    key = sf_dir.rstrip("/")
    if key not in own or own[key].stopped():
        own[key] = MappedTables(spark, sf_dir)
    return own[key]

