"""Job parameters and the two supported table layouts ("profiles")."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values that must match the reference behaviour.
VARIANT_KEY = ("chromosome", "start", "reference", "alternate")
DEFAULT_MAF = 0.0001
DEFAULT_DPC_L = 0.5
DEFAULT_DPC_U = 1.0
DEFAULT_AAF = 0.2
DEFAULT_BASENAME = "gene-based-variant-filtering"
KNOWN_DATABASES = ("ClinVar", "HGMD")
CLINVAR_SIGNIFICANCE = ("Pathogenic", "Likely_pathogenic")
CLINVAR_SIGNIFICANCE_WITH_VUS = ("Pathogenic", "Likely_pathogenic", "Uncertain_significance")
HGMD_CLASS_PREFIX = "DM"
HPO_CATEGORY = "HPO"
CONFIRMED = "confirmed"


@dataclass(frozen=True)
class Profile:
    """Column layout of one generation of the input tables."""

    name: str
    consequence_columns: tuple[str, ...]
    consequence_renames: tuple[tuple[str, str], ...]
    consequence_drops: tuple[str, ...]
    consequence_study_column: str | None
    frequency_parent: str | None
    frequency_databases: tuple[str, ...]
    variant_study_field: str
    occurrence_columns: tuple[str, ...]
    clinical_layout: str  # "fhir" (normalised ids, coded phenotypes) or "flat"
    has_studies_table: bool
    sorted_output: bool


# Column names of the two table generations (inputs and output files use them).
_OCC_BASE = (
    "ad", "dp", "variant_allele_fraction", "calls", "adjusted_calls", "filter",
    "is_lo_conf_denovo", "is_hi_conf_denovo", "is_proband", "affected_status", "gender",
)
_OCC_IDS = ("biospecimen_id", "participant_id", "mother_id", "father_id", "family_id")

NEW_PROFILE = Profile(
    name="new",
    consequence_columns=(
        "consequence", "vep_impact", "symbol", "ensembl_gene_id", "refseq_mrna_id", "hgvsc", "hgvsp",
    ),
    consequence_renames=(),
    consequence_drops=(),
    consequence_study_column=None,
    frequency_parent="external_frequencies",
    frequency_databases=("topmed_bravo", "gnomad_genomes_2_1_1", "gnomad_exomes_2_1_1", "gnomad_genomes_3"),
    variant_study_field="studies.study_id",
    occurrence_columns=_OCC_BASE + ("study_id",) + _OCC_IDS,
    clinical_layout="fhir",
    has_studies_table=True,
    sorted_output=True,
)

OLD_PROFILE = Profile(
    name="old",
    consequence_columns=(
        "consequences", "rsID", "impact", "symbol", "ensembl_gene_id", "refseq_mrna_id", "hgvsg", "hgvsc",
        "hgvsp", "study_ids",
    ),
    consequence_renames=(("name", "rsID"),),
    consequence_drops=("variant_class",),
    consequence_study_column="study_ids",
    frequency_parent=None,
    frequency_databases=("topmed", "gnomad_genomes_2_1", "gnomad_exomes_2_1", "gnomad_genomes_3_0",
                         "gnomad_genomes_3_1_1"),
    variant_study_field="studies",
    occurrence_columns=_OCC_BASE + _OCC_IDS,
    clinical_layout="flat",
    has_studies_table=False,
    sorted_output=False,
)

PROFILES = {p.name: p for p in (NEW_PROFILE, OLD_PROFILE)}


def _canonical_database(name: str) -> str:
    for known in KNOWN_DATABASES:
        if name.strip().lower() == known.lower():
            return known
    raise ValueError(f"unknown known-variant database {name!r}; expected one of {KNOWN_DATABASES}")


@dataclass(frozen=True)
class FilterParams:
    """Thresholds and switches of the gene-based filter.

    Thresholds may be given as strings (as they arrive from a command line); they are parsed
    to floats so that comparisons are numeric.
    """

    maf: float = DEFAULT_MAF
    dpc_l: float = DEFAULT_DPC_L
    dpc_u: float = DEFAULT_DPC_U
    aaf: float = DEFAULT_AAF
    known_variants: tuple[str, ...] = KNOWN_DATABASES
    clinvar_significance: tuple[str, ...] = CLINVAR_SIGNIFICANCE
    profile: Profile = NEW_PROFILE
    # Broadcast bounds, checked against measured row counts (above them: shuffle joins + AQE).
    # Key sets are four narrow columns (~50 bytes a row); annotated rows carry ~30 columns.
    broadcast_max_keys: int = 2_000_000
    broadcast_max_rows: int = 500_000
    # Bytes of the measured (cached) rows: wide rows are not broadcast even when few.
    broadcast_max_bytes: int = 256 << 20
    # When even the flagged keys are too many to broadcast, the genotype rows are first cut to the
    # genome regions (chromosome, start // region_bin_size) of the flagged variants. Coordinates
    # bound the number of regions (~310k for a 3.1 Gb genome at 10 kb); it is measured as well.
    region_bin_size: int = 10_000
    # With too many flagged keys to broadcast, the genotype rows are cut by a Bloom filter of at most this many
    # 64-bit words (0: none) where they are read, unless more than ``key_filter_max_share`` of other keys would pass.
    key_filter_words: int = 1 << 20
    key_filter_max_share: float = 0.5
    # Above the broadcast bounds, variant keys with this many rows are spread over tasks in the annotation joins.
    heavy_key_rows: int = 1_000_000
    # Restrict the annotation tables to the variant keys of the listed genes before joining.
    key_reduction: bool = True
    output_basename: str = DEFAULT_BASENAME
    # Literal chromosomes of the genes reach the scans as an IN filter; more distinct ones are a semi-join.
    max_literal_chromosomes: int = 5_000

    def __post_init__(self):
        for name in ("maf", "dpc_l", "dpc_u", "aaf"):
            object.__setattr__(self, name, float(getattr(self, name)))
        dbs = tuple(dict.fromkeys(_canonical_database(d) for d in self.known_variants))
        object.__setattr__(self, "known_variants", dbs)
        object.__setattr__(self, "clinvar_significance", tuple(self.clinvar_significance))
        if isinstance(self.profile, str):
            object.__setattr__(self, "profile", PROFILES[self.profile])
        if min(self.broadcast_max_rows, self.broadcast_max_keys, self.broadcast_max_bytes) < 0:
            raise ValueError("broadcast bounds must be >= 0")
        if self.region_bin_size <= 0:
            raise ValueError("region_bin_size must be > 0")

    @property
    def use_clinvar(self) -> bool:
        return "ClinVar" in self.known_variants

    @property
    def use_hgmd(self) -> bool:
        return "HGMD" in self.known_variants
