"""Annotation tables: canonical consequences, population frequencies, damage predictions, ClinVar, HGMD.

Each function takes the raw table and returns the projected, filtered frame the filter joins on.
Plain column predicates come first so that Parquet receives them as pushed filters.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varsift.functions import expressions as X
from varsift.operators.predicates import equals_bool_text
from varsift.params import (
    CLINVAR_SIGNIFICANCE,
    NEW_PROFILE,
    VARIANT_KEY,
    Profile,
)

KEY = list(VARIANT_KEY)


class GeneSet:
    """The genes of interest: a literal list (pushed to Parquet as ``IN``) or a DataFrame.

    A DataFrame gene set with a column ``gene`` is applied with semi-joins and never collected.
    """

    def __init__(self, genes: Sequence[str] | DataFrame):
        if isinstance(genes, DataFrame):
            self.frame: DataFrame | None = genes.select(F.col(genes.columns[0]).alias("gene"))
            self.values: tuple[str, ...] | None = None
        else:
            self.frame = None
            self.values = tuple(dict.fromkeys(genes))

    def keep(self, df: DataFrame, symbol: Column | str) -> DataFrame:
        """Rows of ``df`` whose ``symbol`` is a listed gene (case-sensitive, exact)."""
        sym = F.col(symbol) if isinstance(symbol, str) else symbol
        if self.values is not None:
            return df.where(sym.isin(list(self.values)))
        tagged = df.withColumn("__gene", sym)
        return tagged.join(self.frame.withColumnRenamed("gene", "__gene"), "__gene", "left_semi").drop("__gene")


def canonical_consequences(consequences: DataFrame, genes: GeneSet, studies: Sequence[str],
                           profile: Profile = NEW_PROFILE) -> DataFrame:
    """B1, B2 (+ B3 for the old layout): canonical annotations of the listed genes."""
    df = consequences
    for old, new in profile.consequence_renames:
        df = df.withColumnRenamed(old, new)
    if profile.consequence_drops:
        df = df.drop(*profile.consequence_drops)
    df = df.where(equals_bool_text(df, "original_canonical", True))
    df = genes.keep(df, "symbol")
    if profile.consequence_study_column:
        df = df.where(X.overlaps_any(profile.consequence_study_column, studies))
    return df.select(*KEY, *profile.consequence_columns)


def variant_frequencies(variants: DataFrame, studies: Sequence[str] | None,
                        profile: Profile = NEW_PROFILE) -> DataFrame:
    """Variants seen in the studies (all when ``studies`` is None), with each database's
    ``af`` and their maximum."""
    dbs = profile.frequency_databases
    parent = profile.frequency_parent
    if studies is not None:
        variants = variants.where(X.overlaps_any(profile.variant_study_field, studies))
    return (
        variants
        .select(
            *[X.frequency_column(db, parent).alias(f"{db}_af") for db in dbs],
            *KEY,
            X.max_population_af(dbs, parent).alias("max_gnomad_topmed"),
        )
    )


# Annotation columns carried into the result, in output order.
DAMAGE_COLUMNS = ["DamagePredCount", "PredCountRatio_D2T", "TWINSUK_AF", "ALSPAC_AF", "UK10K_AF"]


def damage_predictions(dbnsfp: DataFrame) -> DataFrame:
    """dbNSFP rows with the damaging-to-total prediction ratio."""
    return dbnsfp.select(*KEY, "DamagePredCount", X.damage_ratio("DamagePredCount").alias("PredCountRatio_D2T"),
                         "TWINSUK_AF", "ALSPAC_AF", "UK10K_AF")


# Curated-database columns carried into the result, in output order.
CLINVAR_COLUMNS = ["VariationID", "clin_sig", "conditions"]
HGMD_COLUMNS = ["HGMDID", "variant_class", "phen"]


def clinvar_candidates(clinvar: DataFrame, genes: GeneSet,
                       significance: Sequence[str] = CLINVAR_SIGNIFICANCE) -> DataFrame:
    """ClinVar records of a listed first gene with a pathogenic significance."""
    df = clinvar.withColumnRenamed("name", "VariationID").where(X.has_significance("clin_sig", significance))
    return genes.keep(df, X.first_gene("geneinfo")).select(*KEY, *CLINVAR_COLUMNS)


def hgmd_candidates(hgmd: DataFrame, genes: GeneSet) -> DataFrame:
    """HGMD records of listed genes with a disease-causing class (``DM``, ``DM?``)."""
    df = hgmd.withColumnRenamed("id", "HGMDID").where(X.is_disease_causing_class("variant_class"))
    return genes.keep(df, "symbol").select(*KEY, *HGMD_COLUMNS)


def seen_in_variants(candidates: DataFrame, study_variants: DataFrame) -> DataFrame:
    """Inner join with the study's variants on the key (repeats kept, as in the original)."""
    return candidates.join(study_variants.select(*KEY), KEY)


def chromosomes_of(gene_consequences: DataFrame) -> DataFrame:
    """Distinct chromosomes of the gene-restricted consequences."""
    return gene_consequences.select("chromosome").distinct()


def chromosome_filter(gene_consequences: DataFrame, max_literal: int = 5_000) -> Callable[[DataFrame], DataFrame]:
    """A filter to the rows on a chromosome of the gene consequences.

    Up to ``max_literal`` distinct values (at most one more is fetched) become a ``chromosome IN (...)`` filter,
    which reaches the scan and prunes chromosome partitions and row groups; more of them stay a frame and
    a semi-join. Either way the same rows are kept.
    """
    chromosomes = chromosomes_of(gene_consequences)
    rows = chromosomes.limit(max_literal + 1).collect()
    if len(rows) > max_literal:
        return lambda df: df.join(chromosomes, "chromosome", "left_semi")
    values = sorted(r[0] for r in rows if r[0] is not None)
    return lambda df: df.where(F.col("chromosome").isin(values))
