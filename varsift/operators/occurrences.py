"""Genotype calls: credible carriers and their join with the flagged variants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varsift.functions import expressions as X
from varsift.operators.annotations import KEY
from varsift.operators.predicates import equals_bool_text, equals_one
from varsift.params import NEW_PROFILE, Profile


def with_adjusted_calls(occurrences: DataFrame, aaf: float) -> DataFrame:
    """C6 + C7: variant allele fraction and calls reset to ``[0, 0]`` below ``aaf``."""
    return (occurrences
            .withColumn("variant_allele_fraction", X.allele_fraction("ad"))
            .withColumn("adjusted_calls", X.adjusted_calls("variant_allele_fraction", "calls", aaf)))


def credible_carriers(occurrences: DataFrame, aaf: float, profile: Profile = NEW_PROFILE,
                      studies: Sequence[str] | None = None) -> DataFrame:
    """Biallelic sites with the alternate allele present and a non-reference adjusted call.

    ``studies`` (optional) restricts to those ``study_id`` values, which prunes a
    ``study_id``-partitioned table to the listed partitions.
    """
    occ = occurrences
    if studies is not None:
        occ = occ.where(F.col("study_id").isin(list(studies)))
    occ = occ.where(equals_bool_text(occ, "is_multi_allelic", False) & equals_one(occ, "has_alt"))
    occ = with_adjusted_calls(occ, aaf).where(X.is_called("adjusted_calls"))
    return occ.select(*KEY, *profile.occurrence_columns)


def join_carriers(flagged: DataFrame, carriers: DataFrame, flagged_keys: DataFrame | None = None) -> DataFrame:
    """Flagged variants x carriers on the variant key.

    ``flagged_keys`` (distinct keys of ``flagged``, optionally broadcast) first reduces the
    carriers with a semi-join, so the large genotype table is filtered where it is read and never
    shuffled as a whole.
    """
    if flagged_keys is not None:
        carriers = carriers.join(flagged_keys, KEY, "left_semi")
    return flagged.join(carriers, KEY)


def region_of(start: str = "start", bin_size: int = 10_000):
    """Genome region index of a position (``start // bin_size``)."""
    return F.floor(F.col(start) / F.lit(bin_size)).cast("long")


def genome_regions(variants: DataFrame, bin_size: int) -> DataFrame:
    """Distinct (chromosome, region) pairs of a set of variants."""
    return variants.select("chromosome", region_of("start", bin_size).alias("__region")).distinct()


def keep_regions(rows: DataFrame, regions: DataFrame, bin_size: int) -> DataFrame:
    """Rows inside the given regions (a superset of the wanted keys; an exact key join follows)."""
    tagged = rows.withColumn("__region", region_of("start", bin_size))
    return tagged.join(regions, ["chromosome", "__region"], "left_semi").drop("__region")
