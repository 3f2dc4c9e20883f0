"""Candidate variants and their keep flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varsift.functions import expressions as X
from varsift.operators.annotations import CLINVAR_COLUMNS, HGMD_COLUMNS, KEY
from varsift.operators.skew import spread_join

#: Tasks over which the rows of one heavy variant key are dealt.
SALTS = 64


def annotate_candidates(gene_variants: DataFrame, damage: DataFrame, maf: float, dpc_l: float,
                        dpc_u: float, heavy: Sequence[int] = ()) -> DataFrame:
    """J2 + C8: left join of damage predictions and the rare-and-damaging flag (1/0)."""
    joined = spread_join(gene_variants, damage, KEY, heavy, SALTS, "left")
    return joined.withColumn(
        "flag", X.rare_damaging_flag("max_gnomad_topmed", "PredCountRatio_D2T", maf, dpc_l, dpc_u))


def override_with_known(candidates: DataFrame, known: DataFrame, id_column: str, columns: list[str],
                        heavy: Sequence[int] = ()) -> DataFrame:
    """J5 / J6 + C9: left join of a curated database; a matched record forces the flag to 1.

    The database's columns are always present (null when nothing matched), so the output schema
    does not depend on the data.
    """
    joined = spread_join(candidates, known.select(*KEY, *columns), KEY, heavy, SALTS, "left")
    return joined.withColumn("flag", X.known_override("flag", id_column))


def override_with_clinvar(candidates: DataFrame, clinvar_seen: DataFrame, heavy: Sequence[int] = ()) -> DataFrame:
    return override_with_known(candidates, clinvar_seen, "VariationID", CLINVAR_COLUMNS, heavy)


def override_with_hgmd(candidates: DataFrame, hgmd_seen: DataFrame, heavy: Sequence[int] = ()) -> DataFrame:
    return override_with_known(candidates, hgmd_seen, "HGMDID", HGMD_COLUMNS, heavy)


def keep_flagged(candidates: DataFrame) -> DataFrame:
    """B12 + C5: rows whose flag is 1, without the flag."""
    return candidates.where(F.col("flag") == 1).drop("flag")


def gene_variants(gene_consequences: DataFrame, study_variants: DataFrame, heavy: Sequence[int] = ()) -> DataFrame:
    """Canonical consequences of the genes x the study's variants (inner, repeats kept); rows of the ``heavy`` keys
    of the variants are spread over tasks."""
    if not heavy:
        return gene_consequences.join(study_variants, KEY)
    joined = spread_join(study_variants, gene_consequences, KEY, heavy, SALTS)
    own = [c for c in study_variants.columns if c not in KEY]
    return joined.select(*gene_consequences.columns, *own)
