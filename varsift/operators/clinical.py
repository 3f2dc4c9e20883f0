"""Clinical decoration: diagnoses, phenotypes / HPO codes and study codes per participant.

E1-E3, E6, E7, B13, B14, C10, J9-J12. Lists are built with ``collect_set`` (deduplicated in the
map-side partial aggregate, so no separate ``distinct`` shuffle) and sorted, which gives the same
multiset as the original distinct-then-``collect_list`` in a deterministic order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varsift.functions import expressions as X
from varsift.operators.sizing import skew_splittable
from varsift.params import CONFIRMED, HPO_CATEGORY


def diagnoses_combined(diagnoses: DataFrame, layout: str = "fhir") -> DataFrame:
    """E1 (+ C10): one row per participant with the sorted distinct diagnosis texts."""
    if layout == "fhir":
        df = diagnoses.select(X.normalise_participant("participant_fhir_id").alias("participant_id"),
                              F.col("source_text").alias("text"))
    else:
        df = diagnoses.select("participant_id", F.col("source_text_diagnosis").alias("text"))
    return df.where(F.col("participant_id").isNotNull()).groupBy("participant_id").agg(
        F.sort_array(F.collect_set("text")).alias("diagnoses_combined"))


def hpo_codes(phenotypes: DataFrame) -> DataFrame:
    """E6 + E7 + B14: ``(phenotype_id, code)`` for every HPO coding of every phenotype row."""
    hpo = F.filter("condition_coding", lambda c: c["category"] == HPO_CATEGORY)
    return phenotypes.select("phenotype_id", F.explode(F.transform(hpo, lambda c: c["code"])).alias("code"))


def _pairs_to_lists(grouped: DataFrame) -> DataFrame:
    pairs = F.col("pairs")
    return grouped.select(
        "participant_id",
        F.filter(F.transform(pairs, lambda p: p["text"]), lambda t: t.isNotNull()).alias("phenotypes_combined"),
        F.filter(F.transform(pairs, lambda p: p["code"]), lambda c: c.isNotNull()).alias("hpos_combined"),
    )


def phenotypes_combined(phenotypes: DataFrame, layout: str = "fhir") -> DataFrame:
    """E2 (+ J9, B13, C10): per participant, texts and HPO codes of distinct (text, code) pairs.

    A text with two codes appears twice in ``phenotypes_combined``; nulls are dropped from each
    list separately. Both lists follow the sorted order of the pairs.
    """
    if layout == "fhir":
        confirmed = phenotypes.where(F.col("observed") == CONFIRMED)
        joined = confirmed.select("phenotype_id", "participant_fhir_id", "source_text").join(
            hpo_codes(phenotypes), "phenotype_id", "left")
        df = joined.select(X.normalise_participant("participant_fhir_id").alias("participant_id"),
                           F.col("source_text").alias("text"), "code")
    else:
        df = phenotypes.select("participant_id", F.col("source_text_phenotype").alias("text"),
                               F.col("hpo_id_phenotype").alias("code"))
    grouped = df.where(F.col("participant_id").isNotNull()).groupBy("participant_id").agg(
        F.sort_array(F.collect_set(F.struct("text", "code"))).alias("pairs"))
    return _pairs_to_lists(grouped)


def of_participants(rows: DataFrame, participants: DataFrame, layout: str = "fhir") -> DataFrame:
    """The clinical rows of ``participants`` only, so that lists are built for them and nobody else."""
    own = X.normalise_participant("participant_fhir_id") if layout == "fhir" else F.col("participant_id")
    wanted = participants.select(F.col("participant_id").alias("__participant"))
    return rows.withColumn("__own", own).join(wanted, F.col("__own") == F.col("__participant"), "left_semi").drop("__own")


def study_codes(studies: DataFrame) -> DataFrame:
    """Distinct ``(study_id, study_code)`` pairs."""
    return studies.select("study_id", "study_code").distinct()


def clinical_lists(diagnoses: DataFrame, phenotypes: DataFrame, studies: DataFrame | None,
                   layout: str = "fhir", participants: DataFrame | None = None
                   ) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Per-participant diagnosis lists, phenotype/HPO lists and distinct study codes, of the given
    participants (default: all). Rows without a participant join nobody and are left out."""
    if participants is not None:
        diagnoses = of_participants(diagnoses, participants, layout)
        phenotypes = of_participants(phenotypes, participants, layout)
    return (diagnoses_combined(diagnoses, layout), phenotypes_combined(phenotypes, layout),
            study_codes(studies) if studies is not None else None)


def join_lists(carriers: DataFrame, lists: tuple[DataFrame, DataFrame, DataFrame | None]) -> DataFrame:
    """Left joins of the per-participant lists and the study codes.

    Both list tables have one row per participant, so they are combined first (full outer join) and
    joined to the carriers once; the combined lists are made skew-splittable so AQE can split a
    participant holding a large share of the carrier rows.
    """
    dgn, pht, std = lists
    per_participant = skew_splittable(dgn.join(pht, "participant_id", "full"))
    out = carriers.join(per_participant, "participant_id", "left")
    if std is not None:
        out = out.join(std, "study_id", "left")
    return out


def enrich(carriers: DataFrame, diagnoses: DataFrame, phenotypes: DataFrame, studies: DataFrame | None,
           layout: str = "fhir") -> DataFrame:
    """E1-E3 + J10-J12."""
    return join_lists(carriers, clinical_lists(diagnoses, phenotypes, studies, layout))
