"""Runs over new study releases only (A5 + P1 + P3): a ledger of finished (study, release, run key) results.

The genotype tables of studies arrive release by release (``.../occurrences_<study>_re_<release>``). ``update_results``
runs the filter for the releases whose result is not in the ledger yet, one run a study as the filter is meant to be
run, writes each result with P2 and then enters it; ``merged_results`` merges the results of the wanted releases with P3.
Genotypes of finished releases are not opened again.

The run key covers everything else a result depends on: the genes, the parameters, and a label of the annotation tables'
version that the caller gives. An entry is written after its result: a run that was cut short leaves a folder that no
entry names, and is repeated. Results are never changed; a new release gets a result of its own.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varsift.params import FilterParams
from varsift.plans.gene_filter import VariantTables, plan_gene_filter
from varsift.plans.jobs import COMBINED_TIE_COLUMNS, combine_results, write_result
from varsift.sources.readers import read_table, study_from_path

_RELEASE = re.compile(r"_re_([^/]+)")
ENTRY = "run_key string, study string, release string, result string, finished timestamp"


@dataclass(frozen=True)
class StudyRelease:
    """One study's genotype table of one release."""

    study: str
    release: str
    path: str

    @classmethod
    def at(cls, path: str) -> StudyRelease:
        """From the path's markers (A4): ``.../occurrences_sd_abc_re_04`` is release ``04`` of ``SD_ABC``."""
        study = study_from_path(path)
        found = _RELEASE.search(path)
        if found is None:
            raise ValueError(f"no release after '_re_' in path {path!r}")
        return cls(study, found.group(1), path)


@dataclass(frozen=True)
class Update:
    """What an update ran, and where the results of all wanted releases are."""

    ran: tuple[StudyRelease, ...]
    results: dict[StudyRelease, str]


def run_key(genes: Sequence[str], params: FilterParams, annotations: str = "") -> str:
    """Equal for runs that must give equal rows on equal genotypes (bounds of broadcasts and file names do not count)."""
    parts = {"genes": sorted(set(genes)), "maf": params.maf, "dpc_l": params.dpc_l, "dpc_u": params.dpc_u, "aaf": params.aaf,
             "known": sorted(params.known_variants), "significance": sorted(params.clinvar_significance),
             "profile": params.profile.name, "annotations": annotations}
    return hashlib.sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()


class ResultLedger:
    """The finished results under ``out_dir``: one small row a study, release and run key."""

    def __init__(self, spark: SparkSession, out_dir: str):
        self.spark, self.out_dir = spark, out_dir.rstrip("/")

    @property
    def path(self) -> str:
        return f"{self.out_dir}/ledger"

    def entries(self) -> DataFrame:
        try:
            return self.spark.read.schema(ENTRY).parquet(self.path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], ENTRY)

    def finished(self, key: str) -> dict[tuple[str, str], str]:
        """(study, release) to the result's path; of two equal runs at the same time either result serves."""
        rows = self.entries().where(F.col("run_key") == key).collect()
        return {(r.study, r.release): r.result for r in sorted(rows, key=lambda r: r.result)}

    def enter(self, key: str, source: StudyRelease, result: str) -> None:
        row = (key, source.study, source.release, result, _dt.datetime.now())
        self.spark.createDataFrame([row], ENTRY).coalesce(1).write.mode("append").parquet(self.path)


def update_results(spark: SparkSession, tables: VariantTables, genes: Sequence[str], sources: Sequence[StudyRelease],
                   out_dir: str, params: FilterParams = FilterParams(), annotations: str = "",
                   read: Callable[[StudyRelease], DataFrame] | None = None) -> Update:
    """Run the filter for the ``sources`` without a result of this run key; ``tables.occurrences`` is not read.

    ``read`` opens a release's genotypes (default: a Parquet table at its path); with a ``study_id`` column only the
    study's own rows (partitions) are taken. One release a study: another one of the same study is an error.
    """
    studies = [s.study for s in sources]
    if twice := sorted({s for s in studies if studies.count(s) > 1}):
        raise ValueError(f"more than one release of {', '.join(twice)}")
    read = read or (lambda source: read_table(spark, source.path))
    ledger, key = ResultLedger(spark, out_dir), run_key(genes, params, annotations)
    have = ledger.finished(key)
    ran, results = [], {}
    for source in sources:
        place = (source.study, source.release)
        if place not in have:
            genotypes = read(source)
            plan = plan_gene_filter(replace(tables, occurrences=genotypes), genes, [source.study], params,
                                    "study_id" in genotypes.columns)
            try:
                folder = f"{ledger.out_dir}/runs/{key[:16]}/{source.study}_{source.release}-{uuid.uuid4().hex}"
                have[place] = write_result(plan.result, folder, [source.study], params)
            finally:
                plan.release()
            ledger.enter(key, source, have[place])
            ran.append(source)
        results[source] = have[place]
    return Update(tuple(ran), results)


def merged_results(spark: SparkSession, update: Update, tie_columns: Sequence[str] = COMBINED_TIE_COLUMNS) -> DataFrame:
    """P3 over the results of the update's releases, new and earlier ones alike."""
    return combine_results(spark, list(update.results.values()), tie_columns)
