"""Runs over new study releases only."""

from collections import Counter
from dataclasses import replace

import golden as G
import pytest
from pyspark.sql import functions as F

from varsift.params import FilterParams
from varsift.plans.incremental import ResultLedger, StudyRelease, merged_results, run_key, update_results

A = StudyRelease("SD_X", "01", "/lake/occurrences_sd_x_re_01")
B = StudyRelease("SD_NONE", "07", "/lake/occurrences_sd_none_re_07")


def test_release_from_path():
    assert StudyRelease.at("s3a://b/lake/occurrences_sd_abc_re_000004/x") == StudyRelease(
        "SD_ABC", "000004", "s3a://b/lake/occurrences_sd_abc_re_000004/x")
    with pytest.raises(ValueError):
        StudyRelease.at("/lake/occurrences_abc")


def test_run_key_covers_what_rows_depend_on():
    base = run_key(["G1", "G2"], FilterParams())
    assert base == run_key(["G2", "G1", "G1"], FilterParams(broadcast_max_rows=1, output_basename="other"))
    others = [run_key(["G1"], FilterParams()), run_key(["G1", "G2"], FilterParams(), "v2")]
    others += [run_key(["G1", "G2"], FilterParams(**p)) for p in (
        {"maf": 0.1}, {"dpc_l": 0.1}, {"dpc_u": 0.9}, {"aaf": 0.1}, {"known_variants": ("HGMD",)},
        {"clinvar_significance": ("Pathogenic",)}, {"profile": "old"})]
    assert len({base, *others}) == len(others) + 1


def test_only_new_releases_are_read(spark, tmp_path):
    """The second update opens the new study alone and leaves the first result; a study without rows has a result
    too; a newer release replaces the older one's rows."""
    tables = G.tables(spark)
    genotypes = {A: tables.occurrences, B: tables.occurrences.where("false")}
    opened = []

    def read(source):
        opened.append(source)
        return genotypes[source]

    def update(out, sources, **more):
        return update_results(spark, replace(tables, occurrences=None), G.GENES, sources, str(tmp_path / out), read=read, **more)

    rows = lambda u: Counter(map(repr, merged_results(spark, u).collect()))
    first = update("ledger", [A])
    assert opened == [A] and first.ran == (A,)
    second = update("ledger", [A, B])
    assert opened == [A, B] and second.ran == (B,) and second.results[A] == first.results[A]
    assert rows(second) == rows(first) and sum(rows(first).values()) > 0
    again = update("ledger", [B, A])
    assert opened == [A, B] and again.ran == ()
    newer = replace(A, release="02")
    genotypes[newer] = tables.occurrences.limit(0).unionByName(tables.occurrences.where(F.col("chromosome") == "1"))
    third = update("ledger", [newer, B])
    assert opened[2:] == [newer] and set(rows(third)) < set(rows(first))
    assert ResultLedger(spark, str(tmp_path / "ledger")).entries().count() == 3
    with pytest.raises(ValueError, match="SD_X"):
        update("ledger", [A, newer])
