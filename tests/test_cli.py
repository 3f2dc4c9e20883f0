"""The spark-submit entry point end to end: Parquet tables + gene list file -> dated, sorted TSV; then combine."""

import datetime as dt
import gzip
import os

import golden as G
from varsift import cli


def test_filter_and_combine_commands(spark, tmp_path):
    tables = G.tables(spark)
    paths = {}
    for name in ("consequences", "variants", "dbnsfp", "clinvar", "hgmd", "diagnoses", "phenotypes", "studies"):
        paths[name] = str(tmp_path / "tables" / name)
        getattr(tables, name).write.parquet(paths[name])
    paths["occurrences"] = str(tmp_path / "tables" / "occurrences_sd_x_re_01")
    tables.occurrences.write.parquet(paths["occurrences"])
    genes = tmp_path / "genes.txt"
    genes.write_text("GENE1\u00a0\nGENE2\n")
    out = tmp_path / "out"
    argv = ["filter", "--gene-list", str(genes), "--out", str(out), "--single-file"]
    for name, p in paths.items():
        argv += [f"--{name}", p]
    assert cli.main(argv) == 0
    expected_name = f"{dt.date.today().isoformat()}_gene-based-variant-filtering_SD_X.tsv.gz"
    with gzip.open(out / expected_name, "rt") as fh:
        lines = fh.read().splitlines()
    assert len(lines) == 1 + len(G.EXPECTED)
    assert lines[0].split("\t")[-1] == "study_code"

    merged = tmp_path / "merged"
    assert cli.main(["combine", "--out", str(merged), str(out / "*.tsv.gz")]) == 0
    name = f"MMC_all_families_variants_{dt.date.today().isoformat()}.tsv"
    part = [p for p in os.listdir(merged / name) if p.startswith("part-")][0]
    merged_lines = (merged / name / part).read_text().splitlines()
    assert len(merged_lines) == 1 + len(G.EXPECTED)


def test_filter_database_name_case_and_explicit_study(spark, tmp_path):
    tables = G.tables(spark)
    argv = ["filter", "--gene-list", str(tmp_path / "genes.txt"), "--out", str(tmp_path / "out"),
            "--known-variants", "Clinvar", "--study", G.STUDY, "--single-file", "--output-basename", "run"]
    (tmp_path / "genes.txt").write_text("GENE1\nGENE2\n")
    for name in ("consequences", "variants", "dbnsfp", "clinvar", "occurrences", "diagnoses", "phenotypes",
                 "studies"):
        p = str(tmp_path / "t" / name)
        getattr(tables, name).write.parquet(p)
        argv += [f"--{name}", p]
    assert cli.main(argv) == 0
    out = tmp_path / "out" / f"{dt.date.today().isoformat()}_run_{G.STUDY}.tsv.gz"
    with gzip.open(out, "rt") as fh:
        lines = fh.read().splitlines()
    header = lines[0].split("\t")
    assert "VariationID" in header and "HGMDID" not in header
    assert len(lines) == 1 + len(G.EXPECTED) - 1  # the HGMD-only row is gone


def test_filter_old_layout(spark, tmp_path):
    import test_old_profile as OP

    old = OP.make_old_tables(spark)
    argv = ["filter", "--gene-list", str(tmp_path / "genes.txt"), "--out", str(tmp_path / "out"),
            "--profile", "old", "--study", G.STUDY, "--single-file"]
    (tmp_path / "genes.txt").write_text("GENE1\nGENE2\n")
    for name in ("consequences", "variants", "dbnsfp", "clinvar", "hgmd", "occurrences", "diagnoses", "phenotypes"):
        p = str(tmp_path / "t" / name)
        getattr(old, name).write.parquet(p)
        argv += [f"--{name}", p]
    assert cli.main(argv) == 0
    out = tmp_path / "out" / f"{dt.date.today().isoformat()}_gene-based-variant-filtering_{G.STUDY}.tsv.gz"
    with gzip.open(out, "rt") as fh:
        lines = fh.read().splitlines()
    assert lines[0].split("\t") == OP.OLD_COLUMNS
    assert len(lines) == 1 + len(G.EXPECTED)


def test_filter_reports_missing_tables(tmp_path):
    import pytest

    argv = ["filter", "--gene-list", str(tmp_path / "g.txt"), "--out", str(tmp_path / "o"),
            "--consequences", "c", "--variants", "v", "--dbnsfp", "d", "--occurrences", "occurrences_sd_x_re_1"]
    with pytest.raises(SystemExit, match="clinvar, diagnoses, hgmd, phenotypes, studies"):
        cli.main(argv)
