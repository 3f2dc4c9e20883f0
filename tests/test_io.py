"""Readers and writers: gene list, study from path, result TSV round trip and the combine job."""

import datetime as dt
import gzip
import os

import pytest

import golden as G
from varsift.params import FilterParams
from varsift.plans.gene_filter import plan_gene_filter
from varsift.plans.jobs import combine_results, write_combined, write_result
from varsift.sources import readers as RD
from varsift.sources import sinks as SK


def test_gene_list_reader(spark, tmp_path):
    p = tmp_path / "genes.txt"
    p.write_bytes("BRCA1\u00a0\nTP53\r\n\n KRAS\n".encode())
    genes = RD.read_gene_list(spark, str(p))
    # Spark's line reader ends lines at \n, \r\n or \r (as the original reader does).
    assert [r.gene for r in genes.collect()] == ["BRCA1", "TP53", "", " KRAS"]
    assert RD.gene_values(genes) == ["BRCA1", "TP53", "", " KRAS"]
    assert RD.gene_values(genes, max_literal=2) is genes


def test_study_from_path():
    assert RD.study_from_path("s3a://x/occurrences_sd_abc123_re_04/") == "SD_ABC123"
    with pytest.raises(ValueError):
        RD.study_from_path("/data/occurrences_xyz")


def test_output_names():
    d = dt.date(2024, 9, 30)
    assert SK.output_name("base", ["SD_A", "SD_B"], d) == "2024-09-30_base_SD_A_SD_B.tsv.gz"
    assert SK.combined_name(d) == "MMC_all_families_variants_2024-09-30.tsv"


def _part_lines(path, gz=True):
    lines = []
    if os.path.isfile(path):
        with (gzip.open if gz else open)(path, "rt") as fh:
            return fh.read().splitlines()
    for name in sorted(os.listdir(path)):
        if name.startswith("part-"):
            opener = gzip.open if gz else open
            with opener(os.path.join(path, name), "rt") as fh:
                lines += fh.read().splitlines()
    return lines


def test_write_sorted_result_and_read_back(spark, tmp_path):
    tables = G.tables(spark)
    plan = plan_gene_filter(tables, G.GENES, [G.STUDY], FilterParams())
    path = write_result(plan.result, str(tmp_path), [G.STUDY], run_date=dt.date(2024, 1, 2))
    plan.release()
    assert path.endswith("2024-01-02_gene-based-variant-filtering_SD_X.tsv.gz")
    lines = _part_lines(path)
    header = lines[0].split("\t")
    assert header[:3] == ["study_id", "participant_id", "chromosome"]
    body = [ln.split("\t") for ln in lines[1:] if not ln.startswith("study_id\t")]
    assert len(body) == len(G.EXPECTED)
    chrom = [r[2] for r in body]
    assert chrom == ["1", "1", "2", "6", "X", "X"]  # 01 < 02 < 06 < 2X
    s5 = next(r for r in body if "s5" in r)
    assert s5[header.index("diagnoses_combined")] == "-"          # null
    assert s5[header.index("clin_sig")] == '"[""Pathogenic""]"'
    back = RD.read_result(spark, path)
    assert back.count() == len(G.EXPECTED)
    assert dict(back.dtypes)["start"] == "bigint"
    s5_back = back.where("biospecimen_id = 's5'").first()
    assert s5_back["diagnoses_combined"] is None
    assert s5_back["clin_sig"] == ["Pathogenic"]


def test_combine_round_trip(spark, tmp_path):
    tables = G.tables(spark)
    p_all = plan_gene_filter(tables, G.GENES, [G.STUDY], FilterParams())
    a = write_result(p_all.result, str(tmp_path / "a"), [G.STUDY])
    p_h = plan_gene_filter(tables, G.GENES, [G.STUDY], FilterParams(known_variants=("HGMD",)))
    b = write_result(p_h.result.drop("study_code"), str(tmp_path / "b"), [G.STUDY], tie_columns=("family_id", "is_proband"))
    with pytest.raises(ValueError, match="study_code"):
        write_result(p_h.result.drop("study_code"), str(tmp_path / "c"), [G.STUDY])
    merged = combine_results(spark, [a, b], tie_columns=("family_id", "is_proband"))
    rows = merged.collect()
    assert len(rows) == 2 * len(G.EXPECTED) - 1
    assert merged.columns.index("VariationID") < merged.columns.index("HGMDID")
    assert [r["chromosome"] for r in rows] == ["1", "1", "1", "2", "2", "6", "6", "X", "X", "X", "X"]
    assert sum(r["VariationID"] is None for r in rows) == len(G.EXPECTED) - 1 + (len(G.EXPECTED) - 1)
    ties = ("family_id", "is_proband")
    out = write_combined(merged, str(tmp_path / "m"), run_date=dt.date(2024, 9, 30), single_file=True)
    lines = _part_lines(out, gz=False)
    assert lines[0].startswith("study_id\tparticipant_id\tchromosome")
    assert len(lines) == 1 + len(rows)
    at = lines[0].split("\t").index("chromosome")
    assert [x.split("\t")[at] for x in lines[1:]] == [r["chromosome"] for r in rows]
    p_all.release()
    p_h.release()


def test_combine_nonstandard_chromosome_last(spark, tmp_path):
    df = spark.createDataFrame([("MT", 5, "F1", True), ("2", 9, "F1", True), ("1", 7, None, False),
                                ("1", 7, "F0", False)], "chromosome string, start long, family_id string, is_proband boolean")
    p = str(tmp_path / "r")
    SK.write_tsv(df, p)
    rows = combine_results(spark, [p], tie_columns=("family_id", "is_proband")).collect()
    assert [(r.chromosome, r.start, r.family_id) for r in rows] == [("1", 7, "F0"), ("1", 7, None), ("2", 9, "F1"),
                                                                   (None, 5, "F1")]


def test_combined_part_files_are_in_order(spark, tmp_path):
    """By default the merge is written as several part files, one after the other in global order."""
    df = spark.range(4000).selectExpr("cast(id % 22 + 1 as string) chromosome", "id * 7919 % 4000 AS start", "'F' family_id")
    p = str(tmp_path / "r")
    SK.write_tsv(df, p)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = write_combined(combine_results(spark, [p], tie_columns=("family_id",)), str(tmp_path / "m"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(f.startswith("part-") for f in os.listdir(out)) > 1
    rows = [(int(x.split("\t")[0]), int(x.split("\t")[1])) for x in _part_lines(out, gz=False) if not x.startswith("chromosome")]
    assert len(rows) == 4000 and rows == sorted(rows)


def test_result_reader_keeps_values_and_rows(spark, tmp_path):
    """A file as another program writes it: whole numbers as 30.0 and 1e3, quoted line breaks, empty cells."""
    p = tmp_path / "run.tsv"
    p.write_text('chromosome\tstart\tdp\tphen\tgnomad_af\n1\t1e3\t30.0\t"two\nlines"\t0.5\n2\t7\t-\t\t-\nX\t8.0\t\t"a ""b"""\t\n')
    rows = [tuple(r) for r in RD.read_result(spark, str(p)).collect()]
    assert rows == [("1", 1000, 30, "two\nlines", 0.5), ("2", 7, None, "", None), ("X", 8, None, 'a "b"', None)]
    p.write_text("chromosome\tdp\n1\t30.5\n")
    with pytest.raises(Exception, match="unreadable value in column dp: 30.5"):
        RD.read_result(spark, str(p)).collect()


def test_combine_missing_sort_column(spark, tmp_path):
    df = spark.createDataFrame([("1", 5)], "chromosome string, start long")
    p = str(tmp_path / "r")
    SK.write_tsv(df, p)
    with pytest.raises(ValueError, match="study_short_name"):
        combine_results(spark, [p], tie_columns=("study_short_name",))


def test_expand_result_paths(spark, tmp_path):
    df = spark.createDataFrame([("1", 5)], "chromosome string, start long")
    SK.write_tsv(df, str(tmp_path / "r" / "2024-01-01_x_SD_A.tsv.gz"))
    SK.write_tsv(df, str(tmp_path / "r" / "2024-01-02_x_SD_B.tsv.gz"))
    SK.write_tsv(df, str(tmp_path / "r" / "other_dir"))
    runs = RD.expand_result_paths(spark, [str(tmp_path / "r" / "*.tsv.gz")])
    assert [r.rsplit("/", 1)[-1] for r in runs] == ["2024-01-01_x_SD_A.tsv.gz", "2024-01-02_x_SD_B.tsv.gz"]
    assert combine_results(spark, runs, tie_columns=()).count() == 2


def test_read_study_partitions(spark, tmp_path):
    df = spark.createDataFrame([("1", 5, "SD_A"), ("2", 6, "SD_B"), ("3", 7, "SD_A"), ("4", 8, "SD_C")],
                               "chromosome string, start long, study_id string")
    parent = tmp_path / "parent"
    df.where("study_id IN ('SD_A', 'SD_B')").write.partitionBy("study_id").parquet(str(parent / "occurrences_sd_a_re_1"))
    df.where("study_id IN ('SD_A', 'SD_C')").write.partitionBy("study_id").parquet(str(parent / "occurrences_sd_c_re_2"))
    got = RD.read_study_partitions(spark, str(parent), ["SD_A", "SD_B"])
    rows = sorted((r.chromosome, r.study_id) for r in got.collect())
    assert rows == [("1", "SD_A"), ("1", "SD_A"), ("2", "SD_B"), ("3", "SD_A"), ("3", "SD_A")]
    with pytest.raises(ValueError, match="SD_Z"):
        RD.read_study_partitions(spark, str(parent), ["SD_Z"])
    with pytest.raises(ValueError, match="SD_MISSING"):  # also when the others have partitions
        RD.read_study_partitions(spark, str(parent), ["SD_A", "SD_MISSING"])
