"""Scalar semantics checked with ANSI mode on and off."""

import math

import pytest
from pyspark.sql import functions as F

from varsift.functions import expressions as X


def values(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("out")).collect()]


def test_damage_ratio(spark, ansi):
    rows = [("3_5",), ("0_5",), ("0_0",), (".",), ("a_b",), (None,), ("3_0.5",), ("3_-0.5",), ("3_1.5",),
            ("3_-1",), ("3_",), ("_5",), ("1_2_9",), ("4_4",), ("3_1e-1",), ("3_0e0",), ("3_.",), ("3_-.5",)]
    got = values(spark, rows, "d string", X.damage_ratio("d"))
    assert got == [pytest.approx(0.6), 0.0, None, None, None, None, None, None, pytest.approx(2.0), -3.0, None,
                   None, 0.5, 1.0, pytest.approx(30.0), None, None, None]


def test_max_population_af(spark, ansi):
    schema = "a struct<x:struct<af:double>,y:struct<af:double>>"
    rows = [(((0.1,), (0.3,)),), (((None,), (None,)),), ((None, (0.2,)),), ((None, None),), (((float("nan"),), (0.1,)),)]
    got = values(spark, rows, schema, X.max_population_af(["x", "y"], "a"))
    assert got[:4] == [0.3, 0.0, 0.2, 0.0]
    assert math.isnan(got[4])


def test_overlaps_any_never_null(spark, ansi):
    rows = [(["SD_A", "SD_B"],), (["SD_C"],), (None,), ([],), ([None, "SD_A"],)]
    got = values(spark, rows, "s array<string>", X.overlaps_any("s", ["SD_A"]))
    assert got == [True, False, False, False, True]


def test_first_gene(spark, ansi):
    rows = [("BRCA1:672|NBR2:10230",), ("TP53:7157",), ("ABC",), ("",), (None,), ("|X:1",)]
    assert values(spark, rows, "g string", X.first_gene("g")) == ["BRCA1", "TP53", "ABC", "", None, ""]


def test_significance_exact_elements(spark, ansi):
    rows = [(["Pathogenic"],), (["Likely_pathogenic", "Benign"],), (["Pathogenic/Likely_pathogenic"],),
            (["pathogenic"],), ([],)]
    assert values(spark, rows, "c array<string>", X.has_significance("c")) == [True, True, False, False, False]


def test_disease_causing_class(spark, ansi):
    rows = [("DM",), ("DM?",), ("DFP",), ("dm",), (None,)]
    assert values(spark, rows, "v string", X.is_disease_causing_class("v")) == [True, True, False, False, None]


def test_allele_fraction(spark, ansi):
    rows = [([8, 2],), ([0, 0],), ([3],), (None,), ([None, 2],), ([1, 1, 5],), ([2147483647, 1],)]
    assert values(spark, rows, "ad array<int>", X.allele_fraction("ad")) == [0.2, None, None, None, None, 0.5, None]


def test_adjusted_calls_and_called(spark, ansi):
    schema = "vaf double, calls array<int>"
    rows = [(0.2, [0, 1]), (0.19, [0, 1]), (None, [1, 1]), (0.5, [0, 0]), (0.5, [-1, -1]), (0.5, [0, None]),
            (0.5, [0]), (0.5, None)]
    adj = X.adjusted_calls("vaf", "calls", 0.2)
    got = values(spark, rows, schema, adj)
    assert got == [[0, 1], [0, 0], [1, 1], [0, 0], [-1, -1], [0, None], [0], None]
    called = values(spark, rows, schema, X.is_called(adj))
    assert called == [True, False, True, False, True, True, True, None]


def test_rare_damaging_boundaries(spark, ansi):
    schema = "m double, r double"
    rows = [(0.00009, 0.5), (0.0001, 0.5), (0.00009, 1.0), (0.00009, 0.49), (0.00009, 1.01), (0.00009, None),
            (float("nan"), None)]
    got = values(spark, rows, schema, X.rare_damaging_flag("m", "r", 0.0001, 0.5, 1.0))
    assert got == [1, 0, 1, 0, 0, 1, 0]


def test_known_override(spark, ansi):
    rows = [(0, "X"), (0, None), (1, None)]
    assert values(spark, rows, "f int, i string", X.known_override("f", "i")) == [1, 0, 1]


def test_normalise_participant(spark, ansi):
    rows = [("pt-ab-1",), ("PT_2",), (None,)]
    assert values(spark, rows, "p string", X.normalise_participant("p")) == ["PT_AB_1", "PT_2", None]


def test_chromosome_sort_key_order(spark, ansi):
    chroms = ["1", "9", "10", "22", "X", "Y", "x", "MT", "M", "chr1", None]
    df = spark.createDataFrame([(c,) for c in chroms], "c string")
    keys = [r[0] for r in df.select(X.chromosome_sort_key("c")).collect()]
    assert keys == ["01", "09", "10", "22", "2X", "2Y", "2x", "MT", "0M", "ch", None]
    ordered = [r[0] for r in df.orderBy(F.asc(X.chromosome_sort_key("c"))).collect()]
    assert ordered[:4] == [None, "1", "9", "M"]
    assert ordered[4:] == ["10", "22", "X", "Y", "x", "MT", "chr1"]


def test_chromosome_level_and_rank(spark, ansi):
    rows = [("1",), ("22",), ("X",), ("Y",), ("MT",), ("x",), (None,)]
    assert values(spark, rows, "c string", X.chromosome_level("c")) == ["1", "22", "X", "Y", None, None, None]
    assert values(spark, rows, "c string", X.chromosome_rank("c")) == [1, 22, 23, 24, None, None, None]


def test_clean_gene_line(spark, ansi):
    rows = [("BRCA1\u00a0",), ("\u00a0TP53\n",), (" KRAS ",), ("",), ("A\rB",)]
    assert values(spark, rows, "v string", X.clean_gene_line("v")) == ["BRCA1", "TP53", " KRAS ", "", "A\rB"]


def test_study_id_from_path(spark, ansi):
    rows = [("s3a://b/occurrences_sd_abc_re_04/x",), ("/occurrences_sd_z",), ("occurrences_sd_a_re_1_re_2",)]
    assert values(spark, rows, "p string", X.study_id_from_path("p")) == ["SD_ABC", None, "SD_A"]


def test_flag_predicates_by_type(spark, ansi):
    from varsift.operators.predicates import equals_bool_text, equals_one

    df = spark.createDataFrame([(False, "false", 1, True, "1"), (True, "False", 0, False, "x"),
                                (None, None, None, None, None)],
                               "b boolean, s string, i int, bo boolean, t string")
    got = df.select(equals_bool_text(df, "b", False), equals_bool_text(df, "s", False), equals_one(df, "i"),
                    equals_one(df, "bo"), equals_one(df, "t")).collect()
    assert [tuple(r) for r in got] == [(True, True, True, True, True), (False, False, False, False, False),
                                       (None, None, None, None, None)]
    texts = spark.createDataFrame([(" 1",), ("1.0",), ("+01",), ("1e0",), ("-1",), ("11",), ("true",)], "t string")
    assert [r[0] for r in texts.select(equals_one(texts, "t")).collect()] == [True, True, True, False, False,
                                                                               False, False]
