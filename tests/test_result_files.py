"""Guessed types, array and struct cells, and single files joined from parts."""

import gzip
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varsift.sources import inference as I
from varsift.sources import readers as RD
from varsift.sources import sinks as SK


def _cells(spark, values):
    return spark.createDataFrame([(v,) for v in values], "cell string")


@pytest.mark.parametrize("values, want", [
    (["1", "-7", "0", None, ""], "bigint"),
    (["9223372036854775807"], "bigint"),
    (["9223372036854775808", "1"], "decimal(38,0)"),
    (["1" * 38], "decimal(38,0)"),
    (["1" * 39], "double"),
    (["1", "2.5"], "double"),
    (["9223372036854775808", "1e3"], "double"),
    (["true", "false", None], "boolean"),
    (["true", "1"], "string"),
    (["True"], "string"),
    (["007"], "string"),
    (["+5"], "string"),
    (["1", "x"], "string"),
    ([None, ""], "string"),
    ([], "string"),
    (["[1,2]", "[]", None], "array<bigint>"),
    (["[1,2.5]"], "array<double>"),
    (["[]"], "array<string>"),
    (["[1]", '["a"]'], "array<string>"),
    (["[1]", "1"], "string"),
    (["[1"], "string"),
    (['{"a":1}', '{"b":[true]}'], "struct<a:bigint,b:array<boolean>>"),
    (['{"a":1}', "[1]"], "string"),
    (["{}"], "string"),
    (['[{"a b":1}]', '[{"a b":null,"c":"x"}]'], "array<struct<a b:bigint,c:string>>"),
    (["2024-01-02"], "string"),
    ([" 1"], "string"),
])
def test_guessed_types(spark, ansi, values, want):
    merged, _ = I.guess_types(_cells(spark, values), ["cell"])
    assert merged["cell"].simpleString() == want


def test_levels_merge_in_any_order_and_split(spark):
    """The type of a column does not depend on how its cells are dealt over tasks and runs."""
    rng = random.Random(3)
    stock = ["1", "2.5", "true", "x", "[1]", '["a"]', "9" * 20, None, ""]
    for _ in range(4):
        values = rng.choices(stock, k=rng.randint(1, 5))
        kinds = set()
        for parts in (1, 3):
            merged, _ = I.guess_types(_cells(spark, rng.sample(values, len(values))).repartition(parts), ["cell"])
            kinds.add(merged["cell"].simpleString())
        assert len(kinds) == 1, values


def test_typed_results_widen_over_runs(spark, tmp_path):
    a = spark.createDataFrame([("1", 5, "p"), ("X", 6, None)], "chromosome string, extra long, note string")
    b = spark.createDataFrame([("2", 0.5, True)], "chromosome string, extra double, seen boolean")
    paths = [str(tmp_path / "a.tsv.gz"), str(tmp_path / "b c.tsv.gz")]
    SK.write_tsv(a, paths[0])
    SK.write_tsv(b, paths[1], single_file=True)
    merged, runs = RD.guess_result_types(spark, paths)
    assert {c: k.simpleString() for c, k in merged.items()} == {"chromosome": "string", "extra": "double", "note": "string", "seen": "boolean"}
    assert runs[paths[0]]["extra"] == T.LongType() and runs[paths[1]]["chromosome"] == T.LongType()
    back = RD.read_typed_results(spark, paths)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(
        [("1", 5.0, "p", None), ("X", 6.0, None, None), ("2", 0.5, None, True)], key=repr)


def test_one_pass_over_all_files(spark, tmp_path):
    """The guess is one aggregate: one scan of a run's files, partial before the exchange."""
    path = str(tmp_path / "a")
    SK.write_tsv(spark.range(10).select("id", (F.col("id") * 2).alias("b")), path)
    cells = spark.read.option("sep", "\t").option("header", True).csv(path)
    numbered = cells.rollup(F.col("id")).agg(F.bit_or(I.cell_level(F.col("b"))), F.schema_of_variant_agg(I._json(F.col("b"))))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "partial_bit_or" in plan and "partial_schema_of_variant" in plan


def test_array_cells_come_back_and_unreadable_ones_fail(spark, tmp_path):
    df = spark.createDataFrame([([8, None], ["a\tb", 'say "x"'], None, [(1, "é")]), ([], None, [["q"], []], None)],
                               "ad array<int>, clin_sig array<string>, lists array<array<string>>, notes array<struct<n:long,t:string>>")
    path = str(tmp_path / "cells")
    SK.write_tsv(df, path)
    back = RD.read_typed_results(spark, [path])
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    as_text = RD.read_result(spark, path, RD.ResultReadOptions(nested=False))
    assert {r.ad for r in as_text.collect()} == {"[8,null]", "[]"}
    for cell in ("[1", '[1,"x"]', "5"):
        bad = str(tmp_path / f"bad{len(cell)}")
        SK.write_tsv(spark.createDataFrame([(cell,)], "ad string"), bad)
        with pytest.raises(Exception, match="unreadable value|MALFORMED_RECORD|CANNOT_PARSE"):
            RD.read_result(spark, bad).collect()


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_single_file_is_joined_from_many_ordered_parts(spark, tmp_path, monkeypatch, compression):
    joined = []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(SK, "join_files", lambda s, p, parts, own=SK.join_files: (joined.append(list(parts)), own(s, p, parts)))
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("start"), F.concat(F.lit("row "), F.col("id").cast("string")).alias("text"))
    path = str(tmp_path / ("all.tsv.gz" if compression == "gzip" else "all.tsv"))
    for _ in range(2):  # the second run replaces the first one's file
        SK.write_tsv(df.repartition(3), path, compression, single_file=True, order=[F.col("start")])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(joined[0]) > 2  # the header and more than one writing task
    with (gzip.open if compression == "gzip" else open)(path, "rt") as f:
        lines = f.read().splitlines()
    assert lines[0] == "start\ttext" and len(lines) == 5001
    assert [int(line.split("\t")[0]) for line in lines[1:]] == list(range(5000))
    assert RD.read_result(spark, path).count() == 5000
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == [path.rsplit("/", 1)[1]]
    with pytest.raises(FileExistsError):
        SK.write_tsv(df, path, compression, single_file=True, mode="error")


def test_single_file_of_nothing_has_a_header(spark, tmp_path):
    path = str(tmp_path / "none.tsv")
    SK.write_tsv(spark.createDataFrame([], "a string, `b c` string"), path, "none", single_file=True)
    assert re.fullmatch("a\tb c\n", open(path).read())


def test_a_file_system_that_cannot_join_is_an_error(spark, tmp_path):
    class Plain:
        def rename(self, a, b):
            return True

        def getClass(self):
            return self

        def getSimpleName(self):
            return "ObjectStore"

        def concat(self, target, parts):
            spark._jvm.java.lang.Integer.parseInt("not supported")

    own = SK._file_system
    try:
        SK._file_system = lambda s, p: (Plain(), own(s, p)[1])
        with pytest.raises(OSError, match="cannot join"):
            SK.join_files(spark, str(tmp_path / "x"), [str(tmp_path / "a"), str(tmp_path / "b")])
    finally:
        SK._file_system = own


def test_cells_are_parsed_once_and_only_where_they_may_be_json(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, 0.5, "a", [1, 2]), (2, None, "[", [3])], "start long, level double, note string, ad array<int>")
    path = str(tmp_path / "cells")
    SK.write_tsv(df, path)
    plan = RD.read_result(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    asked = []
    monkeypatch.setattr(I, "_json_schemas", lambda c, columns, numbers, *rest, own=I._json_schemas: (
        asked.extend(columns[k] for k in numbers), own(c, columns, numbers, *rest))[1])
    assert I.guess_types(_cells(spark, ["1", "2.5"]), ["cell"])[0]["cell"] == T.DoubleType() and not asked
    assert I.guess_types(_cells(spark, ["[1]", "x"]), ["cell"])[0]["cell"] == T.StringType() and not asked
    assert I.guess_types(_cells(spark, ["[1]", "["]), ["cell"])[0]["cell"] == T.StringType() and asked == ["cell"]


def test_buckets_grow_with_the_table(spark):
    assert [SK.bucket_count(spark.range(n), 10) for n in (0, 80, 81, 1000)] == [8, 8, 16, 128]
