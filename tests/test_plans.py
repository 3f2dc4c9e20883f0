"""Physical-plan checks: pushdown, pruning, broadcast vs shuffle fallbacks."""

import contextlib
import re

import pytest

from conftest import SF001
from varsift.operators.sizing import METHOD_LIMIT, compiled_methods
from varsift.params import FilterParams
from varsift.plans.fixtures import FLAGSHIP_GENES, FLAGSHIP_STUDIES, mapped_tables
from varsift.plans.gene_filter import VariantTables, plan_gene_filter


def explain(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def vt(spark):
    t = mapped_tables(spark, SF001)
    return VariantTables(t.consequences, t.variants, t.dbnsfp, t.occurrences, t.diagnoses, t.phenotypes, t.clinvar,
                         t.hgmd, t.studies)


def test_gene_filter_pushed_to_scan(vt):
    plan = plan_gene_filter(vt, FLAGSHIP_GENES, FLAGSHIP_STUDIES)
    text = explain(plan.gene_consequences)
    assert "In(p_brand, [Brand#1,Brand#2,Brand#3])" in text
    plan.release()


def test_genotype_scan_pruned_and_filtered(vt):
    plan = plan_gene_filter(vt, FLAGSHIP_GENES, FLAGSHIP_STUDIES)
    text = explain(plan.result)
    scan = text[text.index("lineitem.parquet"):]
    read_schema = scan[scan.index("ReadSchema"):].split("\n")[0]
    assert "l_shipdate" not in read_schema and "l_extendedprice" not in read_schema
    assert "Not(EqualTo(l_linenumber,2))" in scan.split("ReadSchema")[0]
    plan.release()


def test_small_flagged_set_is_broadcast_into_genotype_join(vt):
    plan = plan_gene_filter(vt, FLAGSHIP_GENES, FLAGSHIP_STUDIES)
    tree = explain(plan.carriers).split("\n\n")[0]
    top = tree.split("InMemoryTableScan")[1]  # J7 as it filled the carriers' cache, above the cached flagged rows
    assert "BroadcastHashJoin Inner BuildLeft" in top
    assert "SortMergeJoin" not in top
    assert re.search(r"(?<!Broadcast)Exchange", top) is None  # no shuffle of the genotype rows
    plan.release()


def test_large_sets_fall_back_to_shuffle(spark, vt):
    params = FilterParams(broadcast_max_keys=0, broadcast_max_rows=0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # else Spark broadcasts cached sides that it sees are small
    try:
        plan = plan_gene_filter(vt, FLAGSHIP_GENES, FLAGSHIP_STUDIES, params)
        text = explain(plan.carriers)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text or "ShuffledHashJoin" in text
    assert plan.result.count() == 36
    plan.release()


def test_measurements_then_one_final_job(spark, vt):
    plan = plan_gene_filter(vt, FLAGSHIP_GENES, FLAGSHIP_STUDIES)
    # FIXTURES.md: consequences / flagged / carriers / their participants at sf0.001
    assert [m.rows for m in plan.measured] == [18, 8, 36, 10]
    assert all(m.df.is_cached for m in plan.measured)
    plan.release()
    assert not any(m.df.is_cached for m in plan.measured)


def test_stored_flags_pushed_to_parquet(spark, tmp_path):
    import golden as G
    from varsift.operators.occurrences import credible_carriers

    G.tables(spark).occurrences.write.parquet(str(tmp_path / "occ"))
    occ = spark.read.parquet(str(tmp_path / "occ"))
    text = explain(credible_carriers(occ, 0.2))
    pushed = text[text.index("PushedFilters"):].split("\n")[0]
    assert ("EqualTo(is_multi_allelic,false)" in pushed or "Not(EqualTo(is_multi_allelic,true))" in pushed)
    assert "IsNotNull(is_multi_allelic)" in pushed and "EqualTo(has_alt,1)" in pushed
    read_schema = text[text.index("ReadSchema"):].split("\n")[0]
    assert "ad:" in read_schema and "calls:" in read_schema


def test_region_cut_when_keys_do_not_fit(spark):
    import golden as G

    tables = G.tables(spark)
    base = plan_gene_filter(tables, G.GENES, [G.STUDY], FilterParams())
    want = sorted(tuple(str(v) for v in r) for r in base.result.collect())
    base.release()
    # 11 gene consequences > 5 keys, 6 flagged rows > 0 rows, 4 regions <= 5: region semi-join path.
    params = FilterParams(broadcast_max_keys=5, broadcast_max_rows=0)
    plan = plan_gene_filter(tables, G.GENES, [G.STUDY], params)
    # consequences, flagged, gene regions (8 > 5: annotation tables not cut), flagged regions (4 <= 5),
    # words of the key filter (6 flagged rows), carriers, participants
    rows = [m.rows for m in plan.measured]
    assert rows[:4] + rows[5:] == [11, 6, 8, 4, 6, 5] and 0 < rows[4] <= 6
    text = explain(plan.carriers)
    assert "LeftSemi" in text and "__region" in text  # genotype rows cut to flagged regions
    got = sorted(tuple(str(v) for v in r) for r in plan.result.collect())
    assert got == want
    plan.release()


def test_nested_frequency_fields_pruned(spark, tmp_path):
    from varsift.operators.annotations import variant_frequencies

    af = "struct<af:double, ac:int, hom:int>"
    schema = (f"chromosome string, start long, reference string, alternate string, "
              f"external_frequencies struct<topmed_bravo:{af}, gnomad_genomes_2_1_1:{af}, "
              f"gnomad_exomes_2_1_1:{af}, gnomad_genomes_3:{af}, other_db:{af}>, "
              "studies array<struct<study_id:string, study_code:string, n:int>>, annotation string")
    row = ("1", 5, "A", "G", ((0.1, 1, 0), (0.2, 2, 0), None, (0.3, 3, 1), (0.9, 9, 9)),
           [("SD_A", "A", 1)], "x" * 50)
    spark.createDataFrame([row], schema).write.parquet(str(tmp_path / "v"))
    df = variant_frequencies(spark.read.parquet(str(tmp_path / "v")), ["SD_A"])
    text = explain(df)
    read_schema = text[text.index("ReadSchema"):].split("\n")[0]
    assert "af:double" in read_schema and "study_id:string" in read_schema
    for pruned in ("ac:", "hom:", "other_db", "study_code", "annotation"):
        assert pruned not in read_schema, (pruned, read_schema)
    assert df.first()["max_gnomad_topmed"] == 0.3


def test_consequence_and_hgmd_predicates_pushed(spark, tmp_path):
    import golden as G
    from varsift.operators.annotations import GeneSet, canonical_consequences, hgmd_candidates

    t = G.tables(spark)
    t.consequences.write.parquet(str(tmp_path / "c"))
    t.hgmd.write.parquet(str(tmp_path / "h"))
    genes = GeneSet(G.GENES)
    text = explain(canonical_consequences(spark.read.parquet(str(tmp_path / "c")), genes, [G.STUDY]))
    pushed = text[text.index("PushedFilters"):].split("\n")[0]
    assert "EqualTo(original_canonical,true)" in pushed and "In(symbol, [GENE1,GENE2])" in pushed
    text = explain(hgmd_candidates(spark.read.parquet(str(tmp_path / "h")), genes))
    pushed = text[text.index("PushedFilters"):].split("\n")[0]
    assert "StringStartsWith(variant_class,DM)" in pushed and "In(symbol, [GENE1,GENE2])" in pushed


@contextlib.contextmanager
def skew_settings(spark):
    """No broadcasts and tiny skew thresholds, so AQE's skew handling shows on small data."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_variant_key_is_split_by_aqe(spark):
    """One variant key holding most genotype rows: the shuffle join is marked skewed and split."""
    import golden as G
    from dataclasses import replace

    from pyspark.sql import functions as F

    tables = G.tables(spark)
    hot = tables.occurrences.where("biospecimen_id = 's1'")
    many = (hot.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20000))))
            .withColumn("biospecimen_id", F.concat(F.col("biospecimen_id"), F.lit("_"), F.col("copy").cast("string")))
            .drop("copy"))
    skewed = replace(tables, occurrences=tables.occurrences.unionByName(many))
    with skew_settings(spark):
        plan = plan_gene_filter(skewed, G.GENES, [G.STUDY],
                                FilterParams(broadcast_max_keys=0, broadcast_max_rows=0))
        joined = plan.carriers
        assert len(joined.collect()) == len(G.EXPECTED) + 20000
        text = explain(joined)  # after execution: the final adaptive plan
        assert "SortMergeJoin(skew=true)" in text  # the hot key's genotype rows are split over tasks
        plan.release()


def test_hot_participant_is_split_by_aqe(spark):
    """One participant holding most result rows: the clinical-list join is marked skewed and split."""
    import golden as G
    from pyspark.sql import functions as F

    from varsift.operators import clinical as C

    t = G.tables(spark)
    rows = (spark.range(20000).select(F.lit("PT_1").alias("participant_id"), F.col("id").alias("n"))
            .unionByName(spark.createDataFrame([("PT_3", -1)], "participant_id string, n long")))
    with skew_settings(spark):
        lists = C.clinical_lists(t.diagnoses, t.phenotypes, None)
        out = C.join_lists(rows, lists)
        got = out.collect()
        assert len(got) == 20001
        assert next(r for r in got if r.participant_id == "PT_3").diagnoses_combined == ["c"]
        assert "SortMergeJoin(skew=true)" in explain(out)


def test_gene_regions_cut_annotation_tables_when_keys_do_not_fit(spark):
    import golden as G

    tables = G.tables(spark)
    base = plan_gene_filter(tables, G.GENES, [G.STUDY], FilterParams())
    want = sorted(tuple(str(v) for v in r) for r in base.result.collect())
    base.release()
    # 11 gene consequences > 10 keys, 8 gene regions <= 10: region semi-joins on the annotation tables.
    plan = plan_gene_filter(tables, G.GENES, [G.STUDY], FilterParams(broadcast_max_keys=10))
    assert [m.rows for m in plan.measured][:3] == [11, 6, 8]
    assert "__region" in explain(plan.study_variants)
    assert sorted(tuple(str(v) for v in r) for r in plan.result.collect()) == want
    plan.release()


def test_chromosome_partitions_pruned(spark, tmp_path):
    """A chromosome-partitioned genotype table is read only for the genes' chromosomes."""
    import golden as G
    from dataclasses import replace

    tables = G.tables(spark)
    tables.occurrences.write.partitionBy("chromosome").parquet(str(tmp_path / "occ"))
    occ = spark.read.parquet(str(tmp_path / "occ"))
    plan = plan_gene_filter(replace(tables, occurrences=occ), G.GENES, [G.STUDY], FilterParams())
    assert len(plan.carriers.collect()) == len(G.EXPECTED)
    text = explain(plan.carriers)
    part_filters = [ln for ln in text.splitlines() if ln.startswith("PartitionFilters") and "chromosome" in ln]
    assert part_filters and all(" IN (" in ln for ln in part_filters)  # e.g. chromosome IN (1,2,3,5,6,7,8,X)
    plan.release()


def test_few_but_wide_rows_are_not_broadcast(vt):
    """The bound on bytes, not only the one on rows, decides on a broadcast."""
    wide = plan_gene_filter(vt, FLAGSHIP_GENES, FLAGSHIP_STUDIES, FilterParams(broadcast_max_bytes=16))
    flagged = next(m for m in wide.measured if m.rows == 8)
    assert flagged.size > 16 and not flagged.fits()
    assert wide.result.count() == 36
    wide.release()
    base = plan_gene_filter(vt, FLAGSHIP_GENES, FLAGSHIP_STUDIES)
    assert all(m.fits() for m in base.measured)
    base.release()


def test_many_chromosomes_are_a_semi_join(vt):
    """Beyond the literal list the chromosome filter stays, as a semi-join."""
    few = plan_gene_filter(vt, FLAGSHIP_GENES, FLAGSHIP_STUDIES, FilterParams(max_literal_chromosomes=1))
    assert few.result.count() == 36
    few.release()


def test_checkpoint_folder_is_required_on_a_cluster():
    from unittest import mock

    from varsift.session import ensure_checkpoint_dir

    session = mock.Mock()
    session.conf.get.return_value = None
    session.sparkContext.getCheckpointDir.return_value = None
    session.sparkContext.master = "yarn"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)


def test_genotype_stage_is_not_one_method_too_large_to_be_compiled(spark, vt):
    """Filter, wide projection and join in one generated method of over 8,000 bytes are interpreted row by row."""
    limit = spark.conf.get(METHOD_LIMIT)
    plan = plan_gene_filter(vt, FLAGSHIP_GENES, FLAGSHIP_STUDIES)
    assert spark.conf.get(METHOD_LIMIT) == limit
    names, todo = [], [plan.carriers._jdf.queryExecution().withCachedData().cacheBuilder().cachedColumnBuffers()]
    while todo:
        rdd = todo.pop()
        names += [rdd.scope().get().name()] if rdd.scope().isDefined() else []
        found = rdd.dependencies()
        todo += [found.apply(k).rdd() for k in range(found.size())]
    assert any(n.startswith("Scan parquet") for n in names)
    assert {"Filter", "BroadcastHashJoin"} <= {n.strip() for n in names}, names
    plan.release()


def test_method_limit_is_set_back_and_never_raised(spark):
    before = spark.conf.get(METHOD_LIMIT)
    try:
        for own, inside in (("65535", "8000"), ("3000", "3000")):
            spark.conf.set(METHOD_LIMIT, own)
            with pytest.raises(KeyError), compiled_methods(spark):
                assert spark.conf.get(METHOD_LIMIT) == inside
                raise KeyError
            assert spark.conf.get(METHOD_LIMIT) == own
    finally:
        spark.conf.set(METHOD_LIMIT, before)
