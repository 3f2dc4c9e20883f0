"""The Bloom filter of join keys: no wanted row is lost, few others pass, and the genotype scan uses it."""

import golden as G
import pytest
from pyspark.sql import functions as F

from varsift.operators.annotations import KEY
from varsift.operators.keyfilter import keep_keys, key_filter, passing_share
from varsift.params import FilterParams
from varsift.plans.gene_filter import plan_gene_filter


def _keys(spark, low, high):
    return spark.range(low, high).select((F.col("id") % 24).cast("string").alias("chromosome"), F.col("id").alias("start"),
                                         F.lit("A").alias("reference"), F.lit("C").alias("alternate"))


@pytest.mark.parametrize("words, most", [(1 << 14, 0.02), (1 << 11, 0.4), (1 << 6, 1.0)])
def test_share_of_other_keys_that_pass(spark, words, most):
    """40 000 keys in filters of 1 M, 131 k and 4 k bits: all wanted keys pass, others about as often as measured."""
    wanted, others = _keys(spark, 0, 40_000), _keys(spark, 40_000, 140_000)
    used = key_filter(wanted, KEY, words)
    assert used.count() <= words
    share = passing_share(used, words)
    assert keep_keys(wanted, used, KEY, words).count() == 40_000
    passed = keep_keys(others, used, KEY, words).count() / 100_000
    assert passed == pytest.approx(share, rel=0.15, abs=0.002) and (share <= most or words < 1 << 14)


def test_rows_stay_as_they_are(spark):
    rows = _keys(spark, 0, 10).unionByName(_keys(spark, 0, 3)).withColumn("a b", F.col("start") * 2)
    nulls = rows.withColumn("alternate", F.lit(None).cast("string"))
    used = key_filter(_keys(spark, 0, 3), KEY, 1 << 16)
    kept = keep_keys(rows, used, KEY, 1 << 16)
    assert kept.columns == rows.columns
    assert sorted(r.start for r in kept.collect()) == [0, 0, 1, 1, 2, 2]
    assert keep_keys(nulls, used, KEY, 1 << 16).count() <= 13
    assert keep_keys(rows, key_filter(rows.where("false"), KEY, 64), KEY, 64).count() == 0


def test_too_many_flagged_keys_cut_the_genotype_scan(spark, tmp_path):
    """Beyond the broadcast bounds the filter is a broadcast join right above the genotype scan, before the exchange."""
    from dataclasses import replace

    tables = G.tables(spark)
    tables.occurrences.write.parquet(str(tmp_path / "occ"))
    tables = replace(tables, occurrences=spark.read.parquet(str(tmp_path / "occ")))
    want = plan_gene_filter(tables, G.GENES, [G.STUDY])
    rows = lambda p: sorted(tuple(str(v) for v in r) for r in p.result.collect())
    params = dict(broadcast_max_keys=0, broadcast_max_rows=0)
    got = plan_gene_filter(tables, G.GENES, [G.STUDY], FilterParams(**params))
    text = got.carriers._jdf.queryExecution().optimizedPlan().toString()
    assert "__word" in text or "__word" in got.carriers._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == rows(want)
    saturated = plan_gene_filter(tables, G.GENES, [G.STUDY], FilterParams(**params, key_filter_words=1, key_filter_max_share=0.0))
    off = plan_gene_filter(tables, G.GENES, [G.STUDY], FilterParams(**params, key_filter_words=0))
    assert rows(saturated) == rows(off) == rows(want)
    for p in (want, got, saturated, off):
        p.release()


def test_clustered_genotypes_are_joined_without_an_exchange(spark, tmp_path):
    from dataclasses import replace

    from varsift.operators.occurrences import credible_carriers, join_carriers
    from varsift.sources.sinks import write_clustered

    tables = G.tables(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        occ = write_clustered(tables.occurrences, "clustered_calls", KEY, 5, str(tmp_path / "clustered"))
        plan = plan_gene_filter(replace(tables, occurrences=occ), G.GENES, [G.STUDY],
                                FilterParams(broadcast_max_keys=0, broadcast_max_rows=0))
        want = plan_gene_filter(tables, G.GENES, [G.STUDY])
        assert sorted(map(repr, plan.result.collect())) == sorted(map(repr, want.result.collect()))
        plan.flagged.write.parquet(str(tmp_path / "flagged"))
        flagged = spark.read.parquet(str(tmp_path / "flagged"))  # without the plans of its caches
        text = join_carriers(flagged, credible_carriers(occ, 0.2))._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Bucketed: true" in text and "SelectedBucketsCount: 5 out of 5" in text
        assert text.count("Exchange hashpartitioning") == 1  # the flagged side alone
        plan.release()
        want.release()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS clustered_calls")
