"""The annotation-only plan, its job count, and joins with heavy keys."""

from collections import Counter
from dataclasses import replace

import golden as G
import pytest
from pyspark.sql import functions as F

from varsift.operators import flags as FL
from varsift.operators.annotations import KEY
from varsift.operators.skew import heavy_keys, spread_join
from varsift.params import FilterParams
from varsift.plans.gene_filter import plan_annotations, plan_gene_filter
from varsift.streaming.carriers import carrier_stream


def _unreadable(df):
    """A frame of the same columns that fails when any row of it is read."""
    return df.select(*[F.raise_error(F.lit("read")).cast(f.dataType).alias(f.name) for f in df.schema.fields])


def test_annotations_need_no_genotypes(spark):
    tables = G.tables(spark)
    alone = replace(tables, occurrences=None, diagnoses=None, phenotypes=None, studies=None)
    plan = plan_annotations(alone, G.GENES, [G.STUDY])
    whole = plan_gene_filter(tables, G.GENES, [G.STUDY])
    rows = lambda df: sorted(map(repr, df.collect()))
    for name in ("gene_variants", "annotated", "candidates", "clinvar_seen", "hgmd_seen"):
        assert rows(getattr(plan, name)) == rows(getattr(whole, name)), name
    plan.release()
    whole.release()
    with pytest.raises(ValueError, match="occurrences"):
        plan_gene_filter(alone, G.GENES, [G.STUDY])


def test_a_stream_does_not_read_the_genotype_table(spark, tmp_path):
    tables = G.tables(spark)
    occ = tables.occurrences
    stream = carrier_stream(spark, replace(tables, occurrences=_unreadable(occ)), G.GENES, [G.STUDY], str(tmp_path), occ.schema)
    assert stream.result.isStreaming
    stream.release()


def test_candidates_take_few_jobs(spark):
    """Candidates are found without the genotype join and its measurements (54 jobs with them); nine of these jobs read
    the test tables' schemas, and adaptive execution runs each broadcast as a job of its own."""
    from varsift.plans.queries import q_known_variant_override

    sc = spark.sparkContext
    sc.setJobGroup("candidates", "candidates")
    q_known_variant_override(spark, "/root/testdata/sf0.001")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(sc.statusTracker().getJobIdsForGroup("candidates")) <= 30


HOT = ("1", 100, "A", "C")


@pytest.fixture
def hot(spark):
    """A third of 60 000 variants have one key; its partners and those of others."""
    keys = [F.when(F.col("id") % 3 == 0, F.lit(h)).otherwise(v).alias(k) for k, h, v in zip(
        KEY, HOT, (F.lit("2"), F.col("id") % 20011, F.lit("G"), F.lit("T")))]
    variants = spark.range(60_000).select(*keys, (F.col("id") % 7).alias("af"))
    few = spark.createDataFrame([HOT, HOT, ("2", 50, "G", "T"), (None, 1, "A", "C")], "chromosome string, start long, reference string, alternate string")
    return variants, few.withColumn("symbol", F.lit("S"))


def test_heavy_keys_are_found(spark, hot):
    variants, few = hot
    heavy = heavy_keys(variants, KEY, 1000)
    assert heavy == [few.select(F.xxhash64(*KEY)).first()[0]]
    assert heavy_keys(variants, KEY, 30_000) == [] and heavy_keys(variants.where("false"), KEY, 1) == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_the_plain_join_and_is_spread(spark, hot, how):
    variants, few = hot
    heavy = heavy_keys(variants, KEY, 1000)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plain = variants.join(few, KEY, how)
        spread = spread_join(variants, few, KEY, heavy, 64, how)
        assert spread.columns == plain.columns
        assert Counter(map(tuple, spread.collect())) == Counter(map(tuple, plain.collect()))
        largest = {name: max(r["count"] for r in df.where("start = 100 and chromosome = '1'").groupBy(F.spark_partition_id().alias("p")).count().collect())
                   for name, df in (("plain", plain), ("spread", spread))}
        assert largest["plain"] == 40_000 and largest["spread"] < 10_000  # two partners each
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_joins_of_the_plan_with_heavy_keys(spark, hot):
    """J1, J2 and J5 give the plain joins' rows when keys are salted."""
    variants, few = hot
    variants = variants.withColumnRenamed("af", "max_gnomad_topmed")
    heavy = heavy_keys(variants, KEY, 1000)
    damage = few.dropDuplicates(KEY).select(*KEY, F.lit("1_2").alias("DamagePredCount"), F.lit(0.5).alias("PredCountRatio_D2T"))
    known = few.dropDuplicates(KEY).select(*KEY, F.lit("V1").alias("VariationID"), F.lit(None).cast("array<string>").alias("clin_sig"),
                                           F.lit("c").alias("conditions"))

    def candidates(keys):
        joined = FL.gene_variants(few, variants, keys)
        annotated = FL.annotate_candidates(joined, damage, 1e-4, 0.5, 1.0, keys)
        return FL.override_with_clinvar(annotated, known, keys)

    plain, spread = candidates([]), candidates(heavy)
    assert plain.columns == spread.columns
    assert Counter(map(repr, plain.collect())) == Counter(map(repr, spread.collect()))


def test_the_plan_with_heavy_keys_gives_the_same_result(spark, monkeypatch):
    tables = G.tables(spark)
    want = plan_gene_filter(tables, G.GENES, [G.STUDY])
    rows = lambda p: sorted(tuple(str(v) for v in r) for r in p.result.collect())
    got = plan_gene_filter(tables, G.GENES, [G.STUDY], FilterParams(broadcast_max_rows=0, heavy_key_rows=1))
    assert rows(got) == rows(want)
    got.release()
    want.release()
