"""Orderings and the distributed rank, checked by brute force on small frames."""

import random

from pyspark.sql import functions as F

from varsift.operators import ordering as R


def brute_rank(rows, key):
    keys = [key(r) for r in rows]
    return [1 + sum(k2 < k for k2 in keys) for k in keys]


def test_global_rank_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice(["1", "2", "X", "10", None]), rnd.randint(0, 30), rnd.choice(["F1", "F2", None]), i)
            for i in range(400)]
    df = spark.createDataFrame(rows, "chromosome string, start long, family_id string, id int").repartition(7)
    keys = [R.SortKey(F.col(c), True) for c in ("chromosome", "start", "family_id")]
    got = {r.id: r.rk for r in R.global_rank(df, keys, "rk").collect()}

    def key(r):
        return (r[0] is not None, r[0] or "", r[1], r[2] is not None, r[2] or "")

    want = dict(zip([r[3] for r in rows], brute_rank(rows, key)))
    assert got == want


def test_result_order_sorts_like_reference_keys(spark):
    df = spark.createDataFrame([("X", 5, "B", "F1", False), ("2", 7, "A", "F2", True), ("10", 1, None, None, None),
                                ("2", 7, "A", "F1", True), (None, 3, "A", "F1", False)],
                               "chromosome string, start long, study_code string, family_id string, is_proband boolean")
    got = [tuple(r) for r in df.orderBy(*R.result_order()).collect()]
    assert [g[0] for g in got] == [None, "2", "2", "10", "X"]
    assert got[1][3] == "F1" and got[2][3] == "F2"


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, k int")
    u = R.union_by_name([a, b])
    assert u.columns == ["k", "a", "b"]
    assert sorted(tuple(r) for r in u.collect()) == [(1, "x", None), (2, None, "y")]


def test_global_rank_hot_key_and_nulls_last(spark):
    rows = [("1", 5, i) for i in range(300)] + [("2", None, 1000), ("1", 4, 1001), (None, 1, 1002)]
    df = spark.createDataFrame(rows, "chromosome string, start long, id int").repartition(5)
    keys = [R.SortKey(F.col("chromosome"), False), R.SortKey(F.col("start"), False)]
    got = {r.id: r.rk for r in R.global_rank(df, keys, "rk").collect()}
    assert got[1001] == 1 and all(got[i] == 2 for i in range(300))
    assert got[1000] == 302 and got[1002] == 303


def test_sort_result_splits_ties_but_keeps_key_order(spark):
    rows = [("1", 5, "S", "F", True, f"PT_{i % 7}", f"BS_{i}") for i in range(200)] + [
        ("1", 4, "S", "F", True, "PT_0", "BS_x")]
    df = spark.createDataFrame(rows, "chromosome string, start long, study_code string, family_id string, "
                                     "is_proband boolean, participant_id string, biospecimen_id string")
    out = R.sort_result(df.repartition(4))
    got = out.collect()
    assert got[0].biospecimen_id == "BS_x"
    assert [r.participant_id for r in got[1:]] == sorted(r.participant_id for r in got[1:])
    # the 200 tied rows are spread over more than one range partition (AQE coalescing off, since it
    # would merge these tiny partitions again)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = out.select(F.spark_partition_id().alias("p"), "start").where("start = 5").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts > 1
