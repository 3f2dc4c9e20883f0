"""J3 and J4 by themselves: the curated databases' records are found wherever the study's variants have them."""

import os
from collections import Counter

import duckdb
import golden as G
import pytest

import __spark_entry__ as E
from varsift.operators import annotations as A
from varsift.operators.annotations import GeneSet
from varsift.params import FilterParams
from varsift.plans.gene_filter import plan_seen

PART = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def _mapped(spark, folder, rows):
    """A folder of test tables whose ``part`` has the given (key, brand, size) rows."""
    part = [(k, f"name {k}", brand, "TYPE", size, 1.0) for k, brand, size in rows]
    spark.createDataFrame(part, PART).coalesce(1).write.parquet(f"{folder}/part.parquet")
    for t in ("lineitem", "orders", "events", "region"):
        os.symlink(f"/root/testdata/sf0.001/{t}.parquet", f"{folder}/{t}.parquet")
    return str(folder)


def _as_the_statement(spark, folder, name):
    """The query's rows, which must be those of its DuckDB statement."""
    got = E.queries()[name](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM read_parquet('{folder}/part.parquet/*.parquet')")
    for t in ("lineitem", "orders", "events", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    want = con.sql(E.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    rows = got.select(*want.columns).collect()
    assert Counter(map(tuple, rows)) == Counter(want.fetchall())
    return rows


def test_clinvar_records_without_a_canonical_consequence_are_seen(spark, tmp_path):
    rows = [
        (13, "Brand#1", 4),     # at a canonical consequence
        (26, "Brand#2", 5),     # its consequence is not canonical, no other one on the chromosome
        (52, "Brand#3", 40), (52, "Brand#3", 40),  # not canonical; record and variant come twice
        (156, "Brand#1", None),  # neither size nor class
        (65, "Brand#1", 10),    # uncertain significance
        (78, "Brand#4", 4),     # gene not listed
        (130, "Brand#1", 4),    # variant of the other study only
        (1638, "Brand#1", 5),   # no alternate: no key
        (None, "Brand#1", 4),
    ]
    got = _as_the_statement(spark, _mapped(spark, tmp_path, rows), "clinvar_seen")
    assert Counter(r["VariationID"] for r in got) == {"1013": 1, "1026": 1, "1052": 4}


@pytest.mark.parametrize("bound", [FilterParams().broadcast_max_rows, 0], ids=["broadcast", "shuffle"])
def test_seen_clinvar_records_need_no_consequence(spark, bound):
    """A record at a variant whose consequence is not canonical, by both joins."""
    t = G.tables(spark)
    key = G.VARIANTS["v9"][0]
    more = t.clinvar.union(spark.createDataFrame([(*key, "VCV9", "GENE1:1", ["Pathogenic"], ["Cond D"])], G.CLV_SCHEMA))
    plan = plan_seen(A.clinvar_candidates(more, GeneSet(G.GENES)), t.variants, [G.STUDY], FilterParams(broadcast_max_rows=bound))
    assert plan.measured[0].fits() == (bound > 0)
    seen = plan.detached(plan.seen)
    assert sorted(r["VariationID"] for r in seen.collect()) == ["VCV2", "VCV9"]


def test_hgmd_records_without_a_canonical_consequence_are_seen(spark, tmp_path):
    rows = [
        (17, "Brand#1", 3),     # at a canonical consequence
        (34, "Brand#2", 15),    # its consequence is not canonical, no other one on the chromosome
        (68, "Brand#3", 25), (68, "Brand#3", 25),  # not canonical; record and variant come twice
        (136, "Brand#1", None),  # neither size nor DM
        (119, "Brand#1", 20),   # DFP
        (102, "Brand#4", 3),    # gene not listed
        (170, "Brand#1", 3),    # variant of the other study only
        (3502, "Brand#1", 15),  # no alternate: no key
        (None, "Brand#1", 3),
    ]
    got = _as_the_statement(spark, _mapped(spark, tmp_path, rows), "hgmd_seen")
    assert Counter(r["HGMDID"] for r in got) == {"CM17": 1, "CM34": 1, "CM68": 4}


@pytest.mark.parametrize("bound", [FilterParams().broadcast_max_rows, 0], ids=["broadcast", "shuffle"])
def test_seen_hgmd_records_need_no_consequence(spark, bound):
    """As for ClinVar: a record at a variant whose consequence is not canonical."""
    t = G.tables(spark)
    key = G.VARIANTS["v9"][0]
    more = t.hgmd.union(spark.createDataFrame([(*key, "CM9", "GENE1", "DM", "Phen 9")], G.HGMD_SCHEMA))
    plan = plan_seen(A.hgmd_candidates(more, GeneSet(G.GENES)), t.variants, [G.STUDY], FilterParams(broadcast_max_rows=bound))
    assert plan.measured[0].fits() == (bound > 0)
    seen = plan.detached(plan.seen)
    assert sorted(r["HGMDID"] for r in seen.collect()) == ["CM3", "CM9"]
