"""Every registered query against its DuckDB oracle statement, at sf0.001."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from varsift.plans.oracle import SQL  # noqa: E402
from varsift.plans.queries import QUERIES  # noqa: E402
from check_oracle import TABLES, compare  # noqa: E402
from conftest import SF001  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    status, n_spark, n_oracle, _, info = compare(spark, con, name, SF001)
    assert status == "OK", (status, n_spark, n_oracle, info)


def test_mapped_tables_exercise_every_predicate():
    """Each predicate of the flagship rejects a row at sf0.01, and the cases of the inventory occur."""
    from varsift.plans.oracle import FLAGSHIP_CTES, _with

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.01/{t}.parquet')")

    def count(what):
        return c.sql(_with(*FLAGSHIP_CTES) + f"SELECT count(*) FROM {what}").fetchall()[0][0]

    rare = "cand WHERE max_gnomad_topmed < 0.0001 AND"
    for what in (f"{rare} PredCountRatio_D2T < 0.5", f"{rare} PredCountRatio_D2T > 1", "cand WHERE max_gnomad_topmed >= 0.0001",
                 "over WHERE flag = 1 AND VariationID IS NOT NULL", "over WHERE flag = 1 AND HGMDID IS NOT NULL",
                 "f_consequences WHERE original_canonical AND study = 'SD_B'", "f_occ WHERE ad0 + ad1 = 0",
                 "f_variants WHERE chromosome = 'MT'", "f_variants WHERE alternate IS NULL", "f_variants WHERE study IS NULL",
                 "f_variants WHERE study LIKE '%|%'", "f_clinvar WHERE sig IS NULL", "f_clinvar WHERE sig LIKE '%|%'",
                 "(SELECT 1 FROM f_variants GROUP BY chromosome, start, reference, alternate HAVING count(*) > 1)",
                 "res WHERE diagnoses_combined IS NOT NULL"):
        assert count(what) > 0, what
    runs = c.sql("SELECT count(VariationID), count(HGMDID), count(*) FROM (" + E.oracle_sql()["combined_results"] + ")").fetchall()[0]
    assert runs[0] > 0 and runs[1] > 0
    assert c.sql(f"SELECT count(*) FROM ({E.oracle_sql()['gene_based_filter_multi_study']})").fetchall()[0][0] > count("res")


def test_no_cached_frames_are_left(spark):
    spark.catalog.clearCache()
    for name in ("gene_based_filter", "combined_results", "flagged_carriers"):
        E.queries()[name](spark, SF001).count()
        assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0, name


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 36  # FIXTURES.md: result rows at sf0.001
    assert len(df.columns) == 48


@pytest.mark.parametrize("keys,rows", [(0, 0), (100, 0), (10**9, 0)], ids=["shuffle", "regions", "key-semi-join"])
def test_fallback_paths_match_default_on_test_tables(spark, keys, rows):
    """Every broadcast / shuffle branch of the genotype join gives the default result (sf0.01)."""
    from conftest import SF01
    from varsift.params import FilterParams
    from varsift.plans.fixtures import FLAGSHIP_GENES, FLAGSHIP_STUDIES, mapped_tables
    from varsift.plans.gene_filter import VariantTables, plan_gene_filter
    from varsift.plans.queries import render

    t = mapped_tables(spark, SF01)
    vt = VariantTables(t.consequences, t.variants, t.dbnsfp, t.occurrences, t.diagnoses, t.phenotypes, t.clinvar,
                       t.hgmd, t.studies)

    def rows_of(params):
        plan = plan_gene_filter(vt, FLAGSHIP_GENES, FLAGSHIP_STUDIES, params)
        out = sorted(tuple(str(v) for v in r) for r in render(plan.result).collect())
        plan.release()
        return out

    base = rows_of(FilterParams())
    assert len(base) == 295  # FIXTURES.md: result rows at sf0.01
    assert rows_of(FilterParams(broadcast_max_keys=keys, broadcast_max_rows=rows)) == base
