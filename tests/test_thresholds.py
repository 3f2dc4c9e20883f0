"""The surface of thresholds equals separate runs of the filter."""

import itertools
from dataclasses import replace

import golden as G
import pytest

from varsift.params import FilterParams
from varsift.plans.gene_filter import plan_gene_filter
from varsift.plans.thresholds import ThresholdGrid, counted_settings, threshold_surface

COLUMNS = "max_gnomad_topmed double, PredCountRatio_D2T double, variant_allele_fraction double, _known boolean"


@pytest.mark.parametrize("databases", [("ClinVar", "HGMD"), ()])
def test_surface_equals_separate_runs(spark, databases):
    grid = ThresholdGrid(maf=(0.0001, 0.5), dpc_l=(0.1, 0.5), dpc_u=(0.6, 1.0), aaf=(0.0, 0.2, 0.6))
    params = FilterParams(known_variants=databases)
    tables = G.tables(spark)
    alone = replace(tables, diagnoses=None, phenotypes=None, studies=None)
    rows, plan = threshold_surface(alone, G.GENES, [G.STUDY], grid, params)
    got = {(r.maf, r.dpc_l, r.dpc_u, r.aaf): r.n_rows for r in rows.collect()}
    plan.release()
    assert len(got) == grid.size == 24
    for maf, low, high, aaf in ((0.0001, 0.5, 1.0, 0.2), (0.5, 0.1, 0.6, 0.0), (0.5, 0.5, 1.0, 0.6))[: 3 if databases else 1]:
        run = plan_gene_filter(tables, G.GENES, [G.STUDY], replace(params, maf=maf, dpc_l=low, dpc_u=high, aaf=aaf))
        assert got[maf, low, high, aaf] == run.carriers.count(), (maf, low, high, aaf)
        run.release()


def test_counts_on_edges_and_missing_values(spark):
    """Values equal to a threshold, null ratios and fractions, NaN, known rows and rows that no setting lets through."""
    nan = float("nan")
    values = [(a, r, f, k) for a in (0.0, 0.1, 0.2, nan) for r in (None, 0.2, 0.5, 0.9, nan) for f in (None, 0.0, 0.3, 1.0)
              for k in (True, False)]
    grid = ThresholdGrid(maf=(0.2, 0.1), dpc_l=(0.5, 0.0, 0.3), dpc_u=(0.5, 1.0), aaf=(0.3, 0.1))
    got = {(r.maf, r.dpc_l, r.dpc_u, r.aaf): (r.n_rows, r.n_known)
           for r in counted_settings(spark.createDataFrame(values, COLUMNS), grid).collect()}
    want = {}
    for maf, low, high, aaf in itertools.product(grid.maf, grid.dpc_l, grid.dpc_u, grid.aaf):
        own = [k for a, r, f, k in values if (f is None or f >= aaf) and (k or a < maf and (r is None or low <= r <= high))]
        want[maf, low, high, aaf] = (len(own), sum(own))
    assert got == want


def test_empty_rows_and_bad_grids(spark):
    grid = ThresholdGrid()
    assert [tuple(r) for r in counted_settings(spark.createDataFrame([], COLUMNS), grid).collect()] == [(0.0001, 0.5, 1.0, 0.2, 0, 0)]
    with pytest.raises(ValueError, match="maf"):
        ThresholdGrid(maf=())
    with pytest.raises(ValueError, match="settings"):
        ThresholdGrid(maf=range(400), aaf=range(400))
