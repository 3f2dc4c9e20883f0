"""P4 as a surface: how many result rows every setting of a grid of thresholds gives, from one genotype scan.

The filter runs once with the loosest thresholds of the grid. Each row of that result passes exactly the settings with
``maf`` above its population frequency, ``dpc_l`` at most and ``dpc_u`` at least its damage ratio, and ``aaf`` at most its
allele fraction, so along each threshold it passes from one grid value on, or up to one. Rows are counted by these
four places (at most one count a setting and task leaves the map side) and running sums along the four thresholds turn
the places' counts into the settings' counts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, fields, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varsift.operators.annotations import GeneSet
from varsift.params import DEFAULT_AAF, DEFAULT_DPC_L, DEFAULT_DPC_U, DEFAULT_MAF, FilterParams
from varsift.plans.gene_filter import AnnotationPlan, VariantTables, join_flagged, measured_flagged, plan_annotations

#: Settings of one grid; the running sums are over a table of this many rows at most.
MAX_SETTINGS = 100_000


@dataclass(frozen=True)
class ThresholdGrid:
    """The values of each threshold; every combination is a setting."""

    maf: tuple[float, ...] = (DEFAULT_MAF,)
    dpc_l: tuple[float, ...] = (DEFAULT_DPC_L,)
    dpc_u: tuple[float, ...] = (DEFAULT_DPC_U,)
    aaf: tuple[float, ...] = (DEFAULT_AAF,)

    def __post_init__(self):
        for f in fields(self):
            values = tuple(sorted({float(v) for v in getattr(self, f.name)}))
            if not values or any(math.isnan(v) for v in values):
                raise ValueError(f"{f.name} needs at least one value, and no NaN")
            object.__setattr__(self, f.name, values)
        if self.size > MAX_SETTINGS:
            raise ValueError(f"{self.size} settings; at most {MAX_SETTINGS}")

    @property
    def size(self) -> int:
        return math.prod(len(getattr(self, f.name)) for f in fields(self))

    def loosest(self, params: FilterParams) -> FilterParams:
        """``params`` with thresholds that let through what any setting lets through."""
        return replace(params, maf=self.maf[-1], dpc_l=self.dpc_l[0], dpc_u=self.dpc_u[-1], aaf=self.aaf[0])


def _count(values: Sequence[float], passes) -> Column:
    """How many of the grid's values the condition holds for."""
    return reduce(lambda a, b: a + b, [F.when(passes(F.lit(v)), 1).otherwise(0) for v in values])


def places(grid: ThresholdGrid) -> dict[str, Column]:
    """By threshold, the place in the grid from which on (``maf``, ``dpc_u``) or up to which (``dpc_l``, ``aaf``) a row
    passes; ``_known`` rows are held to ``aaf`` alone, and a missing ratio or fraction passes everywhere."""
    ratio, fraction = F.col("PredCountRatio_D2T"), F.col("variant_allele_fraction")
    free = F.col("_known") | ratio.isNull()
    return {
        "maf": F.when(F.col("_known"), 0).otherwise(_count(grid.maf, lambda v: F.col("max_gnomad_topmed") >= v)),
        "dpc_l": F.when(free, len(grid.dpc_l) - 1).otherwise(_count(grid.dpc_l, lambda v: ratio >= v) - 1),
        "dpc_u": F.when(free, 0).otherwise(_count(grid.dpc_u, lambda v: ratio > v)),
        "aaf": F.when(fraction.isNull(), len(grid.aaf) - 1).otherwise(_count(grid.aaf, lambda v: fraction >= v) - 1),
    }


def _lattice(rows: DataFrame, grid: ThresholdGrid) -> DataFrame:
    """One row for each setting: the four places and the four values."""
    place, below = {}, 1
    for f in fields(grid):
        n = len(getattr(grid, f.name))
        place[f.name] = (F.floor(F.col("id") / below) % n).cast("int")
        below *= n
    every = rows.sparkSession.range(grid.size, numPartitions=1)
    return every.select(*[c.alias(f"_{k}") for k, c in place.items()], *[
        F.element_at(F.array(*[F.lit(v) for v in getattr(grid, k)]), c + 1).alias(k) for k, c in place.items()])


def counted_settings(rows: DataFrame, grid: ThresholdGrid) -> DataFrame:
    """maf, dpc_l, dpc_u, aaf, n_rows, n_known for each setting of the grid.

    ``rows``: max_gnomad_topmed, PredCountRatio_D2T, variant_allele_fraction, ``_known`` (listed in a database). A
    setting that no row passes has zeros.
    """
    at = rows.select(*[c.alias(f"_{k}") for k, c in places(grid).items()], F.col("_known").cast("long").alias("_known"))
    names = [f"_{f.name}" for f in fields(grid)]
    counts = at.groupBy(*names).agg(F.count("*").alias("n_rows"), F.sum("_known").alias("n_known"))
    # rows outside the grid (a place before its first or after its last value) pass nothing and find no setting
    sums = _lattice(rows, grid).join(counts, names, "left").fillna(0, ["n_rows", "n_known"])
    for name, onward in (("_maf", True), ("_dpc_l", False), ("_dpc_u", True), ("_aaf", False)):
        over = Window.partitionBy(*[n for n in names if n != name]).orderBy(F.col(name) if onward else F.desc(name))
        over = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = sums.withColumns({c: F.sum(c).over(over) for c in ("n_rows", "n_known")})
    return sums.drop(*names)


def threshold_surface(tables: VariantTables, genes: Sequence[str] | DataFrame | GeneSet, studies: Sequence[str],
                      grid: ThresholdGrid, params: FilterParams = FilterParams(),
                      restrict_occurrences_to_studies: bool = False) -> tuple[DataFrame, AnnotationPlan]:
    """The rows that ``filter_variants`` would give at every setting of the grid, and how many of them are of listed
    disease variants; diagnoses, phenotypes and studies are not needed. Also the plan, whose caches are to be released
    after use."""
    if tables.occurrences is None:
        raise ValueError("missing input tables: occurrences")
    loose = grid.loosest(params)
    plan = plan_annotations(tables, genes, studies, loose)
    flagged, measured = measured_flagged(plan, loose)
    rows = join_flagged(plan.on_gene_chromosomes(tables.occurrences), flagged, loose, measured, plan.measured_consequences,
                        list(studies) if restrict_occurrences_to_studies else None, plan.measured)
    ids = [name for name, used in (("VariationID", loose.use_clinvar), ("HGMDID", loose.use_hgmd)) if used]
    known = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in ids], F.lit(False))
    rows = rows.select("max_gnomad_topmed", "PredCountRatio_D2T", "variant_allele_fraction", known.alias("_known"))
    return counted_settings(rows, grid), plan
