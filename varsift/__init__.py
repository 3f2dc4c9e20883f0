"""varsift: gene-based variant filtering over study cohorts, written as Spark DataFrame plans.

Layout
------
``functions``  column expressions (ANSI-safe scalar semantics)
``sources``    readers and writers (gene list, Parquet/Delta tables, TSV results)
``operators``  relational building blocks (annotations, flags, carriers, clinical data, ordering, merge)
``plans``      end-to-end jobs (gene-based filter, write, combine) and the test-table mapping
``streaming``  incremental carrier search over newly arriving genotype files
"""

from varsift.params import FilterParams, Profile, NEW_PROFILE, OLD_PROFILE
from varsift.plans.gene_filter import VariantTables, filter_variants

__all__ = [
    "FilterParams",
    "Profile",
    "NEW_PROFILE",
    "OLD_PROFILE",
    "VariantTables",
    "filter_variants",
]
