"""P2 (write a run's result) and P3 (combine the results of many runs)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from varsift.functions import expressions as X
from varsift.operators import ordering as R
from varsift.params import FilterParams
from varsift.sources import readers as RD
from varsift.sources import sinks as SK

# The merged file's sort columns after chromosome and start.
COMBINED_TIE_COLUMNS = ("study_code", "family_id", "is_proband")


def write_result(df: DataFrame, out_dir: str, studies: Sequence[str], params: FilterParams = FilterParams(),
                 run_date: _dt.date | None = None, single_file: bool = False,
                 tie_columns: Sequence[str] = R.RESULT_TIE_COLUMNS) -> str:
    """Sort (F1, new layout) and write the result as gzip TSV under a dated name.

    ``tie_columns`` sort rows of one position; one that the result lacks is an error. Returns the output
    path: a directory of part files, ordered by part number, or with ``single_file`` one file joined from them.
    """
    path = f"{out_dir.rstrip('/')}/{SK.output_name(params.output_basename, studies, run_date or _today(df))}"
    if not params.profile.sorted_output:
        SK.write_tsv(df, path, compression="gzip", single_file=single_file)
        return path
    # The range partitioner of the global sort samples its input in a separate job; persisting the
    # result first keeps that pass from recomputing the filter (and re-reading the genotype table).
    staged = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        SK.write_tsv(staged, path, compression="gzip", single_file=single_file,
                     order=R.result_row_order(staged, tie_columns))
    finally:
        staged.unpersist()
    return path


def _today(df: DataFrame) -> _dt.date:
    """The session's date (its time zone), as SQL's ``current_date`` gives it."""
    return df.sparkSession.sql("SELECT current_date() AS day").first().day


def combine_results(spark: SparkSession, paths: Sequence[str],
                    tie_columns: Sequence[str] = COMBINED_TIE_COLUMNS) -> DataFrame:
    """Read every run's TSV (A6), row-bind by name (F3), keep chromosomes ``1..22, X, Y`` (C12,
    others become null) and order by chromosome rank, start and the tie columns, missing last (F2)."""
    merged = RD.read_results(spark, paths, RD.ResultReadOptions(nested=False)).withColumn("chromosome", X.chromosome_level("chromosome"))
    return merged.orderBy(*R.combined_row_order(merged, tie_columns))


def write_combined(df: DataFrame, out_dir: str, run_date: _dt.date | None = None, single_file: bool = False,
                   prefix: str = SK.COMBINED_PREFIX) -> str:
    """Plain TSV, no quoting, nulls as ``-``, named ``<prefix><date>.tsv``: part files in the frame's order.

    ``single_file`` joins the part files to one file.
    """
    path = f"{out_dir.rstrip('/')}/{SK.combined_name(run_date or _today(df), prefix)}"
    SK.write_tsv(df, path, compression="none", single_file=single_file, quote=False)
    return path
