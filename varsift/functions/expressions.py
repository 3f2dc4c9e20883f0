"""Column expressions of the filter, written to behave the same with ANSI mode on or off.

Every function returns a ``Column`` built from Spark built-ins only, so each stays inside
whole-stage code generation and runs on the executors.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from varsift.params import (
    CLINVAR_SIGNIFICANCE,
    HGMD_CLASS_PREFIX,
)

# Characters removed from every gene-list line, and chromosome levels.
GENE_LINE_REMOVED_CHARS = "\u00a0\n"
SEX_CHROMOSOMES = ("X", "Y", "x", "y")
CHROMOSOME_LEVELS = tuple(str(i) for i in range(1, 23)) + ("X", "Y")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- A1 -------------------------------------------------------------------------------------
def clean_gene_line(c: str | Column = "value") -> Column:
    """Drop U+00A0 and newline characters anywhere in a gene-list line (no trimming)."""
    return F.translate(_col(c), GENE_LINE_REMOVED_CHARS, "")


# --- A4 -------------------------------------------------------------------------------------
STUDY_IN_PATH = r"occurrences_(sd.*?)_re_"


def study_id_from_path(c: str | Column) -> Column:
    """``.../occurrences_sd_abc_re_04`` -> ``SD_ABC``; null when a marker is missing."""
    extracted = F.regexp_extract(_col(c), STUDY_IN_PATH, 1)
    return F.when(extracted != "", F.upper(extracted))


# --- C1 / S1 --------------------------------------------------------------------------------
# Fixed value: text that reads as the integer 0 (optional sign, zeros, optional fraction), the
# test the original applies to the total before dividing.
INTEGER_ZERO_TEXT = r"^\s*[+-]?(0+(\.[0-9]*)?|\.[0-9]*)\s*$"


def damage_ratio(c: str | Column = "DamagePredCount") -> Column:
    """``"<damaging>_<total>"`` -> damaging / total.

    Null when the string has no second part, when the total reads as the integer 0 (so ``0``,
    ``0.5`` and ``-.9`` give null, like the original's integer comparison), or when a part is not a
    number. Never raises, in either ANSI mode.
    """
    parts = F.split(_col(c), "_")
    num = F.get(parts, 0).try_cast("double")
    den_text = F.get(parts, 1)
    den = den_text.try_cast("double")
    return F.when(den_text.rlike(INTEGER_ZERO_TEXT), F.lit(None).cast("double")).otherwise(F.try_divide(num, den))


# --- C2 / C3 --------------------------------------------------------------------------------
def frequency_column(database: str, parent: str | None) -> Column:
    path = f"{parent}.{database}.af" if parent else f"{database}.af"
    return F.col(path)


def max_population_af(databases: Iterable[str], parent: str | None) -> Column:
    """Greatest of 0 and each database's ``af``; nulls are skipped, so never null."""
    return F.greatest(F.lit(0.0), *[frequency_column(db, parent) for db in databases])


# --- B3 / S3 --------------------------------------------------------------------------------
def overlaps_any(array_col: str | Column, values: Iterable[str]) -> Column:
    """True when the array shares an element with ``values``; false (never null) otherwise."""
    wanted = F.array(*[F.lit(v) for v in values])
    return F.coalesce(F.arrays_overlap(_col(array_col), wanted), F.lit(False))


# --- B5 -------------------------------------------------------------------------------------
def first_gene(c: str | Column = "geneinfo") -> Column:
    """Gene symbol of a ``SYM:id|SYM:id`` list: text before the first ``|``, then before ``:``."""
    return F.get(F.split(F.get(F.split(_col(c), r"\|"), 0), ":"), 0)


# --- B6 / B7 --------------------------------------------------------------------------------
def has_significance(c: str | Column = "clin_sig", levels: Iterable[str] = CLINVAR_SIGNIFICANCE) -> Column:
    """Array has one of ``levels`` as an exact element."""
    cond = None
    for lvl in levels:
        term = F.array_contains(_col(c), lvl)
        cond = term if cond is None else (cond | term)
    return cond


# --- B8 -------------------------------------------------------------------------------------
def is_disease_causing_class(c: str | Column = "variant_class") -> Column:
    return _col(c).startswith(HGMD_CLASS_PREFIX)


# --- C6 / S4 --------------------------------------------------------------------------------
def allele_fraction(ad: str | Column = "ad") -> Column:
    """``ad[1] / (ad[0] + ad[1])``; null for zero depth, a short array, a null array or an
    overflowing sum (never raises, in either ANSI mode)."""
    a = _col(ad)
    return F.try_divide(F.get(a, 1), F.try_add(F.get(a, 0), F.get(a, 1)))


# --- C7 -------------------------------------------------------------------------------------
def adjusted_calls(vaf: str | Column, calls: str | Column, aaf: float) -> Column:
    """``[0, 0]`` when the allele fraction is below ``aaf``; the calls otherwise (null VAF keeps them)."""
    return F.when(_col(vaf) < F.lit(aaf), F.array(F.lit(0), F.lit(0))).otherwise(_col(calls))


def is_called(adjusted: str | Column) -> Column:
    """Adjusted call differs from ``[0, 0]`` (null rejected when used as a filter)."""
    return _col(adjusted) != F.array(F.lit(0), F.lit(0))


# --- C8 -------------------------------------------------------------------------------------
def rare_damaging_flag(max_af: str | Column, ratio: str | Column, maf: float, dpc_l: float,
                       dpc_u: float) -> Column:
    """1 when rare (``max_af < maf``) and the damage ratio is missing or within ``[dpc_l, dpc_u]``."""
    r = _col(ratio)
    ok = (_col(max_af) < F.lit(maf)) & (r.isNull() | ((r >= F.lit(dpc_l)) & (r <= F.lit(dpc_u))))
    return F.when(ok, F.lit(1)).otherwise(F.lit(0))


# --- C9 -------------------------------------------------------------------------------------
def known_override(flag: str | Column, annotation_id: str | Column) -> Column:
    return F.when(_col(annotation_id).isNotNull(), F.lit(1)).otherwise(_col(flag))


# --- C10 ------------------------------------------------------------------------------------
def normalise_participant(c: str | Column) -> Column:
    """Upper-case and turn every ``-`` into ``_``."""
    return F.translate(F.upper(_col(c)), "-", "_")


# --- C11 ------------------------------------------------------------------------------------
def chromosome_sort_key(c: str | Column = "chromosome") -> Column:
    """Two-character sort key: sex chromosomes padded with ``2``, the rest with ``0``."""
    ch = _col(c)
    return F.when(ch.isin(*SEX_CHROMOSOMES), F.lpad(ch, 2, "2")).otherwise(F.lpad(ch, 2, "0"))


# --- C12 ------------------------------------------------------------------------------------
def chromosome_level(c: str | Column = "chromosome") -> Column:
    """Chromosome kept only when it is one of ``1..22, X, Y``; null otherwise."""
    ch = _col(c).cast("string")
    return F.when(ch.isin(*CHROMOSOME_LEVELS), ch)


def chromosome_rank(c: str | Column = "chromosome") -> Column:
    """Position of the chromosome in ``1..22, X, Y`` (1-based); null outside these levels."""
    levels = F.array(*[F.lit(v) for v in CHROMOSOME_LEVELS])
    pos = F.array_position(levels, _col(c).cast("string")).cast("int")
    return F.when(pos > 0, pos)


# --- rendering ------------------------------------------------------------------------------
def render_list(c: str | Column, sep: str = "|") -> Column:
    """Array -> delimited string (elements cast to string, null elements skipped)."""
    return F.array_join(F.transform(_col(c), lambda x: x.cast("string")), sep)
