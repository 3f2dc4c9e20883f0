"""Readers: gene list (A1), Parquet / Delta tables (A2, A3), study from path (A4),
multi-study genotype reads (A5) and result TSV files (A6)."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varsift.functions import expressions as X
from varsift.operators.ordering import union_by_name
from varsift.sources.inference import guess_types, is_nested, or_unreadable, parsed_json

# Gene lists are small user parameters; longer lists are applied as a semi-join instead of IN.
MAX_LITERAL_GENES = 20_000


def read_gene_list(spark: SparkSession, path: str) -> DataFrame:
    """A1: one gene per line, no header; U+00A0 and newlines removed, nothing trimmed (blank -> '')."""
    return spark.read.text(path).select(X.clean_gene_line("value").alias("gene"))


def gene_values(genes: DataFrame, max_literal: int = MAX_LITERAL_GENES) -> list[str] | DataFrame:
    """The gene list as literal values when it has at most ``max_literal`` lines, else the frame.

    Literal values reach the Parquet reader as an ``IN`` filter; a longer list stays distributed
    and is applied with semi-joins. At most ``max_literal + 1`` rows are fetched.
    """
    rows = genes.limit(max_literal + 1).collect()
    if len(rows) > max_literal:
        return genes
    return [r[0] for r in rows]


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """A2 / A3: a table by path; ``fmt`` may be ``parquet``, ``delta`` (needs the Delta jar) or any source."""
    reader = spark.read.format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path)


_STUDY_RE = re.compile(X.STUDY_IN_PATH)


def study_from_path(path: str) -> str:
    """A4 for a driver-side path string: ``.../occurrences_sd_abc_re_04`` -> ``SD_ABC``."""
    m = _STUDY_RE.search(path)
    if m is None:
        raise ValueError(f"no 'occurrences_sd..._re_' marker in path {path!r}")
    return m.group(1).upper()


def occurrences_for_studies(occurrences: DataFrame, studies: Sequence[str]) -> DataFrame:
    """A5: the genotype rows of several studies from one read.

    With a ``study_id``-partitioned table this prunes to the listed partitions (no per-study
    reads, no union of many plans).
    """
    return occurrences.where(F.col("study_id").isin(list(studies)))


def read_study_partitions(spark: SparkSession, parent: str, studies: Sequence[str], fmt: str = "parquet"
                          ) -> DataFrame:
    """A5 over ``<parent>/occurrences_*/study_id=<id>``: the genotype rows of several studies.

    Only the wanted studies' partitions are listed and read. Each ``occurrences_*`` directory is its own
    partitioned table (its ``basePath``), so their reads are row-bound by name (F4). A study without a
    partition is an error, also when the others have one.
    """
    base = parent.rstrip("/")
    roots: dict[str, list[str]] = {}
    missing = []
    for study in dict.fromkeys(studies):
        try:
            listed = spark.read.format("binaryFile").load(f"{base}/occurrences_*/study_id={study}").select(
                F.regexp_extract("path", r"^(.*)/study_id=[^/]*/", 1).alias("root")).distinct().collect()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            listed = []
        if not listed:
            missing.append(study)
        for r in listed:
            roots.setdefault(r.root, []).append(f"{r.root}/study_id={study}")
    if missing:
        raise ValueError(f"no genotype partitions for studies {missing} under {parent!r}")
    return union_by_name([spark.read.format(fmt).option("basePath", root).load(paths)
                          for root, paths in sorted(roots.items())])


_CALLS = T.ArrayType(T.IntegerType())
_TEXTS = T.ArrayType(T.StringType())

# Types of result columns written by the filter; any other column is read as text, or guessed (read_typed_results).
RESULT_TYPES: dict[str, T.DataType] = {
    "start": T.LongType(),
    "dp": T.IntegerType(),
    "variant_allele_fraction": T.DoubleType(),
    "max_gnomad_topmed": T.DoubleType(),
    "PredCountRatio_D2T": T.DoubleType(),
    "TWINSUK_AF": T.DoubleType(),
    "ALSPAC_AF": T.DoubleType(),
    "UK10K_AF": T.DoubleType(),
    "is_lo_conf_denovo": T.BooleanType(),
    "is_hi_conf_denovo": T.BooleanType(),
    "is_proband": T.BooleanType(),
    "ad": _CALLS,
    "calls": _CALLS,
    "adjusted_calls": _CALLS,
    "clin_sig": _TEXTS,
    "diagnoses_combined": _TEXTS,
    "phenotypes_combined": _TEXTS,
    "hpos_combined": _TEXTS,
}


def _cell(column: str, null_value: str):
    """The cell's text: the null text is null, an empty cell (which the CSV source reads as null) is empty."""
    cell = F.coalesce(F.col(column), F.lit(""))
    return F.when(cell != null_value, cell)


def _parsed(column: str, kind: T.DataType, null_value: str):
    """The text column as ``kind``; whole numbers may be written as ``30.0`` or ``1e3``, an empty cell is null.

    Text that is no such value fails the read: a result is never changed to null silently.
    """
    text = F.nullif(_cell(column, null_value), F.lit(""))
    if is_nested(kind):
        return parsed_json(text, kind, column)
    value = text.try_cast(kind)
    if isinstance(kind, T.IntegralType):
        number = text.try_cast(T.DecimalType(38, 10))
        value = F.coalesce(value, F.when(number == F.floor(number), number).try_cast(kind))
    return or_unreadable(value, text, kind, column)


def _known_type(column: str) -> T.DataType | None:
    return RESULT_TYPES.get(column) or (T.DoubleType() if column.endswith("_af") else None)


def _typed(df: DataFrame, options: ResultReadOptions, guessed: dict[str, T.DataType] | None = None) -> DataFrame:
    out = []
    for c in df.columns:
        t = _known_type(c) or (guessed or {}).get(c)
        if t is None or isinstance(t, T.StringType) or (is_nested(t) and not options.nested):
            out.append(_cell(c, options.null_value).alias(c))
        else:
            out.append(_parsed(c, t, options.null_value).alias(c))
    return df.select(*out)


@dataclass(frozen=True)
class ResultReadOptions:
    """``quote=""`` reads unquoted files (A8); quoted cells may hold line breaks. ``nested=False`` keeps array and
    struct cells as their JSON text (a merge writes them back as they are)."""

    sep: str = "\t"
    null_value: str = "-"
    quote: str = '"'
    nested: bool = True


def _result_reader(spark: SparkSession, options: ResultReadOptions):
    return (spark.read.option("sep", options.sep).option("header", True).option("nullValue", "")
            .option("quote", options.quote).option("escape", options.quote).option("multiLine", options.quote != "")
            .option("emptyValue", "").option("inferSchema", False))


def read_result(spark: SparkSession, path: str, options: ResultReadOptions = ResultReadOptions()) -> DataFrame:
    """A6 for one run's output (a file or a directory of part files): header row, ``-`` is null.

    Columns are read as text and known result columns are cast to their types (array cells from their JSON text), so
    no extra schema-inference pass over the data is made; ``read_typed_results`` guesses the others.
    """
    return _typed(_result_reader(spark, options).csv(path), options)


def read_results(spark: SparkSession, paths: Sequence[str], options: ResultReadOptions = ResultReadOptions()
                 ) -> DataFrame:
    """A6 + F3: several runs' outputs, row-bound by column name.

    Runs are grouped by their header (read from each run's first line), and each group is read
    with one reader, so the union has one branch per distinct column layout rather than per run.
    """
    return union_by_name([_typed(df, options) for df in _by_header(spark, paths, options)])


def _by_header(spark: SparkSession, paths: Sequence[str], options: ResultReadOptions) -> list[DataFrame]:
    """The runs' text cells, one frame for each distinct header."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for p in paths:
        header = tuple(_result_reader(spark, options).csv(p).columns)
        groups.setdefault(header, []).append(p)
    return [_result_reader(spark, options).csv(list(ps)) for ps in groups.values()]


def _run_of(paths: Sequence[str], name):
    """The run of a file by its name as Spark gives it: the file, or the folder of the part file."""
    own = {p.split("://", 1)[-1].split(":", 1)[-1].strip("/"): p for p in paths}
    runs = F.map_from_arrays(F.array(*map(F.lit, own)), F.array(*map(F.lit, own.values())))
    file = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    file = F.regexp_replace(file, "^[A-Za-z0-9+.-]+:/+", "")
    return F.coalesce(F.try_element_at(runs, file), F.try_element_at(runs, F.regexp_replace(file, "/[^/]*$", "")))


def guess_result_types(spark: SparkSession, paths: Sequence[str], options: ResultReadOptions = ResultReadOptions()
                       ) -> tuple[dict[str, T.DataType], dict[str, dict[str, T.DataType]]]:
    """The types of all columns that the library does not know (R's per-file guess): over all runs, and for each run.

    One pass over the cells of all runs; a column that a run lacks says nothing about its type there.
    """
    shown, columns = _unknown_cells(spark, paths, options)
    return guess_types(shown, columns, _run_of(paths, F.col("__file")), "__file")


def _unknown_cells(spark: SparkSession, paths: Sequence[str], options: ResultReadOptions) -> tuple[DataFrame, list[str]]:
    """The cells of the columns that the library does not know, with the name of each row's file."""
    cells = union_by_name([df.withColumn("__file", F.input_file_name()) for df in _by_header(spark, paths, options)])
    columns = [c for c in cells.columns if c != "__file" and _known_type(c) is None]
    return cells.select("__file", *[_cell(c, options.null_value).alias(c) for c in columns]), columns


def read_typed_results(spark: SparkSession, paths: Sequence[str], options: ResultReadOptions = ResultReadOptions()
                       ) -> DataFrame:
    """A6 + F3 for result files of any origin: known columns by their types, all others by the type that the cells of
    all runs allow (a column that is a number in one run and text in another is text)."""
    guessed, _ = guess_types(*_unknown_cells(spark, paths, options))
    return union_by_name([_typed(df, options, guessed) for df in _by_header(spark, paths, options)])


def expand_result_paths(spark: SparkSession, patterns: Sequence[str]) -> list[str]:
    """Glob patterns (e.g. ``results/*.tsv.gz``) -> the run outputs they match, on any file system.

    The listing is done by Spark's file source (only the ``path`` column is read, never the file
    contents; hidden ``_``/``.`` files are skipped). A listed file whose name matches the pattern's
    last part is a run by itself; otherwise it is a part file and its directory is the run. Only
    the run paths reach the driver.
    """
    runs: set[str] = set()
    for pattern in patterns:
        last = pattern.rstrip("/").rsplit("/", 1)[-1]
        for row in spark.read.format("binaryFile").load(pattern).select("path").collect():
            parent, _, name = row.path.rstrip("/").rpartition("/")
            runs.add(row.path if fnmatch.fnmatch(name, last) else parent)
    return sorted(runs)
