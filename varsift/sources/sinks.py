"""Writers: gzip TSV result (A7), plain TSV (A8) and the dated output name.

Spark's CSV source cannot hold arrays, so array cells are written as JSON text; booleans are
written as ``true``/``false``; nulls as ``-``. Executors write the part files directly: nothing
passes through the driver.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The TSV layout of result files and the merged file's name prefix.
NULL_TEXT = "-"
SEPARATOR = "\t"
COMBINED_PREFIX = "MMC_all_families_variants_"


def output_name(basename: str, studies: Sequence[str], run_date: _dt.date | None = None, suffix: str = ".tsv.gz"
                ) -> str:
    """``<yyyy-mm-dd>_<basename>_<study>[_<study>...]<suffix>``."""
    day = (run_date or _dt.date.today()).isoformat()
    return f"{day}_{basename}_{'_'.join(studies)}{suffix}"


def combined_name(run_date: _dt.date | None = None, prefix: str = COMBINED_PREFIX) -> str:
    """A9 for the merged file: ``<prefix><yyyy-mm-dd>.tsv``."""
    return f"{prefix}{(run_date or _dt.date.today()).isoformat()}.tsv"


def printable(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text; every other column unchanged."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_tsv(df: DataFrame, path: str, compression: str = "gzip", single_file: bool = False,
              quote: bool = True, mode: str = "overwrite", order: Sequence[Column] | None = None) -> None:
    """A7 (gzip) / A8 (``compression='none'``, ``quote=False``): header, tab separated, nulls as ``-``.

    With ``order`` the rows are written as range-ordered part files (``part-00000`` first); without it
    the frame's own order is kept. ``single_file`` joins these part files to one file at ``path``: all tasks write, and
    the file system puts the parts together (see ``join_files``). A text that is just ``-`` reads back as null.
    """
    out = printable(df.orderBy(*order) if order else df)
    if not single_file:
        _writer(out, compression, quote, header=True).mode(mode).csv(path)
        return
    spark = df.sparkSession
    fs, target = _file_system(spark, path)
    if fs.exists(target):
        if mode != "overwrite":
            raise FileExistsError(path)
        fs.delete(target, True)
    staging = f"{path.rstrip('/')}.parts-{uuid.uuid4().hex}"
    names = spark.createDataFrame([tuple(out.columns)], ", ".join(f"c{k} string" for k in range(len(out.columns))))
    try:
        # the header is a file of its own, so that no part has one
        _writer(names.coalesce(1), compression, quote, header=False).csv(f"{staging}/header")
        _writer(out, compression, quote, header=False).csv(f"{staging}/rows")
        join_files(spark, path, part_files(spark, f"{staging}/header") + part_files(spark, f"{staging}/rows"))
    finally:
        fs.delete(_file_system(spark, staging)[1], True)


def write_clustered(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None,
                    mode: str = "errorifexists") -> DataFrame:
    """A genotype (or annotation) table laid out for repeated joins: ``buckets`` files by the hash of ``keys``, each
    sorted by them. Returns the table.

    A join on exactly these keys then reads it without an exchange: only the other side is shuffled, to the same number
    of partitions. Rows are dealt out once before they are written, so a bucket is one file; a key with very many rows
    stays in one bucket (use the plain layout for such tables: its joins split a hot key).
    """
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).mode(mode).format("parquet")
    writer = writer.option("path", path) if path else writer
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def bucket_count(df: DataFrame, rows_per_bucket: int = 1 << 20, least: int = 8) -> int:
    """Buckets for ``write_clustered``: a power of two, so that a bucket (which one task sorts) has about
    ``rows_per_bucket`` rows or fewer however large the table is, as far as no key has more by itself."""
    buckets = least
    rows = df.count()
    while buckets * rows_per_bucket < rows:
        buckets *= 2
    return buckets


def _writer(out: DataFrame, compression: str, quote: bool, header: bool) -> DataFrameWriter:
    writer = (out.write.option("sep", SEPARATOR).option("header", header)
              .option("nullValue", NULL_TEXT).option("emptyValue", "").option("compression", compression))
    if quote:
        # RFC 4180 quoting (inner quotes doubled), as pandas and R read it.
        return writer.option("quote", '"').option("escape", '"')
    return writer.option("quote", "").option("escape", "")


def _file_system(spark: SparkSession, path: str):
    """(file system, path) of Spark's own file layer."""
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def part_files(spark: SparkSession, folder: str) -> list[str]:
    """The part files of a written folder, by part number (names only; no contents are read)."""
    fs, where = _file_system(spark, folder)
    found = [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(where) if s.getLen() > 0]
    return [path for name, path in sorted(found) if name.startswith("part-")]


def join_files(spark: SparkSession, path: str, parts: Sequence[str]) -> None:
    """One file from ordered parts, by the file system's own concatenation; the parts may be used up.

    On HDFS this only relinks blocks. Gzip parts stay members of one gzip file, which readers take as one text. A
    file system that cannot join files (most object stores) is an error: use ordered part files there.
    """
    fs, target = _file_system(spark, path)
    sc = spark.sparkContext
    jvm_path = sc._jvm.org.apache.hadoop.fs.Path
    files = [jvm_path(p) for p in parts]
    if "Local" in fs.getClass().getSimpleName():
        # the plain local layer writes the sources one after the other to the target
        fs, rest = fs.getRawFileSystem(), files
    else:
        fs.rename(files[0], target)
        rest = files[1:]
    if not rest:
        return
    array = sc._gateway.new_array(jvm_path, len(rest))
    for k, file in enumerate(rest):
        array[k] = file
    try:
        fs.concat(target, array)
    except (Py4JJavaError, CapturedException) as e:
        raise OSError(f"the file system of {path!r} cannot join part files; write ordered part files instead") from e
