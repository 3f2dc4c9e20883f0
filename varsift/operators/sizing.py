"""Size-checked broadcasting.

A side is broadcast only after its row count has been measured and found within a bound; above
the bound the caller gets the DataFrame back unchanged and Spark (with AQE) plans a shuffle join,
splitting skewed partitions at run time.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measured:
    """A persisted DataFrame together with its measured row count."""

    df: DataFrame
    rows: int
    max_rows: int
    size: int = 0
    max_bytes: int | None = None

    def fits(self, max_rows: int | None = None) -> bool:
        return (self.rows <= (self.max_rows if max_rows is None else max_rows)
                and (self.max_bytes is None or self.size <= self.max_bytes))

    def side(self, df: DataFrame | None = None, max_rows: int | None = None) -> DataFrame:
        """``df`` (default: the measured frame) with a broadcast hint when the measurement allows it.

        ``df`` must be derived from the measured frame by projection or filtering, so that its row
        count is bounded by the measured one. ``max_rows`` overrides the bound (e.g. a lower one
        for wide rows).
        """
        target = self.df if df is None else df
        return F.broadcast(target) if self.fits(max_rows) else target

    def release(self) -> None:
        self.df.unpersist()


#: Spark's limit for the size of a generated method, and the size from which HotSpot does not compile a method but
#: interprets it for every row.
METHOD_LIMIT, COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """For plans that are made and run inside: a stage whose generated method the JVM would only interpret runs operator
    by operator instead (each with generated code of its own). A lower limit of the session stays as it is."""
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, str(min(int(before), COMPILED_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def cached_bytes(persisted: DataFrame) -> int:
    """Bytes of a persisted and materialised frame, as Spark's own statistics have them."""
    return int(str(persisted.select("*")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def measure(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> Measured:
    """Persist ``df`` (memory, spilling to disk), count it once and take its size in bytes.

    The count materialises the cache, so later plans reuse the rows instead of scanning the
    inputs again. Lost cache blocks are recomputed from lineage, so the job survives the loss
    of an executor.
    """
    persisted = df.persist(StorageLevel.MEMORY_AND_DISK)
    rows = persisted.count()
    return Measured(persisted, rows, max_rows, cached_bytes(persisted) if max_bytes is not None else 0, max_bytes)


def skew_splittable(df: DataFrame) -> DataFrame:
    """``df`` for a shuffle join in which AQE can split a hot key.

    A side that is already hash-partitioned by the join key (a cached frame, the output of an
    earlier join or aggregation) is reused as is, and AQE's skew-join rule, which only splits joins
    whose both sides it shuffled itself, then leaves a key holding a third of the other side's rows
    in one task. A rebalance of the (comparatively small) side, whose partitions AQE sizes, hands the
    partitioning back to the join. Broadcast of a side measured small at run time is unaffected.
    """
    return df.hint("rebalance")
