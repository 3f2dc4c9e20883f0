"""Result orderings (F1, F2), the unions of result tables (F3, F4) and a distributed rank."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varsift.functions import expressions as X

# Sort columns after the chromosome and the position.
RESULT_TIE_COLUMNS = ("study_code", "family_id", "is_proband")
# Columns that tell rows apart within one sort key; appended so that a key holding very many rows
# can still be split over several range partitions (the original leaves the order of ties open).
ROW_TIE_BREAKERS = ("participant_id", "biospecimen_id")


@dataclass(frozen=True)
class SortKey:
    """One ascending sort key: a value expression and where its nulls go."""

    expr: Column
    nulls_first: bool

    def column(self) -> Column:
        return self.expr.asc_nulls_first() if self.nulls_first else self.expr.asc_nulls_last()


def result_keys(tie_columns: Sequence[str] = RESULT_TIE_COLUMNS) -> list[SortKey]:
    """chromosome sort key, start, then the tie columns, ascending with nulls first."""
    exprs = [X.chromosome_sort_key("chromosome"), F.col("start")] + [F.col(c) for c in tie_columns]
    return [SortKey(e, True) for e in exprs]


def combined_keys(tie_columns: Sequence[str]) -> list[SortKey]:
    """chromosome rank over ``1..22, X, Y``, start, tie columns; missing values last."""
    exprs = [X.chromosome_rank("chromosome"), F.col("start")] + [F.col(c) for c in tie_columns]
    return [SortKey(e, False) for e in exprs]


def result_order(tie_columns: Sequence[str] = RESULT_TIE_COLUMNS) -> list[Column]:
    return [k.column() for k in result_keys(tie_columns)]


def with_tie_breakers(df: DataFrame, order: list[Column], nulls_first: bool = True) -> list[Column]:
    """``order`` plus row-identifying columns present in ``df`` and a hash of the whole row, so
    range partitioning can split a sort key shared by very many rows."""
    extra = [F.col(c) for c in ROW_TIE_BREAKERS if c in df.columns] + [F.xxhash64(*[F.col(c) for c in df.columns])]
    return order + [e.asc_nulls_first() if nulls_first else e.asc_nulls_last() for e in extra]


def check_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """A sort column that the frame lacks is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"sort columns not in the results: {missing}")


def result_row_order(df: DataFrame, tie_columns: Sequence[str] = RESULT_TIE_COLUMNS) -> list[Column]:
    """F1 with row tie-breakers, for a global sort."""
    check_columns(df, tie_columns)
    return with_tie_breakers(df, result_order(tie_columns))


def sort_result(df: DataFrame, tie_columns: Sequence[str] = RESULT_TIE_COLUMNS) -> DataFrame:
    """F1 globally sorted (range partitioned; part files are in order)."""
    return df.orderBy(*result_row_order(df, tie_columns))


def combined_row_order(df: DataFrame, tie_columns: Sequence[str]) -> list[Column]:
    """F2 with row tie-breakers, for a global sort."""
    check_columns(df, tie_columns)
    return with_tie_breakers(df, [k.column() for k in combined_keys(tie_columns)], nulls_first=False)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Row-bind by column name; columns missing in a frame are null; order of first appearance."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def global_rank(df: DataFrame, keys: Sequence[SortKey], name: str = "rank") -> DataFrame:
    """SQL ``rank()`` over ascending ``keys``, computed without a single-partition window.

    Rows are first counted per distinct key (map-side partial aggregation, so a key holding a third
    of the rows becomes one row). The distinct keys are range-partitioned and checkpointed to the
    session's checkpoint folder (so the partition ids are stable), each partition is shifted by the
    row counts of the partitions before it (one row per partition is gathered), and the rank of a
    key is 1 + the number of rows with a smaller key. Ranks are joined back with a null-safe
    equi-join, where AQE splits a hot key on the row side.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    keyed = df.select("*", *[k.expr.alias(n) for k, n in zip(keys, names)])
    key_order = [SortKey(F.col(n), k.nulls_first).column() for k, n in zip(keys, names)]
    counts = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    sorted_keys = counts.orderBy(*key_order).checkpoint(eager=True).withColumn("__part", F.spark_partition_id())
    per_part = sorted_keys.groupBy("__part").agg(F.sum("__n").alias("__pn"))
    offsets = per_part.select(
        "__part",
        F.sum("__pn").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)).alias("__off"))
    before = F.sum("__n").over(
        Window.partitionBy("__part").orderBy(*key_order).rowsBetween(Window.unboundedPreceding, -1))
    ranked = (sorted_keys.withColumn("__before", F.coalesce(before, F.lit(0)))
              .join(F.broadcast(offsets), "__part")
              .select(*names, (F.coalesce("__off", F.lit(0)) + F.col("__before") + 1).cast("long").alias(name)))
    cond = [keyed[n].eqNullSafe(ranked[n]) for n in names]
    return keyed.join(ranked, cond, "inner").select(*df.columns, name)
