"""Type-aware flag predicates.

The reference compares flags written either as booleans or as strings with ``== 'true'`` /
``== 'false'`` and integer flags with ``== 1``. These helpers build the comparison that matches
the column's actual type, so the predicate stays a plain column comparison that the Parquet
reader can push down, and stays valid under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def equals_bool_text(df: DataFrame, name: str, value: bool) -> Column:
    """``name == 'true'`` / ``== 'false'``: boolean columns compare to the boolean, others as text."""
    if isinstance(_dtype(df, name), T.BooleanType):
        return F.col(name) == F.lit(value)
    return F.col(name).cast("string") == F.lit("true" if value else "false")


# Fixed value: text that reads as the integer 1 (optional '+', leading zeros, optional fraction).
INTEGER_ONE_TEXT = r"^\s*\+?0*1(\.[0-9]*)?\s*$"


def equals_one(df: DataFrame, name: str) -> Column:
    """``name == 1`` for integral, boolean or textual flags (text is read as an integer)."""
    dt = _dtype(df, name)
    if isinstance(dt, T.BooleanType):
        return F.col(name) == F.lit(True)
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(name) == F.lit(1)
    if isinstance(dt, T.StringType):
        return F.col(name).rlike(INTEGER_ONE_TEXT)
    return F.col(name).try_cast("double") == F.lit(1.0)
