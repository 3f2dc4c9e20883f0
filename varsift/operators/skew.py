"""Joins that stay spread out when one key holds a large share of the rows.

A frequent-items sketch (one partial aggregate, no shuffle of the keys) names the keys that may be heavy; only their rows
are dealt out under salts, and only their partners on the other side are repeated. The sketch's answer changes the
distribution, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"
#: Heavy keys that are looked for, and items the sketch tracks: a key with more than a thousandth of the rows is found.
MOST, TRACKED = 256, 10_000


def _key(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def heavy_keys(rows: DataFrame, keys: Sequence[str], min_rows: int) -> list[int]:
    """Hashes of the keys that the sketch counts ``min_rows`` times or more (at most ``MOST``)."""
    found = rows.select(_key(keys).alias("key")).agg(F.expr(f"approx_top_k(key, {MOST}, {TRACKED})").alias("top")).first()
    return [r["item"] for r in found["top"] or [] if r["count"] >= min_rows]


def spread_join(many: DataFrame, few: DataFrame, keys: Sequence[str], heavy: Sequence[int], salts: int,
                how: str = "inner") -> DataFrame:
    """``many`` joined with ``few`` on ``keys`` (inner or left), the heavy keys' rows of ``many`` over ``salts`` tasks.

    Without heavy keys this is the plain join. Equal rows of one input partition share a salt.
    """
    if not heavy:
        return many.join(few, list(keys), how)
    hot = _key(keys).isin(list(heavy))
    row = F.xxhash64(*[F.col(f"`{c}`") for c in many.columns], F.spark_partition_id())
    dealt = many.withColumn(_SALT, F.when(hot, F.pmod(row, F.lit(salts))).otherwise(0).cast("int"))
    copies = few.withColumn(_SALT, F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.join(copies, [*keys, _SALT], how).drop(_SALT)
