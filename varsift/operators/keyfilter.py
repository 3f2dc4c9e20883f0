"""A Bloom filter of join keys as a bounded table, applied where a large table is read.

Blocked: a key's hash names one 64-bit word, four bits of which the key sets. The filter is the table of the words that
are not empty, built by one aggregate (partial ``bit_or``) and never longer than the number of words chosen, so it can be
broadcast for any number of keys; with more keys only more rows pass. A row passes if its word has its four bits: one
hash look-up, all inside generated code. No wanted row is lost; an exact join follows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD, _BITS = "__word", "__bits"
#: Bits that a key sets in its word.
BITS = 4


def _word(keys: Sequence[str], words: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(words).cast("long"))


def _mask(keys: Sequence[str]) -> Column:
    """The bits of a key, from a second hash."""
    places = F.xxhash64(F.lit(1), *[F.col(k) for k in keys])
    out = F.lit(0).cast("long")
    for k in range(BITS):
        place = F.shiftrightunsigned(places, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return out


def key_filter(rows: DataFrame, keys: Sequence[str], words: int) -> DataFrame:
    """The filter of the rows' keys: at most ``words`` rows of two numbers."""
    return rows.select(_word(keys, words).alias(_WORD), _mask(keys).alias(_BITS)).groupBy(_WORD).agg(F.bit_or(_BITS).alias(_BITS))


def passing_share(words_used: DataFrame, words: int) -> float:
    """The expected share of other keys that pass, from the filter's own bits."""
    full = F.pow(F.bit_count(_BITS) / 64, F.lit(BITS))
    return float(words_used.agg(F.coalesce(F.sum(full), F.lit(0.0))).first()[0]) / words


def keep_keys(rows: DataFrame, words_used: DataFrame, keys: Sequence[str], words: int) -> DataFrame:
    """The rows whose key may be in the filter (rows with a null in the key are as any other)."""
    columns = [F.col(f"`{c}`") for c in rows.columns]
    tagged = rows.withColumn(_WORD, _word(keys, words)).join(words_used, _WORD)
    mask = _mask(keys)
    return tagged.where(F.col(_BITS).bitwiseAND(mask) == mask).select(*columns)
