"""Rows that a join would drop, left out before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Words of 64 bits of a filter, so it has 2 MB at most, whatever it is made of.
WORDS = 1 << 17


def _word(key: str) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(WORDS - 1)).alias("_word")


def _bit(key: str) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(F.xxhash64(key), 58).cast("int"))


def likely(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """All `rows` whose long `key` is among the keys of `wanted`, and some others: an exact join must follow.

    Each wanted key sets one of 64 * WORDS bits. So of few keys a few thousandths of the other rows stay, of a million
    an eighth, and of very many all; the filter never grows, and a row that is wanted is never lost.
    """
    bits = wanted.select(_word(key), _bit(key).alias("bit")).groupBy("_word").agg(F.bit_or("bit").alias("_bits"))
    found = rows.withColumn("_word", _word(key)).join(F.broadcast(bits), "_word")
    return found.where(F.col("_bits").bitwiseAND(_bit(key)) != 0).select(*rows.columns)
