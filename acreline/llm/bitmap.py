"""A bitmap of key hashes, small enough to be broadcast whatever the number of keys.

It has BITS bits, in words of 64, so at most BITS / 64 rows. Few keys leave
most rows of a large table out before it is exchanged; many keys fill the
bitmap, and the rows then go through as if there were none. Never a key is
missed, so the result of what follows is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24


def _word(h: Column) -> Column:
    return F.shiftright(F.pmod(h, F.lit(BITS)), 6)


def _bit(h: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(h, F.lit(64)).cast("int"))


def bitmap(keys: DataFrame, h: Column) -> DataFrame:
    """``_word, _bits`` of the hashes ``h`` of keys."""
    return keys.select(_word(h).alias("_word"), _bit(h).alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))


def marked(rows: DataFrame, bits: DataFrame, h: Column, name: str = "_may") -> DataFrame:
    """rows with a boolean: false only where no key has the row's hash."""
    known = F.broadcast(bits)  # at most BITS / 64 rows of two longs
    met = rows.withColumn("_at", _word(h)).join(known, F.col("_at") == F.col("_word"), "left")
    return met.withColumn(name, F.coalesce(F.col("_bits").bitwiseAND(_bit(h)) != 0, F.lit(False))).drop("_at", "_word", "_bits")
