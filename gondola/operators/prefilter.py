"""A Bloom filter of wanted keys, tested at the scan.

A semi-join of wide rows with a list too long to broadcast sends every row through a shuffle, wanted or not. The
filter is a bitmap of bounded size that every task holds: rows it refuses are certainly not wanted and end where they
are read. Those it lets through, some of them by chance, still meet the exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gondola.functions.columns import as_col

HASHES = 3
BITS_PER_KEY = 16
#: A bitmap of 8 MB; with more keys than this allows for, more rows pass by chance
MOST_BITS_LOG2 = 26
_WORD_LOG2 = 6


def _places(key: Column, bits_log2: int) -> list[Column]:
    return [F.xxhash64(key, F.lit(j)).bitwiseAND(F.lit((1 << bits_log2) - 1)) for j in range(HASHES)]


def bitmap(keys: DataFrame, column: str, bits_log2: int) -> DataFrame:
    """One row: the bits of all keys, as an array of longs. Words are summed up before the shuffle."""
    place = F.explode(F.array(*_places(F.col(column), bits_log2)))
    word = F.shiftright("place", _WORD_LOG2)
    bit = F.expr(f"shiftleft(1L, CAST(place & {(1 << _WORD_LOG2) - 1} AS INT))")
    words = keys.select(place.alias("place")).groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    # as many rows as the bitmap has words, whatever the number of keys
    every = keys.sparkSession.range(1 << (bits_log2 - _WORD_LOG2)).withColumnRenamed("id", "word")
    filled = every.join(words, "word", "left").select("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    whole = filled.agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words"))
    return whole.select(F.transform("words", lambda w: w["bits"]).alias("bitmap"))


def may_be_in(key: Column | str, keys: DataFrame, column: str) -> Column:
    """False only for keys that the written table ``keys`` does not have. A null key is not in it."""
    n = max(1, keys.count())
    bits_log2 = min(MOST_BITS_LOG2, max(12, (n * BITS_PER_KEY - 1).bit_length()))
    bits = bitmap(keys, column, bits_log2).scalar()
    result = as_col(key).isNotNull()
    for place in _places(as_col(key), bits_log2):
        word = F.get(bits, F.shiftright(place, _WORD_LOG2).cast("int"))
        at = place.bitwiseAND(F.lit((1 << _WORD_LOG2) - 1)).cast("int")
        result = result & (F.call_function("shiftright", word, at).bitwiseAND(F.lit(1)) == 1)
    return result


def only_wanted(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` is in the written table ``keys``, which has one such column."""
    return rows.filter(may_be_in(column, keys, column)).join(keys, column, "left_semi")
