"""A large table of rows by key, narrowed to the keys that are due before anything is shuffled.

The due keys' hashes set bits of a filter (one hash function, BITS_PER_KEY bits for a key), which is summed by words and
broadcast; a large row's word is joined by a hash join on the map side, so that rows whose bit isn't set go without a shuffle. Of
keys that aren't due about one in BITS_PER_KEY stays; the exact join that follows drops it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
MOST_BITS = 1 << 24  # 2**18 words, of 16 bytes each in a broadcast; with more keys than bits the filter would hold nothing back


def _places(key: Column, bits: int) -> tuple[Column, Column]:
    """(word, bit) of a key."""
    at = F.pmod(F.xxhash64(key, F.lit("filter")), F.lit(bits))
    return F.shiftright(at, 6), F.pmod(at, F.lit(64)).cast("int")


def filter_words(due: DataFrame, key: str, bits: int) -> DataFrame:
    """(word, set): the words of the filter that have a bit set; at most bits / 64 rows."""
    word, bit = _places(F.col(key), bits)
    one = F.expr("shiftleft(1L, bit)")
    return due.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or(one).alias("set"))


def narrowed(table: DataFrame, due: DataFrame, key: str, keys: int | None = None) -> DataFrame:
    """The rows of table whose key may be among due's: all that are, and few others. keys is the number of rows of due, if known; due, a
    stored table, is read for it else. With very many due keys the table stays as it is."""
    keys = due.count() if keys is None else keys
    if not keys:
        return table.limit(0)
    if keys * 2 > MOST_BITS:
        return table
    bits = min(MOST_BITS, max(64, 1 << (keys * BITS_PER_KEY - 1).bit_length()))
    word, bit = _places(F.col(key), bits)
    marked = table.withColumns({"_word": word, "_bit": bit})
    words = filter_words(due, key, bits).select(F.col("word").alias("_at"), F.col("set").alias("_set"))
    hit = (F.col("_word") == F.col("_at")) & (F.expr("shiftright(`_set`, `_bit`) & 1") == 1)
    return marked.join(F.broadcast(words), hit, "left_semi").drop("_word", "_bit")
