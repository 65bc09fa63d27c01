"""Mergeable filter of keys: tells which rows of a large table can have no partner.

A Bloom filter in words of 64 bits: a key sets four bits of one word. The words are
kept as a table, 512 to a row, so that a filter can be written, merged with another one
of its size, and broadcast. No key is ever missed; some keys pass that are not there
(about 1 in 70 at ``BITS_PER_KEY``, every fourth at ``LEAST_BITS``).
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C

BLOCK = 512  # words in a row of the filter
BITS_PER_KEY = 16
LEAST_BITS = 4  # with fewer bits a key a filter lets too much pass to be worth its broadcast


def words_for(n_keys: int, max_bytes: int = C.FILTER_BYTES) -> int | None:
    """Words of a filter for that many keys, a power of two; None where ``max_bytes`` hold
    too few bits a key."""
    most = max(BLOCK, 1 << (max(1, max_bytes // 8).bit_length() - 1))
    wanted = 1 << max(0, (n_keys * BITS_PER_KEY + 63) // 64 - 1).bit_length()
    words = min(max(BLOCK, wanted), most)
    return words if words * 64 >= n_keys * LEAST_BITS else None


def common_types(left: DataFrame, right: DataFrame, on: list[str]) -> list[T.DataType] | None:
    """Per key column a type in which values that a join takes as equal hash alike; None
    where there is none."""
    out = []
    for c in on:
        a, b = left.schema[c].dataType, right.schema[c].dataType
        if a == b:
            out.append(a)
        elif isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
            out.append(T.DoubleType())
        else:
            return None
    return out


def _place(on: list[str], types: list[T.DataType], words: int) -> tuple[Column, Column]:
    """(word, mask) of a row's key."""
    key = F.xxhash64(*[F.col(c).cast(t) for c, t in zip(on, types)])
    bits = F.xxhash64(key)
    one = F.lit(1).cast("long")
    masks = [F.call_function("shiftleft", one, F.shiftright(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
             for i in range(4)]
    return key.bitwiseAND(F.lit(words - 1)), reduce(Column.bitwiseOR, masks)


def _packed(marks: DataFrame, words: int) -> DataFrame:
    """(_word, _mask) rows as the filter's table; every word is listed."""
    every = marks.sparkSession.range(words).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_mask"))
    merged = marks.unionByName(every).groupBy("_word").agg(F.bit_or("_mask").alias("_mask"))
    listed = F.array_sort(F.collect_list(F.struct("_word", "_mask")))  # BLOCK entries
    return (merged.groupBy(F.floor(F.col("_word") / BLOCK).alias("_block"))
            .agg(F.transform(listed, lambda s: s["_mask"]).alias("_words")))


def build(table: DataFrame, on: list[str], types: list[T.DataType], words: int) -> DataFrame:
    """The filter of the table's keys; a null is a key like any other."""
    word, mask = _place(on, types, words)
    return _packed(table.select(word.alias("_word"), mask.alias("_mask")), words)


def merge(filters: list[DataFrame], words: int) -> DataFrame:
    """The filter of all keys of filters with the same types and number of words."""
    marks = [f.select("_block", F.posexplode("_words").alias("_at", "_mask"))
             .select((F.col("_block") * BLOCK + F.col("_at")).alias("_word"), "_mask") for f in filters]
    return _packed(reduce(DataFrame.unionByName, marks), words)


def mark(df: DataFrame, on: list[str], types: list[T.DataType], words: int, keys: DataFrame,
         name: str = "_may") -> DataFrame:
    """Add whether the row's key may be among the filter's. At most ``FILTER_BYTES`` are
    broadcast, whatever the number of keys."""
    word, mask = _place(on, types, words)
    placed = df.select(*df.columns, word.alias("_word"), mask.alias("_mask"))
    hit = F.get("_words", (F.col("_word") % BLOCK).cast("int")).bitwiseAND(F.col("_mask")) == F.col("_mask")
    at = F.floor(F.col("_word") / BLOCK) == F.col("_block")
    return placed.join(F.broadcast(keys), at, "left").select(*df.columns, F.coalesce(hit, F.lit(False)).alias(name))
