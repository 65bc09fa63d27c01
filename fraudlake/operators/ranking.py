"""Select the first k rows of a total order as a plain predicate.

A global sort or an unpartitioned ``row_number`` would send the table through
one task. Here the cut value is found by counting: every pass aggregates the
keys into at most 4,096 buckets (combined map-side), keeps the bucket that
holds rank k and narrows it, until the bucket holds few rows; their values are
then counted one by one. The result is a filter with literals, so the wide rows
are neither sorted nor shuffled.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 12


def _kth_value(df: DataFrame, x: Column, k: int, lo: int, hi: int):
    """Value at 1-based rank k, k's rank among the rows equal to it, their number."""
    rows = None
    while True:
        shift = max(0, (hi - lo).bit_length() - _BITS)
        if rows is not None and rows <= 2 ** _BITS:
            shift = 0  # few rows left: every value is its own bucket
        inside = df.where((x >= lo) & (x <= hi))
        counts = inside.groupBy(F.shiftright(x - F.lit(lo), shift).alias("b")).count()
        for b, n in sorted((r[0], r[1]) for r in counts.collect()):  # at most 2**_BITS rows
            if k <= n:
                break
            k -= n
        lo, hi, rows = lo + (b << shift), min(hi, lo + ((b + 1) << shift) - 1), n
        if lo == hi:
            return lo, k, n


def first_k(df: DataFrame, keys: list[Column], k: int | Callable[[int], int]) -> Column:
    """Predicate that holds for exactly the first ``k`` rows when ordered by
    ``keys`` (integral columns, nulls last). ``k`` may be a function of the number
    of rows. The keys together must be unique around the cut, otherwise "the first
    k rows" is not defined."""
    if not keys:
        raise ValueError("the sort keys do not identify rows; add a unique key")
    x, rest = keys[0].cast("long"), keys[1:]
    total, present, lo, hi = df.agg(F.count(F.lit(1)), F.count(x), F.min(x), F.max(x)).first()
    if callable(k):
        k = k(total)
    if k <= 0:
        return F.lit(False)
    if k >= total:
        return F.lit(True)
    if k == present:
        return x.isNotNull()
    if k > present:
        return x.isNotNull() | first_k(df.where(x.isNull()), rest, k - present)
    value, rank, ties = _kth_value(df, x, k, lo, hi)
    if rank == ties:
        pick = x <= value
    else:
        pick = (x < value) | ((x == value) & first_k(df.where(x == value), rest, rank))
    return F.coalesce(pick, F.lit(False))


def hash_key(seed: int, *cols) -> Column:
    """Non-negative 63-bit hash of the columns: a random order that does not
    depend on partitioning and is the same on every run."""
    return F.shiftrightunsigned(F.xxhash64(*cols, F.lit(seed)), 1)


def hash_sample(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement."""
    return df.where(first_k(df.select(key), [hash_key(seed, key), F.col(key)], n))
