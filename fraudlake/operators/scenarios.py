"""Drifted copies of a table, reproducible and independent of partitioning."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .drift import numeric_columns
from .quantiles import wide_agg
from .ranking import first_k, hash_key


def standard_normal(key, name: str, seed: int = C.SEED) -> Column:
    """One normal number per row from two hashes of the row key (Box-Muller);
    unlike ``randn`` the same on every run and partitioning."""
    def uniform(tag):  # in (0, 1)
        return (F.pmod(F.xxhash64(F.col(key), F.lit(name), F.lit(tag), F.lit(seed)),
                       F.lit(2 ** 52)).cast("double") + 0.5) / float(2 ** 52)

    return F.sqrt(-2 * F.log(uniform("radius"))) * F.cos(2 * math.pi * uniform("angle"))


def feature_drift(df: DataFrame, key: str = C.KEY, noise: float = C.NOISE_STDS,
                  n_columns: int = C.SHIFTED_COLUMNS) -> DataFrame:
    """Amounts times 1.5, then the first numeric columns move up by two standard
    deviations plus noise. The amount is one of them: it moves by the deviation it
    has after scaling. A constant column stays."""
    if C.AMOUNT in df.columns:
        df = df.withColumn(C.AMOUNT, F.col(C.AMOUNT) * C.AMOUNT_DRIFT_FACTOR)
    moved = numeric_columns(df, (C.TARGET, key))[:n_columns]
    stds = wide_agg(df, [F.stddev_samp(c) for c in moved])

    def shifted(c, std):
        out = F.col(c) + C.SHIFT_STDS * std
        return out + standard_normal(key, c) * (noise * std) if noise else out

    return df.withColumns({c: shifted(c, s) for c, s in zip(moved, stds) if s and s > 0})


def label_drift(df: DataFrame, key: str = C.KEY, share: float = C.RELABEL_SHARE,
                seed: int = C.SEED) -> DataFrame:
    """Exactly ``int(share * n)`` of the n class-0 rows become class 1."""
    legit = df.where(F.col(C.TARGET) == 0).select(key)
    flip = first_k(legit, [hash_key(seed, key), F.col(key)], lambda n: int(n * share))
    return df.withColumn(
        C.TARGET, F.when((F.col(C.TARGET) == 0) & flip, F.lit(1)).otherwise(F.col(C.TARGET)))


def lost_identity(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in C.IDENTITY_COLUMNS if c in df.columns])
