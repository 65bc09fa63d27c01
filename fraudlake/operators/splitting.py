"""Temporal split and the summaries written at ingest."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.expressions import half_even
from .ranking import first_k


def split_rank(n_rows: int, test_share: float = C.TEST_SHARE) -> int:
    return int(n_rows * (1 - test_share))


def mark_split(df: DataFrame, time: str = C.TIME, key: str = C.KEY,
               test_share: float = C.TEST_SHARE) -> DataFrame:
    """Add ``split``: the earlier rows are train, the later test. Equal times are
    ordered by the key. The cut is a literal, so this is a projection."""
    earlier = first_k(df.select(time, key), [F.col(time), F.col(key)],
                      lambda n: split_rank(n, test_share))
    return df.withColumn("split", F.when(earlier, "train").otherwise("test"))


def temporal_split(df: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    marked = mark_split(df, **kw)
    return tuple(marked.where(F.col("split") == s).drop("split") for s in ("train", "test"))


def split_summary(marked: DataFrame) -> DataFrame:
    return marked.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(C.TIME).cast("long").alias("first_second"),
        F.max(C.TIME).cast("long").alias("last_second"),
        half_even(F.avg(C.TARGET), 4).alias("fraud_rate"),
    )


def ingestion_summary(txn: DataFrame, identity: DataFrame | None, merged: DataFrame) -> DataFrame:
    """One row: sizes of the inputs, of the joined table and of both splits.
    ``merged`` carries the split mark."""
    train, test = F.col("split") == "train", F.col("split") == "test"
    n_txn = txn.select(C.KEY).count()
    n_id = identity.select(C.KEY).count() if identity is not None else 0
    rows = F.count(F.lit(1))

    def whole(v):
        return F.lit(v).cast("long")

    return merged.agg(
        whole(n_txn).alias("transaction_rows"),
        whole(len(txn.columns)).alias("transaction_columns"),
        whole(n_id).alias("identity_rows"),
        whole(len(identity.columns) if identity is not None else 0).alias("identity_columns"),
        F.lit(identity is not None).alias("identity_file_used"),
        rows.alias("merged_rows"),
        whole(len(merged.columns) - 1).alias("merged_columns"),
        F.lit(C.KEY).alias("join_key"),
        F.lit("left").alias("join_type"),
        (rows == n_txn).alias("row_count_preserved"),
        F.count_if(train).alias("train_rows"),
        F.count_if(test).alias("test_rows"),
        half_even(F.avg(F.when(train, F.col(C.TARGET))), 4).alias("fraud_rate_train"),
        half_even(F.avg(F.when(test, F.col(C.TARGET))), 4).alias("fraud_rate_test"),
    )
