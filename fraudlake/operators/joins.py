"""Joins of transactions with side tables."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..session import materialize
from . import keyfilter


def duplicate_keys(df: DataFrame, key: str = C.KEY) -> DataFrame:
    """Keys that occur more than once (pre-aggregated before the shuffle)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def attach_identity(txn: DataFrame, identity: DataFrame | None, key: str = C.KEY,
                    check: bool = True) -> DataFrame:
    """Left join that keeps every transaction once. Without an identity table the
    transactions pass through. A repeated identity key would multiply rows, so it
    is an error; looking for one is cheaper than counting the join."""
    if identity is None:
        return txn
    if check and not duplicate_keys(identity.where(F.col(key).isNotNull()), key).isEmpty():
        raise RuntimeError(f"the join would change the row count: {key} repeats on the right side")
    return txn.join(identity, key, "left")


def row_bytes(df: DataFrame, columns: list[str] | None = None) -> Column:
    """About how many bytes a row of these columns takes in a broadcast table: 48 for the row
    and its place in the hash table, 8 a number, 16 and the length for anything else."""
    def one(f):
        if isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            return F.lit(8)
        c = F.col(f.name)
        plain = c if isinstance(f.dataType, (T.StringType, T.BinaryType)) else c.cast("string")
        return F.coalesce(F.octet_length(plain), F.lit(0)) + 16

    return sum((one(df.schema[c]) for c in columns or df.columns), F.lit(48)).cast("long")


def fits(n_rows: int | None, n_bytes: int | None) -> bool:
    return (n_rows or 0) <= C.BROADCAST_ROWS and (n_bytes or 0) <= C.BROADCAST_BYTES


def fits_broadcast(table: DataFrame) -> bool:
    """Whether the table stays within the rows and the bytes of a broadcast."""
    return fits(*table.agg(F.count(F.lit(1)), F.sum(row_bytes(table))).first())


def lookup(left: DataFrame, table: DataFrame, on: list[str], small: bool | None = None) -> DataFrame:
    """Left join to a table with one row per key; null keys match null keys.

    A table of checked size (rows and bytes) is broadcast. A larger one is written once and
    shuffled. Then rows whose key a filter of the table's keys rules out get their nulls without
    a shuffle, where they are more than a tenth of all. A key that holds a large part of the
    other rows must not end in one task: the hot keys (at most ``HOT_KEY_SHARE`` of them, found
    by a pre-aggregated count) get their values by a broadcast join, and their rows are spread
    over the shuffle partitions of the second join, where they match nothing. ``left`` is read
    more than once, so it must give the same rows each time.
    """
    values = [c for c in table.columns if c not in on]
    if small is None:
        small = fits_broadcast(table)
    if small:
        right = F.broadcast(_side(table, on, values))
        return left.join(right, _same(left, right, on), "left").drop(*["_k_" + c for c in on])

    if not hasattr(table, "written_to"):
        table = materialize(table)
    per_key = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    types = keyfilter.common_types(left, table, on)
    words = types and keyfilter.words_for(table.count())
    rows, unseen = None, 0
    if words:
        keys = materialize(keyfilter.build(table, on, types, words))
        per_key = keyfilter.mark(per_key, on, types, words, keys)
        rows, unseen = per_key.agg(F.sum("_n"), F.sum(F.when(~F.col("_may"), F.col("_n")))).first()
        per_key = per_key.where("_may").drop("_may")
    else:
        rows = per_key.agg(F.sum("_n")).first()[0]
    rows, unseen = rows or 0, unseen or 0
    if unseen * C.UNSEEN_SHARE <= rows:
        return _shuffled(left, table, on, values, per_key, rows)
    marked = keyfilter.mark(left, on, types, words, keys)
    seen = _shuffled(marked.where("_may").drop("_may"), table, on, values, per_key, rows - unseen)
    rest = marked.where("not _may").select(
        *left.columns, *[F.lit(None).cast(table.schema[v].dataType).alias(v) for v in values])
    return seen.unionByName(rest)


def _side(table: DataFrame, on: list[str], values: list[str]) -> DataFrame:
    return table.select(*[F.col(c).alias("_k_" + c) for c in on], *values)


def _same(left: DataFrame, right: DataFrame, on: list[str]) -> Column:
    return reduce(Column.__and__, [left[c].eqNullSafe(right["_k_" + c]) for c in on])


def _shuffled(left: DataFrame, table: DataFrame, on: list[str], values: list[str], per_key: DataFrame,
              n_rows: int) -> DataFrame:
    right = _side(table, on, values)
    hot = per_key.where(F.col("_n") > max(1, n_rows // C.HOT_KEY_SHARE)).drop("_n")
    hot_values = F.broadcast(hot.join(right, _same(hot, right, on), "left").select(
        *[F.col(c).alias("_k_" + c) for c in on],
        *[F.col(v).alias("_hot_" + v) for v in values], F.lit(True).alias("_is_hot")))
    tagged = left.join(hot_values, _same(left, hot_values, on), "left").drop(*["_k_" + c for c in on])
    tagged = tagged.withColumn(
        "_salt", F.when(F.col("_is_hot"), F.xxhash64(*left.columns)).otherwise(F.lit(0)))
    cold = right.withColumn("_cold", F.lit(0).cast("long"))
    joined = tagged.join(cold, _same(tagged, cold, on) & (tagged["_salt"] == cold["_cold"]), "left")
    return joined.select(
        *left.columns,
        *[F.when(F.col("_is_hot"), F.col("_hot_" + v)).otherwise(F.col(v)).alias(v) for v in values])


def coverage(df: DataFrame, side_columns: list[str]) -> DataFrame:
    """How many rows found no partner, and how empty the partner columns are."""
    rows = F.count(F.lit(1))
    lacking = F.count_if(F.col(side_columns[0]).isNull())
    nulls = [F.count_if(F.col(c).isNull()) for c in side_columns]
    mean = sum(n / rows for n in nulls) / len(side_columns)
    return df.agg(
        rows.alias("n_rows"),
        lacking.alias("rows_without_partner"),
        (lacking * 100 / rows).alias("pct_without_partner"),
        (mean * 100).alias("mean_missing_pct"),
        F.lit(len(side_columns)).cast("long").alias("n_side_columns"),
    )


def inner_join_loss(txn: DataFrame, identity: DataFrame, key: str = C.KEY) -> DataFrame:
    """Rows an inner join would discard. One pass over a left join to the distinct
    right keys gives both numbers."""
    known = identity.select(key).distinct().withColumn("_known", F.lit(1))
    return txn.select(key).join(known, key, "left").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("_known").isNull()).alias("lost_rows"),
        (F.count_if(F.col("_known").isNull()) * 100 / F.count(F.lit(1))).alias("lost_pct"),
    )


def stack_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test")), allowMissingColumns=True)


def column_overlap(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Every column of either table, where it occurs and how many values it holds."""
    from ..sources.schema import tidy

    names = sorted({*reference.columns, *current.columns})

    def counts(df, tag):
        have = df.agg(*[
            (F.count(c) if c in df.columns else F.lit(None).cast("long")).alias(f"n{i}")
            for i, c in enumerate(names)])
        return tidy(have, [[c, c in df.columns, f"$n{i}"] for i, c in enumerate(names)],
                    ["feature", "in_" + tag, "values_" + tag])

    both = counts(reference, "reference").join(counts(current, "current"), "feature")
    return both.withColumn(
        "status",
        F.when(F.col("in_reference") & F.col("in_current"), "common")
        .when(F.col("in_reference"), "missing").otherwise("extra"))
