"""Running totals over a very long order, in two levels.

One window over the whole order would be one task. Instead the order column is
cut into value ranges of about equal size (``Bucketizer`` on sketch quantiles),
totals per range give each range its offset, and the running sum is local to a
range. The range totals are one row per range, so that join is a broadcast of
known size.
"""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import wide_agg

BIN = "_bin"


def n_ranges(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def range_splits(df: DataFrame, cols: list[str]) -> dict[str, list[float]]:
    """Cut points per column, at most one per shuffle partition. They only have to be
    roughly even, so a coarse sketch will do; results do not depend on them."""
    n = n_ranges(df)
    at = F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array(F.lit(0.5))
    got = wide_agg(df, [F.percentile_approx(F.col(c).cast("double"), at, 10 * n) for c in cols])
    inf = float("inf")
    return {c: [-inf, *sorted(set(g or [0.0])), inf] for c, g in zip(cols, got)}


def with_ranges(df: DataFrame, splits: dict[str, list[float]], suffix: str = BIN) -> DataFrame:
    """Add ``<col><suffix>`` with the value range of every listed column."""
    cols = list(splits)
    return Bucketizer(
        inputCols=cols, outputCols=[c + suffix for c in cols],
        splitsArray=[splits[c] for c in cols], handleInvalid="keep",
    ).transform(df)


def running_totals(df: DataFrame, order: str, sums: dict[str, str], by: list[str],
                   range_col: str, descending: bool = False) -> DataFrame:
    """For rows that are unique in (by, order): add running sums ``{source: name}``
    in the given order, the grand totals ``<name>_total``, and ``next_value``, the
    following order value (null at the end)."""
    def direction(c: str) -> Column:
        return F.col(c).desc() if descending else F.col(c).asc()

    over_ranges = Window.partitionBy(*by).orderBy(direction(range_col))
    before = over_ranges.rowsBetween(Window.unboundedPreceding, -1)
    whole = over_ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edge = F.max(order) if descending else F.min(order)
    ranges = df.groupBy(*by, range_col).agg(
        *[F.sum(s).alias("_s_" + s) for s in sums], edge.alias("_edge"))
    offsets = ranges.select(
        *by, range_col,
        *[F.coalesce(F.sum("_s_" + s).over(before), F.lit(0)).alias("_o_" + s) for s in sums],
        *[F.sum("_s_" + s).over(whole).alias(n + "_total") for s, n in sums.items()],
        F.lead("_edge").over(over_ranges).alias("_next_range"),
    )
    local = Window.partitionBy(*by, range_col).orderBy(direction(order))
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        df.join(F.broadcast(offsets), [*by, range_col])
        .withColumns({
            **{n: F.col("_o_" + s) + F.sum(s).over(upto) for s, n in sums.items()},
            "next_value": F.coalesce(F.lead(order).over(local), F.col("_next_range")),
        })
        .drop("_next_range", *["_o_" + s for s in sums])
    )
