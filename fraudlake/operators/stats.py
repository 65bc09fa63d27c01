"""Outliers, correlations, histograms, box plots."""

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.expressions import class_label, share
from ..sources.schema import tidy
from .aggregates import class_series
from .quantiles import exact_quantiles, wide_agg


def iqr_outliers(df: DataFrame, columns: list[str], target: str = C.TARGET) -> DataFrame:
    """Tukey fences per column. A null value lies within the fences."""
    q = exact_quantiles(df, {c: F.col(c) for c in columns}, [0.25, 0.75])
    y, aggs, rows = F.col(target), [F.count(F.lit(1)).alias("n_rows")], []
    for i, c in enumerate(columns):
        q1, q3 = q[c]
        if q1 is None:
            lower = upper = None
            out = F.lit(False)
        else:
            lower, upper = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
            out = F.coalesce((F.col(c) < lower) | (F.col(c) > upper), F.lit(False))
        aggs += [F.count_if(out).alias(f"o{i}"), F.avg(F.when(out, y)).alias(f"ro{i}"),
                 F.avg(F.when(~out, y)).alias(f"ri{i}")]
        dbl = [F.lit(v).cast("double") for v in (q1, q3, lower, upper)]
        rows.append([c, *dbl, f"$o{i}", "$n_rows", f"$ro{i}", f"$ri{i}"])
    names = ["feature", "q1", "q3", "lower_fence", "upper_fence", "outliers", "n_rows",
             "rate_out", "rate_in"]
    return tidy(df.agg(*aggs), rows, names).select(
        "feature", "q1", "q3", "lower_fence", "upper_fence", "outliers",
        (share("outliers", "n_rows") * 100).alias("outlier_pct"),
        (F.coalesce("rate_out", F.lit(0.0)) * 100).alias("rate_outlier_pct"),
        (F.col("rate_in") * 100).alias("rate_inlier_pct"))


def correlations(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Pearson correlation of each pair over the rows where both are present.
    All pairs share few passes; the result has one row per pair."""
    def corr(a, b):  # a constant column gives NaN, reported as null
        return F.nanvl(F.corr(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(None))

    got = wide_agg(df, [corr(a, b) for a, b in pairs])
    rows = [(a, b, v) for (a, b), v in zip(pairs, got)]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, corr double")


def _pair_sums(mean, std):
    """Per Arrow batch the sums over all column pairs as four small matrix products:
    z*z, z*present, present*present, z^2*present; one row per partition."""
    def run(batches):
        total = None
        for batch in batches:
            x = (batch.to_numpy(float) - mean) / std
            here = ~np.isnan(x)
            z, p = np.where(here, x, 0.0), here.astype(float)
            part = np.stack([z.T @ z, z.T @ p, p.T @ p, (z * z).T @ p])
            total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"sums": [total.ravel()]})
    return run


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair over the rows where both are present; the
    upper triangle, as the matrix is symmetric with ones on the diagonal.

    One built-in correlation per pair means hundreds of aggregates, so many passes.
    Two passes do here: means and deviations, then the sums of the standardised
    values over all pairs at once. What reaches the driver is 4 numbers per pair."""
    d = len(columns)
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    head = wide_agg(numbers, [f(c) for f in (F.avg, F.stddev_pop) for c in columns])
    mean = np.array([m or 0.0 for m in head[:d]])
    std = np.array([s or 1.0 for s in head[d:]])
    sums = (
        numbers.mapInPandas(_pair_sums(mean, std), "sums array<double>")
        .select(F.posexplode("sums").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")))
    grid = np.zeros(4 * d * d)
    for i, v in sums.collect():
        grid[i] = v
    zz, zp, pp, qp = grid.reshape(4, d, d)
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = qp - zp * zp / pp
        r = (zz - zp * zp.T / pp) / np.sqrt(spread * spread.T)
    rows = [(a, b, float(r[i, j]) if spread[i, j] > 1e-9 and spread[j, i] > 1e-9 else None)
            for (i, a), (j, b) in combinations(enumerate(columns), 2)]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, corr double")


def corr_with_target(df: DataFrame, columns: list[str], k: int, target: str = C.TARGET) -> DataFrame:
    return (correlations(df, [(c, target) for c in columns])
            .select(F.col("feature_a").alias("feature"), "corr").where("corr IS NOT NULL")
            .orderBy(F.desc(F.abs("corr")), "feature").limit(k))


def strongest_correlations(df: DataFrame, columns: list[str], target: str = C.TARGET) -> DataFrame:
    """The columns with the highest and the lowest correlation with the target; the
    smaller name wins a tie."""
    known = (correlations(df, [(c, target) for c in columns])
             .select(F.col("feature_a").alias("feature"), "corr").where("corr IS NOT NULL"))
    high = known.orderBy(F.desc("corr"), "feature").limit(1).withColumn("direction", F.lit("positive"))
    low = known.orderBy("corr", "feature").limit(1).withColumn("direction", F.lit("negative"))
    return high.unionByName(low)


def prefix_columns(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def density_histogram(df: DataFrame, value, bins: int = 50, target: str = C.TARGET) -> DataFrame:
    """Equal-width bins per class over the class's own range, last bin closed on
    the right, heights that integrate to 1. Empty bins are left out."""
    x = df.where(F.col(target).isNotNull()).select(target, value.alias("x")).where("x IS NOT NULL")
    ends = {r[0]: (r[1], r[2], r[3]) for r in x.where(F.col(target).isin(0, 1)).groupBy(target)
            .agg(F.min("x"), F.max("x"), F.count("x")).collect()}  # one row per class

    def of(i):
        chain = F.lit(None).cast("double")
        for cls, e in ends.items():
            # a constant series gets a unit range around its value
            lo, hi = (e[0], e[1]) if e[0] < e[1] else (e[0] - 0.5, e[1] + 0.5)
            chain = F.when(F.col(target) == cls, F.lit(float((lo, hi, e[2])[i]))).otherwise(chain)
        return chain

    width = (of(1) - of(0)) / bins
    index = F.least(F.lit(bins - 1), F.floor((F.col("x") - of(0)) / width)).cast("long")
    return (
        x.where(F.col(target).isin(0, 1)).groupBy(target, index.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(target, "bin", "n", (of(0) + F.col("bin") * width).alias("left_edge"),
                (F.col("n") / (of(2) * width)).alias("density"))
        .orderBy(target, "bin")
    )


def box_plot(df: DataFrame, column: str = C.AMOUNT, cap: float = 1000.0,
             target: str = C.TARGET) -> DataFrame:
    """Per class: quartiles, whisker ends (outermost values within the fences) and
    the number of values beyond, for values up to ``cap``."""
    capped = df.where(F.col(column) <= cap)
    q = exact_quantiles(capped, class_series(column), [0.25, 0.5, 0.75])
    parts = []
    for cls, (q1, med, q3) in q.items():
        if q1 is None:
            continue
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        mine = F.when(F.col(target) == int(cls), F.col(column))
        inside = F.when((mine >= lo) & (mine <= hi), mine)
        parts.append((cls, q1, med, q3, [F.count(mine), F.min(inside), F.max(inside),
                                         F.count(mine) - F.count(inside)]))
    got = capped.agg(*[e.alias(f"a{i}_{j}") for i, p in enumerate(parts) for j, e in enumerate(p[4])])
    rows = [[int(p[0]), p[1], p[2], p[3], *[f"$a{i}_{j}" for j in range(4)]]
            for i, p in enumerate(parts)]
    names = [target, "q1", "median", "q3", "n", "whisker_low", "whisker_high", "n_beyond"]
    return tidy(got, rows, names).withColumn("label", class_label())
