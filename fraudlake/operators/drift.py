"""Drift between a reference and a current table."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions.expressions import half_even, right_closed_bin, share
from ..sources.schema import tidy_by_chunks
from .joins import column_overlap
from .prefix import BIN, range_splits, running_totals, with_ranges
from .quantiles import exact_quantiles

PSI_FLOOR = 1e-4
PSI_BINS = 10
WASSERSTEIN_LIMIT = 0.1
PSI_LIMIT = 0.1


def numeric_columns(df: DataFrame, skip: tuple = (C.TARGET,)) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def common_numeric(reference: DataFrame, current: DataFrame) -> list[str]:
    other = set(numeric_columns(current))
    return [c for c in numeric_columns(reference) if c in other]


def moments(df: DataFrame, columns: list[str], by: list | None = None) -> DataFrame:
    """(feature, n, mean, std) of every column, per group if asked."""
    if by:
        stats = [a for i, c in enumerate(columns) for a in (
            F.count(c).alias(f"n{i}"), F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"))]
        got = df.groupBy(*by).agg(*stats)
        structs = [F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"),
                            F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"))
                   for i, c in enumerate(columns)]
        return got.select(*got.columns[:len(by)], F.inline(F.array(*structs)))
    return tidy_by_chunks(df, columns, ["feature", "n", "mean", "std"],
                          lambda c: [F.count(c), F.avg(c), F.stddev_samp(c)], C.AGG_CHUNK // 3)


def shift_columns(cur_mean, ref_mean, ref_std, ref_n) -> dict[str, Column]:
    """Mean shift in reference standard deviations. A column without values counts
    as mean 0 with standard deviation 1."""
    ref_mean, cur_mean = F.coalesce(ref_mean, F.lit(0.0)), F.coalesce(cur_mean, F.lit(0.0))
    std = F.when(ref_n == 0, F.lit(1.0)).otherwise(ref_std)
    change = F.abs(cur_mean - ref_mean) / F.greatest(std, F.lit(C.STD_FLOOR))
    return {
        "ref_mean": half_even(ref_mean, 4), "cur_mean": half_even(cur_mean, 4),
        "change_std": half_even(change, 4),
        "drifted": F.coalesce(change > C.MEAN_SHIFT_LIMIT, F.lit(False)),
    }


def mean_shift(reference: DataFrame, current: DataFrame, columns: list[str] | None = None,
               known: DataFrame | None = None) -> DataFrame:
    """One row per common numeric feature. ``known``: the reference's moments, if they are at hand."""
    columns = columns or common_numeric(reference, current)
    r = (moments(reference, columns) if known is None else known).select(
        "feature", F.col("n").alias("rn"), F.col("mean").alias("rm"), F.col("std").alias("rs"))
    both = moments(current, columns).join(F.broadcast(r), "feature")  # one row per feature
    return both.select("feature", *[e.alias(n) for n, e in shift_columns(
        F.col("mean"), F.col("rm"), F.col("rs"), F.col("rn")).items()])


def drift_summary(per_feature: DataFrame, flag: str = "drifted") -> DataFrame:
    n, d = F.count(F.lit(1)), F.count_if(F.col(flag))
    exact = share(d, F.greatest(n, F.lit(1)))
    return per_feature.agg(
        n.alias("number_of_features"), d.alias("number_of_drifted_features"),
        half_even(exact, 4).alias("drift_share"),
        (exact > C.DRIFT_SHARE_LIMIT).alias("drift_detected"))


def missing_column_report(reference: DataFrame, current: DataFrame) -> DataFrame:
    return column_overlap(reference, current).where(F.col("status") != "common")


def scenario_table(reference: DataFrame, scenarios: dict[str, DataFrame]) -> DataFrame:
    """One summary row per scenario, with the sizes compared. The reference's moments are taken once,
    a row for each feature, and serve all scenarios."""
    ref_rows = reference.count()
    names = sorted({c for cur in scenarios.values() for c in common_numeric(reference, cur)})
    found = moments(reference, names).select("feature", "n", "mean", "std")
    known = reference.sparkSession.createDataFrame(found.collect(), found.schema)
    rows = [
        drift_summary(mean_shift(reference, cur, known=known)).select(
            F.lit(name).alias("scenario"), F.lit("mean_shift").alias("method"), "*",
            F.lit(ref_rows).cast("long").alias("reference_rows"),
            F.lit(cur.count()).cast("long").alias("current_rows"))
        for name, cur in scenarios.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _sides(reference: DataFrame, current: DataFrame, columns: list[str], kind: str) -> DataFrame:
    def part(df, r):
        return df.select(*[F.col(c).cast(kind).alias(c) for c in columns],
                         F.lit(r).cast("long").alias("_r"), F.lit(1 - r).cast("long").alias("_c"))
    return part(reference, 1).unionByName(part(current, 0))


def wasserstein(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """First Wasserstein distance per feature: the area between the two empirical
    distribution functions. Equal values are counted before anything is ordered,
    and the running counts are two-level, so no feature is sorted in one task.

    One row per column asked for. ``status`` is ``lost`` if only one side has values and
    ``empty`` if neither has; the distance is null then."""
    sides = _sides(reference, current, columns, "double")
    counts = value_counts(sides, columns, range_splits(sides, columns), r=F.sum("_r"), c=F.sum("_c"))
    return distances(counts, each_column(reference, columns))


def value_counts(df: DataFrame, columns: list[str], splits: dict, **sums: Column) -> DataFrame:
    """(feature, range, x) with the sums: a row per value of a column, counted before anything moves."""
    values = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c + BIN).alias(BIN),
                                F.col(c).alias("x")) for c in columns])
    kept = [c for c in df.columns if c in ("_r", "_c")]
    return (with_ranges(df, splits).select(F.inline(values), *kept).where("x IS NOT NULL")
            .groupBy("feature", BIN, "x").agg(*[e.alias(n) for n, e in sums.items()]))


def distances(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """``wasserstein`` from value counts: r and c of a (feature, range, x)."""
    run = running_totals(counts, "x", {"r": "run_r", "c": "run_c"}, ["feature"], BIN)
    gap = F.abs(F.try_divide(F.col("run_r"), F.col("run_r_total"))
                - F.try_divide(F.col("run_c"), F.col("run_c_total")))
    found = run.groupBy("feature").agg(
        F.coalesce(F.sum(gap * (F.col("next_value") - F.col("x"))), F.lit(0.0)).alias("distance"),
        F.max("run_r_total").alias("r"), F.max("run_c_total").alias("c"))
    status = (F.when((F.col("r") > 0) & (F.col("c") > 0), "ok")
              .when((F.col("r") > 0) | (F.col("c") > 0), "lost").otherwise("empty"))
    return asked.join(F.broadcast(found), "feature", "left").select(
        "feature", F.when(status == "ok", F.col("distance")).alias("distance"), status.alias("status"))


def each_column(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row per column asked for, so that none is missing from a report."""
    return df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")


def psi_of(cells: DataFrame, floor: float) -> DataFrame:
    """cells: (feature, cell, r, c) counts."""
    totals = cells.groupBy("feature").agg(F.sum("r").alias("nr"), F.sum("c").alias("nc"))
    p = F.greatest(share("r", "nr"), F.lit(floor))
    q = F.greatest(share("c", "nc"), F.lit(floor))
    return (cells.join(F.broadcast(totals), "feature")  # one row per feature
            .groupBy("feature").agg(F.sum((q - p) * F.log(q / p)).alias("psi")))


def _cells(sides: DataFrame, cell: dict[str, Column]) -> DataFrame:
    structs = F.array(*[F.struct(F.lit(c).alias("feature"), e.cast("string").alias("cell"))
                        for c, e in cell.items()])
    return (sides.select(F.inline(structs), "_r", "_c").where("cell IS NOT NULL")
            .groupBy("feature", "cell").agg(F.sum("_r").alias("r"), F.sum("_c").alias("c")))


def psi_categorical(reference: DataFrame, current: DataFrame, columns: list[str],
                    floor: float = PSI_FLOOR) -> DataFrame:
    """Population stability index over categories; an empty cell counts as ``floor``. One row per
    column asked for; the index is null if neither side has a value."""
    asked = each_column(reference, columns)
    if not columns:
        return asked.withColumn("psi", F.lit(None).cast("double"))
    sides = _sides(reference, current, columns, "string")
    found = psi_of(_cells(sides, {c: F.col(c) for c in columns}), floor)
    return asked.join(F.broadcast(found), "feature", "left")  # one row per feature


def psi_numeric(reference: DataFrame, current: DataFrame, columns: list[str],
                bins: int = PSI_BINS, floor: float = PSI_FLOOR) -> DataFrame:
    """Same over the reference's quantile bins, open at both ends. One row per column
    asked for; the index is null if the reference or the other side has no value."""
    probs = [i / bins for i in range(1, bins)]
    cuts = exact_quantiles(reference, {c: F.col(c) for c in columns}, probs)
    inf = float("inf")
    cell = {c: right_closed_bin(F.col(c), [-inf, *sorted(set(q)), inf])
            for c, q in cuts.items() if q[0] is not None}
    asked = each_column(reference, columns)
    if not cell:
        return asked.withColumn("psi", F.lit(None).cast("double"))
    cells = _cells(_sides(reference, current, list(cell), "double"), cell)
    return asked.join(F.broadcast(psi_of(cells, floor)), "feature", "left")  # one row per feature


def column_tests(reference: DataFrame, current: DataFrame, numeric: list[str],
                 categorical: list[str]) -> DataFrame:
    """One test per column: normed Wasserstein distance for numbers, stability index
    for categories. Both are distances, so drift is ABOVE the threshold. A number that
    one side has lost altogether has no distance and counts as drifted."""
    std = moments(reference, numeric).select("feature", "std")
    return verdicts(wasserstein(reference, current, numeric), std,
                    psi_categorical(reference, current, categorical))


def verdicts(distance: DataFrame, std: DataFrame, psi: DataFrame) -> DataFrame:
    """``column_tests`` from its parts: a row per column in each."""
    num = distance.join(F.broadcast(std), "feature").select(
        "feature", (F.col("distance") / F.greatest("std", F.lit(C.STD_FLOOR))).alias("value"),
        F.lit("wasserstein_normed").alias("test"), F.lit(WASSERSTEIN_LIMIT).alias("threshold"),
        (F.col("status") == "lost").alias("lost"))
    cat = psi.select(
        "feature", F.col("psi").alias("value"), F.lit("psi").alias("test"),
        F.lit(PSI_LIMIT).alias("threshold"), F.lit(False).alias("lost"))
    return num.unionByName(cat).withColumns({
        "direction": F.lit("above"), "drifted": F.col("lost") | F.coalesce(F.col("value") > F.col("threshold"), F.lit(False))}).drop("lost")


def tests_summary(tests: DataFrame) -> DataFrame:
    """How many of the column tests found drift, their share, and whether that is too many."""
    n, d = F.count(F.lit(1)), F.count_if("drifted")
    exact = share(d, F.greatest(n, F.lit(1)))
    return tests.agg(n.alias("number_of_tests"), d.alias("number_of_drifted_columns"),
                     half_even(exact, 4).alias("drift_share"), (exact > C.DRIFT_SHARE_LIMIT).alias("drift_detected"))
