"""Grouped and global summaries of transactions."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.expressions import bin_label, class_label, hour_bin, right_closed_bin
from .quantiles import exact_quantiles

def rows() -> Column:
    return F.count(F.lit(1))


def rate(target: str = C.TARGET) -> Column:
    return F.avg(F.col(target))


# ---- the five standard reports (null groups are kept, values rounded half up) ----

def rate_by(df: DataFrame, group: str, with_positives: bool = True) -> DataFrame:
    positives = [F.sum(C.TARGET).alias("fraud_count")] if with_positives else []
    return (
        df.groupBy(group)
        .agg(rows().alias("txn_count"), *positives, F.round(rate() * 100, 2).alias("fraud_rate_pct"))
        .orderBy(F.desc("fraud_rate_pct"), group)
    )


def amount_by_class(df: DataFrame) -> DataFrame:
    return df.groupBy(C.TARGET).agg(
        rows().alias("txn_count"),
        F.round(F.avg(C.AMOUNT), 2).alias("avg_amount"),
        F.round(F.min(C.AMOUNT), 2).alias("min_amount"),
        F.round(F.max(C.AMOUNT), 2).alias("max_amount"),
    )


def means_by_class(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(C.TARGET).agg(*[F.round(F.avg(c), 4).alias(c) for c in columns])


def overall(df: DataFrame) -> DataFrame:
    return df.agg(
        rows().alias("total_rows"),
        F.sum(C.TARGET).alias("total_fraud"),
        F.round(rate() * 100, 2).alias("fraud_rate_pct"),
        F.round(F.avg(C.AMOUNT), 2).alias("avg_amount"),
    )


# ---- exploratory variants (null groups are dropped, values unrounded) ----

def product_amounts(df: DataFrame, group: str = "ProductCD") -> DataFrame:
    return (
        df.where(F.col(group).isNotNull()).groupBy(group)
        .agg(F.count(C.TARGET).alias("transactions"), F.sum(C.TARGET).alias("fraud_count"),
             (rate() * 100).alias("fraud_rate_pct"), F.avg(C.AMOUNT).alias("avg_amount"),
             F.max(C.AMOUNT).alias("max_amount"))
        .orderBy(F.desc("fraud_rate_pct"), group)
    )


def class_series(column: str, target: str = C.TARGET, classes=(0, 1)) -> dict[str, Column]:
    return {str(v): F.when(F.col(target) == v, F.col(column)) for v in classes}


def class_medians(df: DataFrame, column: str = C.AMOUNT) -> tuple:
    got = exact_quantiles(df, class_series(column), [0.5])
    return got["0"][0], got["1"][0]


def per_class(values: list, target: str = C.TARGET) -> Column:
    """One literal per class 0/1."""
    return F.when(F.col(target) == 0, F.lit(values[0])).when(F.col(target) == 1, F.lit(values[1]))


def median_by_class(df: DataFrame) -> DataFrame:
    return (
        df.where(F.col(C.TARGET).isNotNull()).groupBy(C.TARGET)
        .agg(F.count(C.AMOUNT).alias("n"), F.avg(C.AMOUNT).alias("mean_amount"))
        .select(class_label().alias("label"), "n", "mean_amount",
                per_class(class_medians(df)).alias("median_amount"))
    )


def class_balance(df: DataFrame) -> DataFrame:
    """Per class count and percentage, and the ratio of class 0 to class 1."""
    counts = df.where(F.col(C.TARGET).isNotNull()).groupBy(C.TARGET).agg(rows().alias("n"))
    whole = Window.partitionBy(F.lit(0))  # two rows at this point

    def of(v):
        return F.sum(F.when(F.col(C.TARGET) == v, F.col("n"))).over(whole)

    return counts.select(
        C.TARGET, "n",
        (F.col("n") * 100 / F.sum("n").over(whole)).alias("pct"),
        F.try_divide(of(0), of(1)).alias("imbalance_ratio"),
    )


def describe_by_class(df: DataFrame, column: str = C.AMOUNT) -> DataFrame:
    probs = [0.25, 0.5, 0.75]
    q = exact_quantiles(df, class_series(column), probs)
    return (
        df.where(F.col(C.TARGET).isNotNull()).groupBy(C.TARGET)
        .agg(F.count(column).alias("n"), F.avg(column).alias("mean"),
             F.stddev_samp(column).alias("std"), F.min(column).alias("min"),
             F.max(column).alias("max"))
        .withColumns({f"q{int(p * 100)}": per_class([q["0"][i], q["1"][i]])
                      for i, p in enumerate(probs)})
    )


def median_ratio(df: DataFrame) -> DataFrame:
    legit, fraud = class_medians(df)
    return df.agg(
        F.count_if(F.col(C.TARGET) == 0).alias("n_legit"),
        F.count_if(F.col(C.TARGET) == 1).alias("n_fraud"),
    ).select(
        "n_legit", "n_fraud",
        F.lit(legit).cast("double").alias("median_legit"),
        F.lit(fraud).cast("double").alias("median_fraud"),
    ).withColumn("ratio", F.try_divide("median_fraud", "median_legit"))


def _counts(df: DataFrame, *group) -> DataFrame:
    return df.groupBy(*group).agg(
        F.count(C.TARGET).alias("n"), F.sum(C.TARGET).alias("fraud_count"), rate().alias("fraud_rate"))


def rate_by_amount_bin(df: DataFrame) -> DataFrame:
    binned = df.withColumn("bin", right_closed_bin(C.AMOUNT, C.AMOUNT_EDGES)).where("bin IS NOT NULL")
    return _counts(binned, "bin").select(
        "bin", bin_label("bin", C.AMOUNT_LABELS).alias("label"), "n", "fraud_count", "fraud_rate",
        (F.col("fraud_rate") * 100).alias("fraud_rate_pct")).orderBy("bin")


def rate_by_hour(df: DataFrame) -> DataFrame:
    return _counts(df.where(F.col(C.TIME).isNotNull()), hour_bin(C.TIME).alias("hour")).orderBy("hour")


def top_hours(df: DataFrame, k: int = 5) -> DataFrame:
    return rate_by_hour(df).orderBy(F.desc("fraud_rate"), "hour").limit(k)


def hour_class_counts(df: DataFrame) -> DataFrame:
    hours = df.where(F.col(C.TIME).isNotNull()).groupBy(hour_bin(C.TIME).alias("hour"))
    return (hours.pivot(C.TARGET, [0, 1]).count().na.fill(0)
            .withColumnsRenamed({"0": "legitimate", "1": "fraud"}).orderBy("hour"))


def product_share(df: DataFrame, group: str = "ProductCD") -> DataFrame:
    """The total counts every row, also those without a group, so it is taken
    from the grouped rows before the null group is dropped."""
    g = df.groupBy(group).agg(rows().alias("rows"), F.count(C.TARGET).alias("n"),
                              F.sum(C.TARGET).alias("fraud_count"), rate().alias("fraud_rate"))
    total = F.sum("rows").over(Window.partitionBy(F.lit(0)))  # one row per product code
    return (
        g.withColumn("pct_of_total", F.col("n") * 100 / total)
        .where(F.col(group).isNotNull())
        .select(group, "n", "fraud_count", "fraud_rate",
                (F.col("fraud_rate") * 100).alias("fraud_rate_pct"), "pct_of_total")
        .orderBy(F.desc("n"), group)
    )


def rate_topk(df: DataFrame, group: str, k: int) -> DataFrame:
    """The k largest groups, flagged where their rate is above the overall rate."""
    overall_rate = df.agg(rate()).first()[0]
    return (
        _counts(df.where(F.col(group).isNotNull()), group)
        .select(F.col(group).alias("category"), "n", "fraud_rate",
                (F.col("fraud_rate") > F.lit(overall_rate)).alias("above_overall"))
        .orderBy(F.desc("n"), "category").limit(k)
    )


def high_risk(df: DataFrame, group: str, min_rows: int, k: int) -> DataFrame:
    return (
        _counts(df.where(F.col(group).isNotNull()), group).where(F.col("n") >= min_rows)
        .withColumn("fraud_rate_pct", F.col("fraud_rate") * 100)
        .orderBy(F.desc("fraud_rate"), group).limit(k)
    )


def time_span(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min(C.TIME).cast("long").alias("first_second"),
        F.max(C.TIME).cast("long").alias("last_second"),
        F.rint(F.max(C.TIME) / 86400.0).cast("long").alias("days"),
    )


def peak(df: DataFrame, group: Column, name: str) -> DataFrame:
    """The group with the highest rate; the smallest group wins a tie."""
    return (
        _counts(df.withColumn(name, group).where(F.col(name).isNotNull()), name)
        .orderBy(F.desc("fraud_rate"), name).limit(1).select(name, "n", "fraud_rate"))
