"""Missing values and the one-row exploration record."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.expressions import bin_label, right_closed_bin
from ..sources.schema import tidy_by_chunks
from .aggregates import class_medians, rate_by_hour


def missing_counts(df: DataFrame) -> DataFrame:
    """(feature, n_rows, missing, pct) of every column."""
    return tidy_by_chunks(
        df, df.columns, ["feature", "n_rows", "missing"],
        lambda c: [F.count(F.lit(1)), F.count_if(F.col(c).isNull())], C.AGG_CHUNK,
    ).withColumn(
        "pct", F.coalesce(F.try_divide(F.col("missing") * 100, F.col("n_rows")), F.lit(0.0)))


def missing_profile(df: DataFrame) -> DataFrame:
    return (missing_counts(df).where("missing > 0").select("feature", "missing", "pct")
            .orderBy(F.desc("pct"), "feature"))


def missing_summary(df: DataFrame) -> DataFrame:
    return missing_counts(df).agg(
        F.count(F.lit(1)).alias("n_features"),
        F.count_if(F.col("missing") > 0).alias("with_missing"),
        F.count_if(F.col("pct") < 10).alias("below_10_pct"),
        F.count_if(F.col("pct") > 50).alias("above_50_pct"),
        F.count_if(F.col("pct") > 90).alias("above_90_pct"),
    )


def missing_bins(df: DataFrame) -> DataFrame:
    """How many columns fall into each range of missing share."""
    index = right_closed_bin("pct", C.MISSING_EDGES)
    return (
        missing_counts(df).where("missing > 0").groupBy(index.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n_features"))
        .select("bin", bin_label("bin", C.MISSING_LABELS).alias("label"), "n_features").orderBy("bin")
    )


def null_total(df: DataFrame) -> DataFrame:
    return missing_counts(df).agg(
        F.max("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_columns"),
        F.sum("missing").alias("null_values"))


def exploration_record(df: DataFrame, source: str) -> DataFrame:
    """The nine figures of the exploration summary."""
    legit, fraud = class_medians(df)
    top = rate_by_hour(df).orderBy(F.desc("fraud_rate"), "hour").first()
    with_missing = missing_counts(df).where("missing > 0").count()
    return df.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.lit(len(df.columns)).cast("long").alias("total_features"),
        F.sum(C.TARGET).cast("long").alias("fraud_count"),
        F.round(F.avg(C.TARGET) * 100, 2).alias("fraud_rate_pct"),
        F.round(F.lit(legit).cast("double"), 2).alias("median_amount_legit"),
        F.round(F.lit(fraud).cast("double"), 2).alias("median_amount_fraud"),
        F.lit(with_missing).cast("long").alias("features_with_missing"),
        F.lit(top["hour"] if top else None).cast("long").alias("peak_fraud_hour"),
        F.lit(source).alias("data_source"),
    )
