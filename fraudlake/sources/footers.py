"""Reports over Parquet tables that are answered from the files' footers.

A footer holds, per row group and column, the number of nulls and the smallest and largest
value. Spark answers COUNT, MIN and MAX without filter or grouping from them, so that a check
of 100 TB reads some kilobytes a file. Values count as written: a NaN is a value (``read_parquet``
makes it null, and what this package writes holds none).

Text and timestamps have no exact extremes in a footer: MIN or MAX of one makes the whole report
read these columns' pages. So do row groups without the statistics, for example without any value.
"""

from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LACKING = ("No min/max found", "No number of nulls")  # Spark's words for absent statistics


def open_footers(spark: SparkSession, *paths: str) -> list[DataFrame]:
    """The tables in a session of their own (same cluster) whose scans may answer aggregates. A table
    without a row is replaced by an empty frame: its footers would count null instead of 0."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    tables = [session.read.parquet(p) for p in paths]
    return [session.createDataFrame([], t.schema) if t.isEmpty() else t for t in tables]


def reads_pages(df: DataFrame) -> bool:
    """Whether some scan of the plan reads more than footers."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    answered = plan.count("PushedAggregation: [") - plan.count("PushedAggregation: []")
    return answered < plan.count("BatchScan") + plan.count("FileScan")


def from_footers(spark: SparkSession, report: Callable[..., DataFrame], *paths: str) -> DataFrame:
    """``report(*tables)``, which must be global counts and extremes (a few rows)."""
    lazy = report(*open_footers(spark, *paths))
    try:
        rows = lazy.collect()
    except (PySparkException, Py4JError) as e:
        if not any(words in str(e) for words in _LACKING):
            raise
        rows = report(*[spark.read.parquet(p) for p in paths]).collect()
    return spark.createDataFrame(rows, lazy.schema)


def n_rows(spark: SparkSession, path: str) -> int:
    return from_footers(spark, lambda t: t.agg(F.count(F.lit(1))), path).first()[0]


def extents(table: DataFrame, columns: list[str]) -> DataFrame:
    """One row: values, smallest and largest of each column, in the column's type."""
    return table.agg(F.count(F.lit(1)).alias("n_rows"), *[
        e for c in columns for e in (F.count(c).alias(f"{c}_values"), F.min(c).alias(f"{c}_smallest"),
                                     F.max(c).alias(f"{c}_largest"))])
