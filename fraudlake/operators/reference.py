"""A stored profile of a reference table, so that monitoring reads the current table only.

The profile is what the drift tests need of the reference: how often each value occurs, a
table by (column, value range), the same for categories, and a few numbers per column. It
is written once and may grow: profiles with the same value ranges add up. Comparing costs
one scan of the current table and the profile's rows, however large the reference was.
"""

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import drift
from .prefix import BIN, range_splits

_ROWS = "feature string, n long, mean double, std double"


@dataclass
class ReferenceProfile:
    """Made by ``build``, ``merge`` or ``load``."""

    values: DataFrame                 # (feature, range, x, n)
    cells: DataFrame                  # (feature, cell, n)
    splits: dict[str, list[float]]    # value ranges of the numeric columns, from -inf to inf
    categorical: list[str]
    n_rows: int
    moments: list[tuple]              # (feature, n, mean, std), a row per numeric column

    @classmethod
    def build(cls, reference: DataFrame, numeric: list[str], categorical: list[str] = (),
              like: "ReferenceProfile | None" = None) -> "ReferenceProfile":
        """``like``: take that profile's columns and value ranges, to be merged with it. A column
        without values is kept, with no rows; nulls are not counted."""
        numeric = list(like.splits) if like else list(numeric)
        categorical = like.categorical if like else list(categorical)
        spark = reference.sparkSession
        wide = reference.select(*[F.col(c).cast("double").alias(c) for c in numeric])
        splits = like.splits if like else range_splits(wide, numeric) if numeric else {}
        values = (drift.value_counts(wide, numeric, splits, n=F.count(F.lit(1))) if numeric else
                  spark.createDataFrame([], f"feature string, {BIN} double, x double, n long"))
        cells = _cells(reference, categorical)
        return cls._of(materialize(values), materialize(cells), splits, categorical, reference.count())

    @classmethod
    def _of(cls, values, cells, splits, categorical, n_rows):
        means = values.groupBy("feature").agg(
            F.sum("n").alias("all"), (F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("mean"))
        square = F.pow(F.col("x") - F.col("mean"), F.lit(2)) * F.col("n")
        rows = (values.join(F.broadcast(means), "feature").groupBy("feature", "all", "mean")  # a row per feature
                .agg(F.sqrt(F.try_divide(F.sum(square), (F.col("all") - 1).cast("double"))).alias("std")))
        found = {r["feature"]: (r["feature"], r["all"], r["mean"], r["std"]) for r in rows.collect()}
        return cls(values, cells, splits, list(categorical), n_rows,
                   [found.get(c, (c, 0, None, None)) for c in splits])

    def merge(self, other: "ReferenceProfile") -> "ReferenceProfile":
        """The profile of both references' rows; neither reference is read."""
        if (self.splits, self.categorical) != (other.splits, other.categorical):
            raise ValueError("profiles have different columns or value ranges: build one like the other")

        def added(a, b, *keys):
            return materialize(a.unionByName(b).groupBy(*keys).agg(F.sum("n").alias("n")))
        return self._of(added(self.values, other.values, "feature", BIN, "x"),
                        added(self.cells, other.cells, "feature", "cell"),
                        self.splits, self.categorical, self.n_rows + other.n_rows)

    def save(self, path: str) -> None:
        self.values.write.mode("overwrite").parquet(path + "/values")
        self.cells.write.mode("overwrite").parquet(path + "/cells")
        facts = {"splits": self.splits, "categorical": self.categorical, "n_rows": self.n_rows,
                 "moments": self.moments}
        self.values.sparkSession.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.mode(
            "overwrite").text(path + "/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ReferenceProfile":
        facts = json.loads(spark.read.text(path + "/facts").first()[0])
        facts["moments"] = [tuple(m) for m in facts["moments"]]
        return cls(spark.read.parquet(path + "/values"), spark.read.parquet(path + "/cells"), **facts)

    def known(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.moments, _ROWS)

    def mean_shift(self, current: DataFrame) -> DataFrame:
        """``drift.mean_shift`` of the numeric columns that the current table has too."""
        have = set(drift.numeric_columns(current))
        columns = [c for c in self.splits if c in have]
        return drift.mean_shift(None, current, columns, known=self.known(current.sparkSession))

    def wasserstein(self, current: DataFrame) -> DataFrame:
        """``drift.wasserstein`` of all numeric columns."""
        columns = list(self.splits)
        wide = current.select(*[F.col(c).cast("double").alias(c) for c in columns])
        here = drift.value_counts(wide, columns, self.splits, c=F.count(F.lit(1)))
        counts = (self.values.select("feature", BIN, "x", F.col("n").alias("r"), F.lit(0).cast("long").alias("c"))
                  .unionByName(here.withColumn("r", F.lit(0).cast("long")))
                  .groupBy("feature", BIN, "x").agg(F.sum("r").alias("r"), F.sum("c").alias("c")))
        return drift.distances(counts, drift.each_column(current, columns))

    def psi_categorical(self, current: DataFrame, floor: float = drift.PSI_FLOOR) -> DataFrame:
        """``drift.psi_categorical`` of all categorical columns."""
        asked = drift.each_column(current, self.categorical)
        here = _cells(current, self.categorical)
        cells = (self.cells.select("feature", "cell", F.col("n").alias("r"), F.lit(0).cast("long").alias("c"))
                 .unionByName(here.select("feature", "cell", F.lit(0).cast("long").alias("r"), F.col("n").alias("c")))
                 .groupBy("feature", "cell").agg(F.sum("r").alias("r"), F.sum("c").alias("c")))
        return asked.join(F.broadcast(drift.psi_of(cells, floor)), "feature", "left")  # one row per feature

    def column_tests(self, current: DataFrame) -> DataFrame:
        std = self.known(current.sparkSession).select("feature", "std")
        return drift.verdicts(self.wasserstein(current), std, self.psi_categorical(current))

    def scenario_table(self, scenarios: dict[str, DataFrame]) -> DataFrame:
        """One summary row per scenario; each scenario's table is read twice, the reference never."""
        return reduce(DataFrame.unionByName, [
            drift.drift_summary(self.mean_shift(current)).select(
                F.lit(name).alias("scenario"), F.lit("mean_shift").alias("method"), "*",
                F.lit(self.n_rows).cast("long").alias("reference_rows"),
                F.lit(current.count()).cast("long").alias("current_rows"))
            for name, current in scenarios.items()])


def _cells(df: DataFrame, categorical: list[str]) -> DataFrame:
    """(feature, cell, n) of the categories, nulls left out."""
    if not categorical:
        return df.sparkSession.createDataFrame([], "feature string, cell string, n long")
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("cell"))
                      for c in categorical])
    return (df.select(F.inline(cells)).where("cell IS NOT NULL")
            .groupBy("feature", "cell").agg(F.count(F.lit(1)).alias("n")))
