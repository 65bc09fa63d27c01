"""Feature preparation that is learned on the training split and applied anywhere.

``FeatureEstimator.fit(train)`` returns a ``FeatureModel``; only the model can
transform, so nothing is learned from the data it is applied to. What was learned
is kept as tables (pair counts, category codes) and a few numbers per column.
"""

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import expressions as X
from ..session import materialize
from .joins import fits, fits_broadcast, lookup, row_bytes
from .quantiles import exact_quantiles

PAIR = ["card1", "addr1"]
PAIR_COUNT = "card1_addr1_count"
WHOLE = (*C.CATEGORICAL_FEATURES, PAIR_COUNT)  # codes and counts: whole numbers


def engineered(df: DataFrame) -> dict[str, Column]:
    out = {}
    if C.AMOUNT in df.columns:
        out["TransactionAmt_log"] = X.log_amount(C.AMOUNT)
        out["TransactionAmt_decimal"] = X.thousandths(C.AMOUNT)
    if C.TIME in df.columns:
        out["Transaction_hour"] = X.hour_of_day(C.TIME)
        out["Transaction_day"] = X.day_of_week(C.TIME)
    return out


def pair_counts(df: DataFrame, pair: list[str] = PAIR) -> DataFrame:
    """Rows per pair, pairs with a null included."""
    return df.groupBy(*pair).agg(F.count(F.lit(1)).alias(PAIR_COUNT))


def add_pair_count(df: DataFrame, counts: DataFrame, pair: list[str] = PAIR,
                   small: bool | None = None) -> DataFrame:
    """Learned count of the row's pair, 1 for a pair not seen before."""
    return lookup(df, counts, pair, small).withColumn(
        PAIR_COUNT, F.coalesce(PAIR_COUNT, F.lit(1).cast("long")))


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, category, n_rows) of all columns in one pass; null counts as
    ``unknown``, which is always listed."""
    values = F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 F.coalesce(F.col(c).cast("string"), F.lit(C.UNKNOWN)).alias("category"))
        for c in columns])
    counted = (df.select(F.inline(values)).groupBy("feature", "category")
               .agg(F.count(F.lit(1)).alias("n_rows")))
    always = df.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(C.UNKNOWN).alias("category"),
                 F.lit(0).cast("long").alias("n_rows")) for c in columns])))
    return (counted.unionByName(always).groupBy("feature", "category")
            .agg(F.sum("n_rows").alias("n_rows")))


def label_codes(counts: DataFrame) -> DataFrame:
    """Code = rank of the category among its column's sorted categories, from 0.

    The rank runs over distinct categories only, in two levels: they are sorted into
    ranges by the shuffle, numbered inside each range, and shifted by the sizes of the
    ranges before it."""
    # written once, so that range numbers cannot change between the two uses below
    tagged = materialize(
        counts.repartitionByRange("feature", "category")
        .withColumn("_range", F.spark_partition_id()))
    totals = tagged.groupBy("feature", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("feature").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "feature", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = Window.partitionBy("feature", "_range").orderBy("category")
    return (
        tagged.join(F.broadcast(offsets), ["feature", "_range"])  # one row per range and column
        .withColumn("code", F.col("_offset") + F.row_number().over(local) - 1)
        .drop("_range", "_offset"))


def fit_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Codes of all columns, written to the shared folder: one pass over the data."""
    if not columns:
        return df.sparkSession.createDataFrame(
            [], "feature string, category string, n_rows long, code long")
    return materialize(label_codes(materialize(category_counts(df, columns))))


def code_facts(codes: DataFrame) -> tuple[dict[str, bool], dict[str, int]]:
    """Per feature, whether its codes may be broadcast and the code of ``unknown``: one job for
    all features."""
    small, unknown = {}, {}
    for r in codes.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.sum(row_bytes(codes, ["category", "code"])).alias("n_bytes"),
        F.max(F.when(F.col("category") == C.UNKNOWN, F.col("code"))).alias("unknown"),
    ).collect():  # one row per categorical column
        small[r["feature"]] = fits(r["n"], r["n_bytes"])
        unknown[r["feature"]] = r["unknown"]
    return small, unknown


def encode(df: DataFrame, codes: DataFrame, columns: list[str],
           small: dict[str, bool] | None = None, unknown: dict[str, int] | None = None) -> DataFrame:
    """Replace categories by their code; unseen and null ones get ``unknown``'s. ``small`` and
    ``unknown`` as in ``code_facts``."""
    if small is None or unknown is None:
        small, unknown = code_facts(codes)
    present = [c for c in columns if c in df.columns and c in unknown]
    names = df.columns
    df = df.select(*names, *[F.coalesce(F.col(c).cast("string"), F.lit(C.UNKNOWN)).alias("_" + c)
                             for c in present])
    for c in present:
        table = codes.where(F.col("feature") == c).select(
            F.col("category").alias("_" + c), F.col("code").alias("_code_" + c))
        df = lookup(df, table, ["_" + c], small[c])
    return df.select(*[
        F.coalesce(F.col("_code_" + c), F.lit(unknown[c])).cast("long").alias(c) if c in present else c
        for c in names])


def pick_features(df: DataFrame) -> list[str]:
    """Feature columns that are present, in list order."""
    return [c for c in C.ALL_FEATURES if c in df.columns]


def select_features(df: DataFrame, keep: tuple = ()) -> DataFrame:
    """Features first, target last; ``keep`` adds id columns in front."""
    target = [C.TARGET] if C.TARGET in df.columns else []
    return df.select(*keep, *pick_features(df), *target)


def fit_medians(df: DataFrame, columns: list[str], **options) -> dict[str, float]:
    """Exact median per column, nulls skipped, 0.0 for a column without values;
    ``options`` as in ``exact_quantiles``."""
    got = exact_quantiles(df, {c: F.col(c) for c in columns}, [0.5], **options)
    return {c: 0.0 if v[0] is None else v[0] for c, v in got.items()}


def _filled(name: str, median: float) -> str:
    """SQL of one imputed feature. Codes and counts stay whole numbers, all other
    features are doubles, so the types do not depend on the data."""
    if name in WHOLE:
        return f"coalesce(`{name}`, {int(median)}L) AS `{name}`"
    return f"coalesce(cast(`{name}` AS double), {float(median)!r}D) AS `{name}`"


def impute(df: DataFrame, medians: dict[str, float], keep: tuple = ()) -> DataFrame:
    """Fill nulls of the numeric columns with the learned median, else with 0. The
    target and the ``keep`` columns stay as they are."""
    return df.selectExpr(*[
        _filled(f.name, medians.get(f.name, 0.0))
        if isinstance(f.dataType, T.NumericType) and f.name not in (C.TARGET, *keep) else f"`{f.name}`"
        for f in df.schema])


def align(df: DataFrame, feature_columns: list[str], medians: dict[str, float],
          keep: tuple = (), fill_nulls: bool = False) -> DataFrame:
    """Exactly the learned columns in the learned order; an absent column is filled
    with its median, an extra one dropped, the target kept. ``fill_nulls`` imputes
    the present ones in the same step."""
    have = set(df.columns)

    def one(c):
        m = medians.get(c, 0.0)
        if c not in have:
            return f"{int(m)}L AS `{c}`" if c in WHOLE else f"{float(m)!r}D AS `{c}`"
        return _filled(c, m) if fill_nulls else f"`{c}`"

    target = [C.TARGET] if C.TARGET in have else []
    return df.selectExpr(*keep, *map(one, feature_columns), *target)


@dataclass
class FeatureModel:
    """What was learned; see ``transform``."""

    counts: DataFrame | None
    codes: DataFrame
    medians: dict[str, float] = field(default_factory=dict)
    feature_columns: list[str] = field(default_factory=list)
    unknown: dict[str, int] = field(default_factory=dict)
    small: dict[str, bool] = field(default_factory=dict)

    def transform(self, df: DataFrame, keep: tuple = ()) -> DataFrame:
        """The feature matrix of any batch; ``keep`` carries id columns through."""
        df = df.withColumns(engineered(df))
        if self.counts is not None and set(PAIR) <= set(df.columns):
            df = add_pair_count(df, self.counts, small=self.small[PAIR_COUNT])
        df = encode(df, self.codes, C.CATEGORICAL_FEATURES, self.small, self.unknown)
        return align(df, self.feature_columns, self.medians, keep, fill_nulls=True)

    def save(self, path: str) -> None:
        if self.counts is not None:
            self.counts.write.mode("overwrite").parquet(path + "/pair_counts")
        self.codes.write.mode("overwrite").parquet(path + "/codes")
        facts = {"medians": self.medians, "feature_columns": self.feature_columns,
                 "unknown": self.unknown, "small": self.small,
                 "has_counts": self.counts is not None}
        spark = self.codes.sparkSession
        spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.mode(
            "overwrite").text(path + "/facts")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FeatureModel":
        from ..sources.readers import path_exists

        if not path_exists(spark, path + "/facts"):
            raise FileNotFoundError(f"no saved feature model at {path}")
        facts = json.loads(spark.read.text(path + "/facts").first()[0])
        has_counts = facts.pop("has_counts")
        return cls(counts=spark.read.parquet(path + "/pair_counts") if has_counts else None,
                   codes=spark.read.parquet(path + "/codes"), **facts)


class FeatureEstimator:
    """``fit`` on the training split, then use the returned model."""

    def __init__(self):
        self._model: FeatureModel | None = None

    @property
    def model(self) -> FeatureModel:
        if self._model is None:
            raise RuntimeError("not fitted: call fit first or load a saved model")
        return self._model

    def transform(self, df: DataFrame, keep: tuple = ()) -> DataFrame:
        return self.model.transform(df, keep)

    def save(self, path: str) -> None:
        self.model.save(path)

    def fit(self, train: DataFrame) -> FeatureModel:
        medians, small, counts = {}, {}, None
        # encoded columns are never materialised to learn their medians: a frequency
        # weighted quantile over the learned tables gives the same number
        if set(PAIR) <= set(train.columns):
            counts = materialize(pair_counts(train))
            per_count = counts.groupBy(PAIR_COUNT).agg(F.count(F.lit(1)).alias("n"))
            small[PAIR_COUNT] = fits_broadcast(counts)
            medians.update(fit_medians(
                per_count, [PAIR_COUNT], weight=F.col("n") * F.col(PAIR_COUNT)))
        categorical = [c for c in C.CATEGORICAL_FEATURES if c in train.columns]
        codes = fit_codes(train, categorical)
        # a rank over weighted codes: counted in buckets, so no group holds a vocabulary
        medians.update({c: v[0] or 0.0 for c, v in exact_quantiles(
            codes, {c: F.when(F.col("feature") == c, F.col("code")) for c in categorical},
            [0.5], weight=F.col("n_rows")).items()})
        small_codes, unknown = code_facts(codes)
        small.update(small_codes)
        raw = train.withColumns(engineered(train))
        medians.update(fit_medians(raw, [c for c in pick_features(raw) if c not in categorical
                                         and isinstance(raw.schema[c].dataType, T.NumericType)]))
        model = FeatureModel(counts, codes, medians, [], unknown, small)
        derived = [*raw.columns, *([PAIR_COUNT] if counts is not None else [])]
        model.feature_columns = [c for c in C.ALL_FEATURES if c in derived]
        self._model = model
        return model

    def fit_transform(self, train: DataFrame, keep: tuple = ()) -> DataFrame:
        return self.fit(train).transform(train, keep)
