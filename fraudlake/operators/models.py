"""Training, scoring and comparing classifiers on a feature matrix."""

from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from .. import config as C
from ..functions.expressions import score_columns
from ..session import materialize, shared_root
from .boosting import fit_boosted
from .evaluation import SCORE, evaluate

KINDS = ("gbt", "logistic-regression", "random-forest")
WEIGHT, VECTOR = "_weight", "_features"


def feature_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c in set(C.ALL_FEATURES)]


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=VECTOR).transform(df)


def class_weights(df: DataFrame, target: str = C.TARGET) -> DataFrame:
    """Balanced weights n / (2 * n_class)."""
    n0, n1 = F.count_if(F.col(target) == 0), F.count_if(F.col(target) == 1)
    from ..sources.schema import tidy

    return tidy(df.agg(n0.alias("n0"), n1.alias("n1")),
                [[0, "$n0", F.col("n0") + F.col("n1")], [1, "$n1", F.col("n0") + F.col("n1")]],
                [target, "n", "total"]).select(
        target, "n", F.try_divide(F.col("total").cast("double"), 2 * F.col("n")).alias("weight"))


@dataclass
class Dealt:
    """Assembled training rows on the executors, the same for every learner."""

    rows: DataFrame
    features: list[str]
    n_rows: int
    balanced: dict[int, float]


def partitions_for(n_rows: int) -> int:
    """Small tables are dealt finely so that a tree's levels run side by side; large ones by
    ``TRAIN_ROWS``, as each partition brings its own table of counts to every level."""
    fine = min(-(-n_rows // C.LEAST_TRAIN_ROWS), C.TRAIN_PARTITIONS)
    return max(1, fine, -(-n_rows // C.TRAIN_ROWS))


@contextmanager
def dealt(matrix: DataFrame, features: list[str] | None = None, partitions: int | None = None):
    """Rows of a training matrix, kept on the executors (spilling to their disks) inside the
    ``with`` block.

    Rows are dealt by a hash of their features and sorted in their partition, and the number
    of partitions follows from the number of rows if it isn't given: what the learners sample
    depends on neither the cores nor the files."""
    features = features or feature_names(matrix)
    found = class_weights(matrix).collect()  # two rows; the total counts rows without a label too
    n_rows = matrix.count()
    partitions = partitions or partitions_for(n_rows)
    spread = matrix.repartition(partitions, *features).sortWithinPartitions(*features, C.TARGET)
    ready = assemble(spread, features).select(VECTOR, C.TARGET).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield Dealt(ready, features, n_rows, {r[C.TARGET]: r["weight"] or 0.0 for r in found})
    finally:
        ready.unpersist()


def fit(kind: str, data: Dealt, **params):
    """Fit one classifier on dealt rows. Boosted trees checkpoint their errors so that the
    lineage does not grow with the trees."""
    common = {"labelCol": C.TARGET, "featuresCol": VECTOR, "weightCol": WEIGHT}
    # the trees are shallow: handing them to the tasks is cheaper than keeping every row's node
    trees = {"seed": C.SEED, "cacheNodeIds": False, "checkpointInterval": 10}
    shared_root(data.rows.sparkSession)
    weights = data.balanced
    if kind == "gbt":
        learner = GBTClassifier(**{**common, **trees, **C.GBT_PARAMS, **params})
        weights = {0: 1.0, 1: C.POSITIVE_WEIGHT}
    elif kind == "random-forest":
        learner = RandomForestClassifier(**{**common, **trees, **C.RF_PARAMS, **params})
    elif kind == "logistic-regression":
        # the published penalty stands beside the summed loss, this one beside the mean loss;
        # balanced weights sum up to the number of rows
        penalty = {"regParam": 1.0 / (C.LR_INVERSE_PENALTY * max(data.n_rows, 1))}
        learner = LogisticRegression(**{**common, **penalty, **C.LR_PARAMS, **params})
    else:
        raise ValueError(f"unknown classifier {kind}")
    weight = F.when(F.col(C.TARGET) == 1, F.lit(float(weights[1]))).otherwise(float(weights[0]))
    rows = data.rows.withColumn(WEIGHT, weight)
    if kind == "gbt":
        return fit_boosted(learner, rows, (float(weights[0]), float(weights[1])))
    return learner.fit(rows)


def train(kind: str, matrix: DataFrame, features: list[str] | None = None,
          partitions: int | None = None, **params):
    """Deal the rows and fit one classifier."""
    if kind not in KINDS:
        raise ValueError(f"unknown classifier {kind}")
    with dealt(matrix, features, partitions) as data:
        return fit(kind, data, **params)


def add_score(model, matrix: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Probability of class 1 as ``score``; the other columns stay."""
    features = features or feature_names(matrix)
    out = model.transform(assemble(matrix, features))
    return out.select(*matrix.columns, vector_to_array(model.getProbabilityCol())[1].alias(SCORE))


def score_batch(model, feature_model, batch: DataFrame, key: str = C.KEY,
                threshold: float = C.SCORE_THRESHOLD) -> DataFrame:
    """Raw rows in, one scored row each out."""
    scored = add_score(model, feature_model.transform(batch, keep=(key,)), feature_model.feature_columns)
    return scored.select(key, *[e.alias(n) for n, e in score_columns(SCORE, threshold).items()])


def scored_labels(model, matrix: DataFrame, features: list[str]) -> DataFrame:
    """Label and score only, written once: the metrics read them several times and
    must not score again each time."""
    return materialize(add_score(model, matrix, features).select(C.TARGET, SCORE))


def feature_importance(model, features: list[str], spark) -> DataFrame:
    rows = [(f, float(model.featureImportances[i])) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


def compare(train_rows: DataFrame, test_rows: DataFrame, params: dict[str, dict]) -> DataFrame:
    """Metrics of each classifier on the test rows, best area under the curve first. The
    training rows are dealt once; the models are fitted one after the other, each fit a
    distributed job."""
    with dealt(train_rows) as data:
        fitted = {kind: fit(kind, data, **p) for kind, p in params.items()}
    rows = [
        evaluate(scored_labels(model, test_rows, data.features))
        .select(F.lit(kind).alias("model"), "auc_roc", "average_precision", "f1", "precision", "recall")
        for kind, model in fitted.items()
    ]
    return reduce(DataFrame.unionByName, rows).orderBy(F.desc("auc_roc"), "model")
