"""Classifier metrics, exact with tied scores. Frames need a 0/1 label and a score."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.expressions import share
from ..sources.schema import tidy
from .prefix import BIN, range_splits, running_totals, with_ranges

SCORE = "score"


def outcome_counts(label=C.TARGET, score=SCORE, threshold=C.SCORE_THRESHOLD) -> dict[str, Column]:
    y, yes = F.col(label) == 1, F.col(score) >= threshold
    return {"tp": F.count_if(y & yes), "fp": F.count_if(~y & yes),
            "fn": F.count_if(y & ~yes), "tn": F.count_if(~y & ~yes)}


def _outcomes(df: DataFrame, label, score, threshold) -> DataFrame:
    return df.agg(*[e.alias(n) for n, e in outcome_counts(label, score, threshold).items()])


def confusion_matrix(df: DataFrame, label=C.TARGET, score=SCORE,
                     threshold=C.SCORE_THRESHOLD) -> DataFrame:
    """All four cells, empty ones as 0."""
    cells = [[0, 0, "$tn"], [0, 1, "$fp"], [1, 0, "$fn"], [1, 1, "$tp"]]
    return tidy(_outcomes(df, label, score, threshold), cells, ["label", "prediction", "n"])


def f1_of(precision, recall) -> Column:
    return share(2 * F.col(precision) * F.col(recall), F.col(precision) + F.col(recall))


def metric_columns(counts: DataFrame) -> DataFrame:
    """Metrics from the four outcome counts; 0 where a denominator is 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    return counts.withColumns({
        "accuracy": share(tp + tn, n), "precision": share(tp, tp + fp), "recall": share(tp, tp + fn),
        "n": n, "positives": tp + fn, "positive_rate": share(tp + fn, n),
    }).withColumn("f1", f1_of("precision", "recall")).drop("tp", "fp", "fn", "tn")


def binary_metrics(df: DataFrame, label=C.TARGET, score=SCORE,
                   threshold=C.SCORE_THRESHOLD) -> DataFrame:
    return metric_columns(_outcomes(df, label, score, threshold))


def classification_report(df: DataFrame, label=C.TARGET, score=SCORE,
                          threshold=C.SCORE_THRESHOLD) -> DataFrame:
    """Per class and averaged precision, recall, F1, support."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    c = _outcomes(df, label, score, threshold).select(
        share(tn, tn + fn).alias("p0"), share(tn, tn + fp).alias("r0"), (tn + fp).alias("s0"),
        share(tp, tp + fp).alias("p1"), share(tp, tp + fn).alias("r1"), (tp + fn).alias("s1"),
        share(tp + tn, tp + fp + fn + tn).alias("accuracy"))
    c = c.withColumns({"f0": f1_of("p0", "r0"), "f1": f1_of("p1", "r1"),
                       "s": F.col("s0") + F.col("s1")})
    macro = [(F.col(m + "0") + F.col(m + "1")) / 2 for m in "prf"]
    weighted = [share(F.col(m + "0") * F.col("s0") + F.col(m + "1") * F.col("s1"), "s") for m in "prf"]
    none = F.lit(None).cast("double")
    return tidy(c, [["0", "$p0", "$r0", "$f0", "$s0"], ["1", "$p1", "$r1", "$f1", "$s1"],
                    ["accuracy", none, none, "$accuracy", "$s"],
                    ["macro avg", *macro, "$s"], ["weighted avg", *weighted, "$s"]],
                ["class", "precision", "recall", "f1", "support"])


def score_curve(df: DataFrame, label=C.TARGET, score=SCORE) -> DataFrame:
    """One row per distinct score, from the highest: positives and negatives with
    that score (pos, neg), at or above it (tp, fp), and in total."""
    known = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).select(
        F.col(score).cast("double").alias(SCORE), F.col(label).cast("long").alias("_y"))
    groups = known.groupBy(SCORE).agg(F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg"))
    ranged = with_ranges(groups, range_splits(known, [SCORE]))
    return running_totals(ranged, SCORE, {"pos": "tp", "neg": "fp"}, [], SCORE + BIN, descending=True)


def ranking_metrics(df: DataFrame, label=C.TARGET, score=SCORE) -> DataFrame:
    """Area under the ROC curve (ties at half credit; null with one class only) and
    average precision (step sum)."""
    curve = score_curve(df, label, score)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    steps = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return curve.agg(
        F.try_divide(area, (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc_roc"),
        F.try_divide(steps, F.sum("pos").cast("double")).alias("average_precision"))


def roc_curve(df: DataFrame, label=C.TARGET, score=SCORE) -> DataFrame:
    """A point per distinct threshold and the origin (threshold null)."""
    points = score_curve(df, label, score).select(
        F.col(SCORE).alias("threshold"),
        F.try_divide("fp", "fp_total").alias("fpr"), F.try_divide("tp", "tp_total").alias("tpr"))
    origin = df.sparkSession.range(0, 1, 1, 1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origin)


def pr_curve(df: DataFrame, label=C.TARGET, score=SCORE) -> DataFrame:
    """A point per distinct threshold, the end point (recall 0, precision 1,
    threshold null), and the base rate."""
    curve = score_curve(df, label, score)
    points = curve.select(
        F.col(SCORE).alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide("tp", "tp_total").alias("recall"),
        (F.col("tp_total") / (F.col("tp_total") + F.col("fp_total"))).alias("base_rate"))
    end = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).agg(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"), F.avg(label).alias("base_rate"))
    return points.unionByName(end)


def threshold_for_precision(df: DataFrame, target: float, label=C.TARGET, score=SCORE) -> DataFrame:
    """The threshold with the highest recall among those that reach the target
    precision; the higher threshold wins a tie."""
    point = F.struct("threshold", "precision", "recall")
    best = pr_curve(df, label, score).where("threshold IS NOT NULL").where(F.col("precision") >= target)
    return best.agg(F.max_by(point, F.struct("recall", "threshold")).alias("b")).select("b.*")


def evaluate(df: DataFrame, label=C.TARGET, score=SCORE, threshold=C.SCORE_THRESHOLD) -> DataFrame:
    """All metrics of one scored table in one row."""
    # both sides have exactly one row; the constant key keeps this an equi-join
    one = F.lit(1).alias("_one")
    left = binary_metrics(df, label, score, threshold).select(one, "*")
    right = ranking_metrics(df, label, score).select(one, "*")
    return left.join(F.broadcast(right), "_one").drop("_one")
