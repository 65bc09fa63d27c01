"""Monitoring per time window. The same functions run on batch and streaming frames."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..operators.drift import moments, shift_columns
from ..operators.evaluation import metric_columns, outcome_counts

LATENESS = "1 hour"
SCORE_STEPS = 1000  # buckets of a score from 0 to 1; scores of one bucket count as equal


def windowed(df: DataFrame, time: str, width: str):
    """Grouping by window; the watermark only matters on a stream."""
    rows = df.withWatermark(time, LATENESS) if df.isStreaming else df
    return rows, F.window(time, width)


def _flat(df: DataFrame) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"),
                     *[c for c in df.columns if c != "window"])


def windowed_rate(df: DataFrame, time: str, width: str) -> DataFrame:
    rows, window = windowed(df, time, width)
    return _flat(rows.groupBy(window).agg(
        F.count(F.lit(1)).alias("n"), F.sum(C.TARGET).alias("fraud_count"),
        F.avg(C.TARGET).alias("fraud_rate"), F.avg(C.AMOUNT).alias("avg_amount")))


def windowed_metrics(df: DataFrame, time: str, width: str, score: str = "score",
                     threshold: float = C.SCORE_THRESHOLD) -> DataFrame:
    rows, window = windowed(df, time, width)
    counts = outcome_counts(C.TARGET, score, threshold)
    return _flat(metric_columns(rows.groupBy(window).agg(*[e.alias(n) for n, e in counts.items()])))


def reference_moments(reference: DataFrame, columns: list[str]) -> dict[str, tuple]:
    """{feature: (n, mean, std)}; one row per feature, so literals in a stream's plan."""
    return {r["feature"]: (r["n"], r["mean"], r["std"]) for r in moments(reference, columns).collect()}


def windowed_drift(df: DataFrame, time: str, width: str, reference: dict[str, tuple]) -> DataFrame:
    """Mean shift of every feature in every window against fixed reference moments."""
    rows, window = windowed(df, time, width)
    per = moments(rows, list(reference), by=[window])

    def of(i):
        chain = F.lit(None).cast("double")
        for f, r in reference.items():
            chain = F.when(F.col("feature") == f, F.lit(r[i]).cast("double")).otherwise(chain)
        return chain

    flags = shift_columns(F.col("mean"), of(1), of(2), of(0))
    return _flat(per.select("window", "feature", "n", *[e.alias(n) for n, e in flags.items()]))


def score_counts(df: DataFrame, time: str, pane: str, score: str = "score", label: str = C.TARGET,
                 steps: int = SCORE_STEPS) -> DataFrame:
    """(window_start, bucket, pos, neg) of every pane: a histogram of the scores per class. This is
    all that is kept of the rows: at most ``steps`` + 1 counters a pane, as state on a stream, and
    counters of panes, streams or tables add up. Rows without label, score or time are left out;
    scores beyond 0 and 1 count as these."""
    known = df.where(F.col(label).isNotNull() & F.col(score).isNotNull() & ~F.isnan(score))
    rows, window = windowed(known, time, pane)
    bucket = F.floor(F.least(F.greatest(F.col(score), F.lit(0.0)), F.lit(1.0)) * steps)
    return _flat(rows.groupBy(window, bucket.alias("bucket")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")))


def rolling_ranking(counts: DataFrame, slide: str, panes: int, last_end=None) -> DataFrame:
    """Area under the ROC curve (ties at half credit) and average precision of every sliding window
    of ``panes`` panes, from the panes' merged score counts; a row is never read again. Windows
    start one ``slide`` (the panes' width) apart, from the first that holds a pane. The area is null
    without both classes, the precision without a positive. ``last_end`` (a column or literal): only
    windows that end by then, for a stream whose later panes are still open."""
    def back(i):
        return F.col("window_start") - F.expr(f"interval {slide}") * i

    starts = F.array(*[back(i) for i in range(panes)])
    merged = (counts.select(F.explode(starts).alias("window_start"), "bucket", "pos", "neg")
              .groupBy("window_start", "bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    end = F.col("window_start") + F.expr(f"interval {slide}") * panes
    if last_end is not None:
        merged = merged.where(end <= last_end)
    above = Window.partitionBy("window_start").orderBy(F.desc("bucket"))  # bounded: a histogram
    run = merged.withColumns({"tp": F.sum("pos").over(above), "fp": F.sum("neg").over(above)})
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    steps = F.sum(F.col("pos") * F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0)))
    return run.groupBy("window_start").agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
        F.try_divide(area, (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc_roc"),
        F.try_divide(steps, F.sum("pos").cast("double")).alias("average_precision"))
