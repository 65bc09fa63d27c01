"""The batch stages, from raw files to drift reports.

Each stage reads what an earlier one wrote and runs that one first if its output
is not there. Everything lies in one folder that all executors can reach.
"""

import json

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import drift, evaluation, joins, models, scenarios, splitting
from ..operators.features import FeatureEstimator, FeatureModel
from ..operators.ranking import hash_sample
from ..sources import footers, readers, schema, sinks
from .reports import run_reports

SCENARIOS = ("a", "b", "c")


class Workspace:
    """Input files and output folder of one run."""

    def __init__(self, spark: SparkSession, root: str, transactions: str,
                 identity: str | None = None, model: str = "gbt", **model_params):
        self.spark, self.root = spark, root.rstrip("/")
        self.transactions, self.identity = transactions, identity
        self.model, self.model_params = model, model_params

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def has(self, *names: str) -> bool:
        """A written table carries a success mark, so half a write does not count."""
        return all(readers.path_exists(self.spark, self.path(n) + "/_SUCCESS") for n in names)


def ingest(ws: Workspace) -> None:
    """Check, join, split by time; raw splits and a summary."""
    if not readers.path_exists(ws.spark, ws.transactions):
        raise FileNotFoundError(f"no transactions at {ws.transactions}")
    txn = schema.require_columns(
        readers.read_csv(ws.spark, ws.transactions), C.REQUIRED_TRANSACTION_COLUMNS, "transactions")
    identity = None
    if ws.identity and readers.path_exists(ws.spark, ws.identity):
        identity = schema.require_columns(
            readers.read_csv(ws.spark, ws.identity), C.REQUIRED_IDENTITY_COLUMNS, "identity")
    marked = joins.attach_identity(splitting.mark_split(txn), identity)
    for part in ("train", "test"):
        sinks.write_parquet(marked.where(F.col("split") == part).drop("split"), ws.path(f"raw_{part}"))
    written = joins.stack_splits(ws.table("raw_train"), ws.table("raw_test"))
    sinks.write_report_json(splitting.ingestion_summary(txn, identity, written), ws.path("ingestion_summary"))


def preprocess(ws: Workspace) -> None:
    """Fit on the training split only; feature matrices with the row key, reference sample."""
    if not ws.has("raw_train", "raw_test"):
        ingest(ws)
    train, test = ws.table("raw_train"), ws.table("raw_test")
    model = FeatureEstimator().fit(train)
    sinks.write_parquet(model.transform(train, keep=(C.KEY,)), ws.path("train"))
    sinks.write_parquet(model.transform(test, keep=(C.KEY,)), ws.path("test"))
    reference = hash_sample(ws.table("train"), C.REFERENCE_SAMPLE_ROWS, C.KEY, C.SEED).drop(C.TARGET)
    sinks.write_parquet(reference, ws.path("reference"))
    model.save(ws.path("feature_model"))


def train(ws: Workspace) -> None:
    """Fit the classifier; model, metrics on the test split, ranked importances."""
    if not ws.has("train", "test", "reference", "feature_model/codes", "feature_model/facts"):
        preprocess(ws)
    matrix = ws.table("train")
    names = models.feature_names(matrix)
    fitted = models.train(ws.model, matrix, names, **ws.model_params)
    fitted.write().overwrite().save(ws.path("model"))
    if hasattr(fitted, "featureImportances"):
        sinks.write_report_csv(
            models.feature_importance(fitted, names, ws.spark), ws.path("feature_importance"))
    evaluate(ws)


def load_model(ws: Workspace):
    """The saved classifier, whichever kind it is."""
    return DefaultParamsReader.loadParamsInstance(ws.path("model"), ws.spark)


def evaluate(ws: Workspace) -> None:
    """Metrics, report, confusion matrix and curves of the test split."""
    if not ws.has("model/metadata"):
        return train(ws)
    test = ws.table("test")
    scored = models.scored_labels(load_model(ws), test, models.feature_names(test))
    sinks.write_report_json(evaluation.evaluate(scored), ws.path("metrics"))
    sinks.write_report_json(evaluation.classification_report(scored), ws.path("classification_report"))
    sinks.write_report_json(evaluation.confusion_matrix(scored), ws.path("confusion_matrix"))
    sinks.write_parquet(evaluation.roc_curve(scored), ws.path("roc_curve"))
    sinks.write_parquet(evaluation.pr_curve(scored), ws.path("pr_curve"))


def drift_data(ws: Workspace) -> None:
    """Drifted copies of a fixed sample of the training matrix."""
    if not ws.has("train"):
        preprocess(ws)
    base = hash_sample(ws.table("train"), C.DRIFT_SAMPLE_ROWS, C.KEY, C.SEED)
    made = {"a": scenarios.feature_drift, "b": scenarios.label_drift, "c": scenarios.lost_identity}
    for name in SCENARIOS:
        sinks.write_parquet(made[name](base), ws.path(f"drifted_{name}"))


def monitor(ws: Workspace, current: str = "test") -> DataFrame:
    """Compare a written table with the reference sample; the per-feature result and
    its summary are written, the summary is returned."""
    if not ws.has("reference"):
        raise FileNotFoundError("no reference sample: run preprocess first")
    if not ws.has(current):
        raise FileNotFoundError(f"no current data at {ws.path(current)}")
    ref = ws.table("reference").drop(C.KEY)
    cur = ws.table(current).drop(C.KEY, C.TARGET)
    sinks.write_parquet(drift.mean_shift(ref, cur), ws.path(f"drift_features_{current}"))
    features = ws.table(f"drift_features_{current}")
    summary = drift.drift_summary(features).select(
        F.lit(current).alias("current"), F.lit("mean_shift").alias("method"), "*",
        F.lit(footers.n_rows(ws.spark, ws.path("reference"))).alias("reference_rows"),
        F.lit(footers.n_rows(ws.spark, ws.path(current))).alias("current_rows"),
        F.lit(json.dumps(sorted(set(ref.columns) - set(cur.columns)))).alias("missing_columns"))
    sinks.write_report_json(summary, ws.path(f"drift_summary_{current}"))
    return summary


def compare_scenarios(ws: Workspace) -> DataFrame:
    """One row per stored scenario summary."""
    have = [f"drift_summary_drifted_{s}" for s in SCENARIOS if ws.has(f"drift_summary_drifted_{s}")]
    if not have:
        raise FileNotFoundError("no scenario has been monitored yet")
    return ws.spark.read.json([ws.path(n) for n in have]).orderBy("current")


def load_table(ws: Workspace, table: str = "fraud_transactions") -> dict[str, DataFrame]:
    """Load both splits into one table and give the standard reports over it."""
    if not ws.has("train", "test"):
        preprocess(ws)
    whole = sinks.load_table([ws.table("train"), ws.table("test")], table, ws.path(table))
    return run_reports(whole)


def load_and_report(ws: Workspace) -> None:
    """The table load; each standard report is written as JSON."""
    for name, report in load_table(ws).items():
        sinks.write_report_json(report, ws.path(f"reports/{name}"))


def compare_models(ws: Workspace, params: dict[str, dict] | None = None) -> DataFrame:
    """Fit every kind of classifier on the training matrix and write their metrics on the test
    split, best first; the published settings unless others are given."""
    if not ws.has("train", "test"):
        preprocess(ws)
    found = models.compare(ws.table("train"), ws.table("test"), params or {kind: {} for kind in models.KINDS})
    sinks.write_report_json(found, ws.path("model_comparison"))
    return ws.spark.read.json(ws.path("model_comparison")).orderBy(F.desc("auc_roc"), "model")


def scenario_table(ws: Workspace) -> DataFrame:
    """The three drifted copies monitored anew, one row for each."""
    if not ws.has("reference", *[f"drifted_{s}" for s in SCENARIOS]):
        drift_data(ws)
    for name in SCENARIOS:
        monitor(ws, f"drifted_{name}")
    return compare_scenarios(ws)


def run_all(ws: Workspace) -> DataFrame:
    for stage in (ingest, preprocess, train, drift_data):
        stage(ws)
    return scenario_table(ws)


STAGES = {"ingest": ingest, "preprocess": preprocess, "train": train, "evaluate": evaluate,
          "drift-data": drift_data, "monitor": monitor, "scenario-table": scenario_table,
          "compare-models": compare_models, "load-table": load_and_report, "all": run_all}
