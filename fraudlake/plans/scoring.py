"""Scoring request payloads, as a batch or as a stream."""

from pyspark.sql import DataFrame

from .. import config as C
from ..functions.expressions import score_columns, with_payload_defaults
from ..operators.evaluation import SCORE
from ..operators.features import PAIR, FeatureModel
from ..operators.models import add_score
from ..session import materialize, shared_dir


def score_requests(model, features: FeatureModel, requests: DataFrame, request_id: str,
                   payload: str, threshold: float = C.SCORE_THRESHOLD) -> DataFrame:
    """One scored row per JSON payload. Declared fields get their defaults; a feature
    that is not part of a request gets its learned median.

    Runs on ``readStream`` too if every learned table is within the broadcast bound; a larger one
    needs its hot keys counted first, which a stream can't give: an error then. Score such requests
    with ``score_request_stream``."""
    if requests.isStreaming and not all(features.small.values()):
        large = sorted(k for k, small in features.small.items() if not small)
        raise ValueError(f"learned tables beyond the broadcast bound: {large}; use foreachBatch")
    # further features may come as extra fields; what the model has not learned is not carried along
    used = {*features.feature_columns, C.AMOUNT, C.TIME, *PAIR}
    more = [c for c in (*C.ALL_FEATURES, C.TIME)
            if c in used and c not in C.REQUEST_DEFAULTS and c not in C.ENGINEERED_FEATURES and c != request_id]
    declared = {c: d for c, d in C.REQUEST_DEFAULTS.items() if c in used and c != request_id}
    rows = with_payload_defaults(requests.select(request_id, payload), payload, declared, more={
        c: "string" if c in C.CATEGORICAL_FEATURES else "double" for c in more})
    if not all(features.small.values()):
        rows = materialize(rows)  # a large lookup reads its rows several times; payloads are parsed once
    matrix = features.transform(rows, keep=(request_id,))
    scored = add_score(model, matrix, features.feature_columns)
    return scored.select(request_id, *[e.alias(n) for n, e in score_columns(SCORE, threshold).items()])


def score_request_stream(model, features: FeatureModel, requests: DataFrame, request_id: str, payload: str,
                         threshold: float = C.SCORE_THRESHOLD, folder: str | None = None) -> DataFrame:
    """Score all requests a stream holds, learned tables of any size included, and return them.

    Each trigger's rows are a batch of their own, so a large learned table can have its hot keys
    counted first. A batch is written to the folder that bears its number and overwrites what
    an interrupted attempt left there: a batch that runs again leaves its rows once. Called with
    the ``folder`` of an earlier run it goes on where that one ended."""
    spark = requests.sparkSession
    folder = folder or shared_dir(spark)

    def write(batch: DataFrame, number: int):
        scored = score_requests(model, features, batch, request_id, payload, threshold)
        scored.write.mode("overwrite").parquet(f"{folder}/data/batch={number}")

    query = (requests.select(request_id, payload).writeStream.foreachBatch(write)
             .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/data")
