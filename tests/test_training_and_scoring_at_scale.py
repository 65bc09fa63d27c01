"""Steps that must not be repeated a column, a pass or a partition too often."""

from pyspark.sql import functions as F

from fraudlake import config as C
from fraudlake.functions import expressions
from fraudlake.operators import features, models, quantiles
from fraudlake.plans import queries_model, scoring


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_pass_writes_its_bucket_once_for_all_columns(spark):
    df = spark.range(50).select(*[(F.col("id") * i).cast("double").alias(f"c{i}") for i in range(12)])
    cells = [(F.lit(i * quantiles.SPAN).cast("long"), F.col(c)) for i, c in enumerate(df.columns)]
    assert plan_of(quantiles._count(df, cells, None, quantiles._first_bucket)).upper().count("LOG2") < len(df.columns)
    assert quantiles.exact_quantiles(df, {c: F.col(c) for c in df.columns}, [0.5])["c3"] == [73.5]


def test_the_joined_view_is_written_once_for_all_passes(spark, sf):
    train, test = queries_model.split(spark, sf)
    assert "Join" not in plan_of(train) and "Join" not in plan_of(test)


def test_payloads_are_parsed_once_for_a_large_lookup(spark, raw):
    fitted = features.FeatureEstimator().fit(raw)
    model = models.train("logistic-regression", fitted.transform(raw), fitted.feature_columns, maxIter=3)
    fields = [c for c in raw.columns if c not in (C.KEY, C.TARGET)]
    requests = raw.select(C.KEY, F.to_json(F.struct(*fields)).alias("payload"))
    want = scoring.score_requests(model, fitted, requests, C.KEY, "payload")
    assert "from_json" in plan_of(want)
    fitted.small = dict.fromkeys(fitted.small, False)
    got = scoring.score_requests(model, fitted, requests, C.KEY, "payload")
    assert "from_json" not in plan_of(got)
    assert sorted(got.collect()) == sorted(want.collect())


def test_a_large_lookup_moves_learned_columns_only(spark, raw, monkeypatch):
    fitted = features.FeatureEstimator().fit(raw)
    model = models.train("logistic-regression", fitted.transform(raw), fitted.feature_columns, maxIter=3)
    fields = [c for c in raw.columns if c not in (C.KEY, C.TARGET)]
    requests = raw.select(C.KEY, F.to_json(F.struct(*fields, F.lit(5).alias("V99"))).alias("payload"))
    want = scoring.score_requests(model, fitted, requests, C.KEY, "payload").collect()
    fitted.small, written, write = dict.fromkeys(fitted.small, False), [], scoring.materialize
    monkeypatch.setattr(scoring, "materialize", lambda df: written.append(df.columns) or write(df))
    got = scoring.score_requests(model, fitted, requests, C.KEY, "payload").collect()
    assert sorted(got) == sorted(want)
    learned = {*fitted.feature_columns, C.KEY, C.TIME}
    assert set(written[0]) <= learned and "V99" not in written[0]


def test_small_training_tables_are_dealt_finely():
    assert [models.partitions_for(n) for n in (0, 10_000, 80_000, 2_400_000, 28_800_000)] == [1, 1, 8, 24, 116]


def test_scoring_reads_single_fields_and_not_all_extras(spark, raw):
    fitted = features.FeatureEstimator().fit(raw)
    model = models.train("logistic-regression", fitted.transform(raw), fitted.feature_columns, maxIter=3)
    requests = spark.createDataFrame(
        [(1, '{"TransactionAmt": "5", "V1": 2, "R_emaildomain": "gmail.com", "V99": {"a": [1]}}'), (2, "{}"), (3, None),
         (4, '{"V1": "x", "note": null}'), (5, "no json")], f"{C.KEY} long, payload string")
    got = scoring.score_requests(model, fitted, requests, C.KEY, "payload")
    assert got.count() == 5 and "array_contains" not in plan_of(got) and plan_of(got).count("from_json") == 1
    more = {"V1": "double", "R_emaildomain": "string", "V99": "string"}
    rows = expressions.with_payload_defaults(requests, "payload", more=more).collect()
    kept = expressions.with_payload_defaults(requests, "payload").collect()
    assert [r.V1 for r in rows] == [2.0, None, None, None, None] and rows[0].R_emaildomain == "gmail.com"
    for r, k in zip(rows, kept):
        assert r.V99 == (k.extras or {}).get("V99") and r.TransactionAmt == k.TransactionAmt


def test_numbers_of_a_payload_are_cast_in_one_step(spark):
    requests = spark.createDataFrame(
        [(1, '{"C1": "5", "C2": 1e3, "C3": "x", "C4": true, "C5": {"a": 1}, "card4": 7, "V1": null, "note": 1}'), (2, "{}"),
         (3, None), (4, '{"C1": 1, "C1": 2}'), (5, '[{"C1": 5}]')], "id long, payload string")
    got = expressions.with_payload_defaults(requests, "payload", {"C1": 0.5, "C2": 0.0, "C3": 0.0, "C4": 0.0, "C5": 0.0,
                                                                  "card4": "visa"}, more={"V1": "double"})
    assert plan_of(got).count("cast(") <= 2
    assert [tuple(r) for r in got.collect()] == [
        (1, 5.0, 1000.0, 0.0, 0.0, 0.0, "7", None), (2, 0.5, 0.0, 0.0, 0.0, 0.0, "visa", None),
        (3, 0.5, 0.0, 0.0, 0.0, 0.0, "visa", None), (4, 1.0, 0.0, 0.0, 0.0, 0.0, "visa", None),
        (5, 0.5, 0.0, 0.0, 0.0, 0.0, "visa", None)]
    assert expressions.with_payload_defaults(requests, "payload").first().extras == {"V1": None, "note": "1"}


def test_requests_are_read_from_the_written_view(spark, sf):
    _, _, rows = queries_model._scorer(spark, sf)
    assert "Join" not in plan_of(rows) and rows.columns == queries_model._REQUEST_COLUMNS
    assert rows.exceptAll(queries_model.txn(spark, sf, *rows.columns)).isEmpty()
    assert rows.count() == spark.read.parquet(f"{sf}/events.parquet").count()
