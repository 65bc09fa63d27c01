import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from fraudlake import config as C
from fraudlake.operators import evaluation, models
from fraudlake.operators.features import FeatureModel
from fraudlake.operators.models import train as fit
from fraudlake.plans import stages
from fraudlake.plans.scoring import score_requests
from fraudlake.session import shared_dir
from fraudlake.sources import adapter
from fraudlake.streaming import dedup, replay, runner, windows


def replayed(requests, ttl):
    stored, out = {}, {}
    for t, i, k in sorted(requests):
        hit = k in stored and t - stored[k] <= ttl
        out[i] = hit
        if not hit:
            stored[k] = t
    return out


@pytest.mark.parametrize("ttl,chunk", [(1, 1), (60, 1), (60, 500), (3600, 1), (3600, 1 << 20)])
def test_cache_flags_equal_a_plain_replay(spark, ttl, chunk):
    r = random.Random(ttl)
    # a third of the requests have one key, and many share a second
    data = [(r.randrange(0, 20_000), i, "hot" if i % 3 == 0 else f"k{r.randrange(40)}") for i in range(3000)]
    df = spark.createDataFrame(data, "t long, id long, k string").repartition(6)
    got = {x["id"]: x["cached"] for x in replay.cache_flags(df, "k", "t", "id", ttl, chunk).collect()}
    assert got == replayed(data, ttl)


def test_cache_flags_of_odd_rows(spark):
    """Null keys are a key, a row without a time is no miss, negative times, an empty table."""
    rows = [(-5, 1, None), (-5, 0, None), (3600, 2, None), (3595, 3, None), (None, 4, "a"), (0, 5, "a")]
    df = spark.createDataFrame(rows, "t long, id long, k string")
    got = {x["id"]: x["cached"] for x in replay.cache_flags(df, "k", "t", "id", 3600, 1).collect()}
    assert got == {0: False, 1: True, 2: False, 3: True, 4: True, 5: False}
    assert replay.cache_flags(df.limit(0), "k", "t", "id").count() == 0


def test_ordered_stream_waits_for_rows_of_earlier_times(spark):
    """Rows out of order over five triggers, one key with a third of them; then one far too late."""
    r, base = random.Random(9), 1_700_000_000
    data = [(base + r.randrange(20_000), i, "hot" if i % 3 == 0 else f"k{r.randrange(9)}") for i in range(600)]
    order = sorted(data, key=lambda x: x[0] + r.randrange(-3000, 3000))
    late = (base - 50_000, 9999, "hot")
    path = shared_dir(spark)
    for rows in [*[order[i:i + 120] for i in range(0, 600, 120)], [late]]:
        spark.createDataFrame(rows, "t long, id long, k string").withColumn("ts", F.timestamp_seconds("t")).coalesce(
            1).write.mode("append").parquet(path)
    runner.with_state_store(spark)
    stream = spark.readStream.schema("t long, id long, k string, ts timestamp").option(
        "maxFilesPerTrigger", 1).parquet(path)
    out, ended = runner.run(replay.cache_flags_ordered(stream, "k", "t", "id", "ts", 3600, "2 hours", 60))
    closed = max(t for t, _, _ in data) - 7200
    want = {i: hit for i, hit in replayed(data, 3600).items()}
    got = {x.id: x.cached for x in out.collect()}
    assert got == {i: want[i] for t, i, _ in data if (t // 60 + 1) * 60 <= closed} and len(got) > 300
    assert runner.late_rows(ended) == 1 and len(ended.recentProgress) > 3


def test_a_stream_holds_blocks_not_keys(spark, monkeypatch):
    """Rows of one key in many blocks, repeated ones too: flags as of a plain replay, and every frame
    that a task hands out is of one block, in both streaming forms."""
    r = random.Random(3)
    data = [(r.randrange(30_000), i, "hot") for i in range(4000)]
    data += data[:200]
    df = spark.createDataFrame(data, "t long, id long, k string").withColumn("ts", F.timestamp_seconds("t"))
    path = shared_dir(spark)
    df.coalesce(1).write.parquet(path)
    runner.with_state_store(spark)

    class Timer:
        def getCurrentWatermarkInMs(self):
            return 20_000_500

    class Held(dict):
        def __init__(self):
            self.most = 0

        def getValue(self, key):
            return self[key]

        def updateValue(self, key, value):
            self[key] = value
            self.most = max(self.most, len(value[0]) if isinstance(value[0], bytes) else 0)

        containsKey, removeKey = dict.__contains__, dict.__delitem__

    class Value:
        def __init__(self):
            self.x = None

        def exists(self):
            return self.x is not None

        def get(self):
            return self.x

        def update(self, x):
            self.x = x

    class Handle:
        def __init__(self):
            self.states, self.timers = {}, set()

        def getMapState(self, name, *_):
            return self.states.setdefault(name, Held())

        def getValueState(self, name, *_):
            return Value()

        def listTimers(self):
            return list(self.timers)

        def registerTimer(self, at):
            self.timers.add(at)

    monkeypatch.setattr(replay, "BLOCK_ROWS", 100)
    handle, processor = Handle(), replay._Replay(("k", "t", "id"), 600, 60_000)
    processor.init(handle)
    rows = df.withColumn("ms", F.unix_millis("ts")).select("k", "t", "id", "ts", "ms").toPandas()
    assert list(processor.handleInputRows(("hot",), (rows[i:i + 50] for i in range(0, len(rows), 50)), Timer())) == []
    assert handle.states["blocks"].most <= 100 * 24
    frames = list(processor.handleExpiredTimer(("hot",), Timer(), None))
    assert max(map(len, frames)) <= 100

    def want(last):
        hits, stored = [], None
        for t, i, _ in sorted(data):
            hit = stored is not None and t - stored <= 600
            stored = stored if hit else t
            if t < last:
                hits.append((t, i, hit))
        return sorted(hits)

    assert sorted((int(t), int(i), bool(c)) for f in frames for t, i, c in f[["t", "id", "cached"]].itertuples(index=False)
                  ) == want(19_980)
    stream = spark.readStream.schema(df.schema).parquet(path)
    for out, last in ((replay.cache_flags_stream(stream, "k", "t", "id", "ts", 600), 10 ** 9),
                      (replay.cache_flags_ordered(stream, "k", "t", "id", "ts", 600, "1 hour"),
                       (max(t for t, _, _ in data) - 3600) // 60 * 60)):
        assert sorted((x.t, x.id, x.cached) for x in runner.drain(out).collect()) == want(last)


def test_a_trigger_is_flagged_batch_by_batch(monkeypatch):
    """A key's rows leave in the Arrow batches they came in, whatever the number of rows."""
    r, base = random.Random(8), 1_700_000_000
    data = [(base + r.randrange(20_000), i) for i in range(3000)]

    class State:
        hasTimedOut, exists, kept = False, False, None

        def update(self, x):
            self.kept = x

        def setTimeoutTimestamp(self, ms):
            self.timeout = ms

        def getCurrentWatermarkMs(self):
            return 0

    monkeypatch.setattr(replay, "BLOCK_ROWS", 64)
    frame = pd.DataFrame(data, columns=["t", "id"])
    frame["ts"], state = pd.to_datetime(frame["t"], unit="s"), State()
    flags = replay._trigger_flags("k", "t", "id", "ts", 300)
    frames = list(flags(("a",), (frame[i:i + 50] for i in range(0, 3000, 50)), state))
    assert len(frames) == 60 and max(map(len, frames)) == 50
    want = replayed([(t, i, "a") for t, i in data], 300)
    assert {int(i): bool(c) for f in frames for i, c in zip(f["id"], f["cached"])} == want
    assert state.kept == (max(t for t, i in data if not want[i]),)


def test_windowed_scores_meet_each_request_once(spark):
    """Payloads that occur once make one row each for the join, whatever the number of salts."""
    df = spark.range(500).select("id", F.col("id").alias("x"), F.lit("p").alias("p"), F.timestamp_seconds("id").alias("ts"))
    df = df.withColumn("request", F.concat("p", F.col("x").cast("string")))
    out = dedup.score_distinct_windowed(df, "request", ["x"], F.col("x").cast("double"), "ts", salts=16)
    assert out.count() == 500
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan  # the salts of a payload come from its requests
    with pytest.raises(ValueError):
        dedup.score_distinct_windowed(df, "request", ["x"], F.col("x"), "ts", salts=64)


def test_windowed_scores_of_a_hot_payload(spark):
    """Batch and stream, a payload in most requests; repeated rows are requests of their own."""
    r = random.Random(4)
    rows = [(i, None if i % 9 == 0 else (1 if i % 3 else r.randrange(5)), r.randrange(6 * 3600)) for i in range(800)]
    df = spark.createDataFrame([*rows, rows[0]], "id long, x int, t long").withColumn("ts", F.timestamp_seconds("t"))
    df = df.withColumn("request", F.coalesce(F.col("x").cast("string"), F.lit("none")))
    path = shared_dir(spark)
    df.repartition(3).write.parquet(path)
    score = F.coalesce(F.col("x"), F.lit(0)).cast("double") / 10

    def scored(frame):
        out = dedup.score_distinct_windowed(frame, "request", ["x"], score, "ts", salts=4)
        return runner.drain(out) if frame.isStreaming else out

    same = {}
    for _, x, t in [*rows, rows[0]]:
        same[x, t // 3600] = same.get((x, t // 3600), 0) + 1
    end = max(t for _, _, t in rows) - 3600
    for frame, last in ((df, 10 ** 9), (spark.readStream.schema(df.schema).parquet(path), end)):
        want = sorted((i, (x or 0) / 10, same[x, t // 3600]) for i, x, t in [*rows, rows[0]] if (t // 3600 + 1) * 3600 <= last)
        assert sorted((g.id, g.score, g.n_same) for g in scored(frame).collect()) == want


def stream_dir(spark, sf, parts=4):
    """The events in several files, oldest first."""
    path = shared_dir(spark)
    events = spark.read.parquet(f"{sf}/events.parquet")
    lo, hi = events.agg(F.min("event_id"), F.max("event_id")).first()
    for p in range(parts):
        a, b = lo + (hi + 1 - lo) * p // parts, lo + (hi + 1 - lo) * (p + 1) // parts
        events.where((F.col("event_id") >= a) & (F.col("event_id") < b)).coalesce(1).write.mode(
            "append").parquet(path)
    return path, events.schema


def stream(spark, sf, *columns):
    path, schema = stream_dir(spark, sf)
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    return adapter.transactions_of(events, None, *columns, time=True).withColumn(
        "ts", F.col("ts").cast("timestamp"))


def test_streaming_cache_flags_over_several_triggers(spark, sf):
    cols = (C.KEY, C.TIME, "ProductCD")
    live = runner.drain(replay.cache_flags_stream(stream(spark, sf, *cols), "ProductCD", C.TIME, C.KEY, "ts"))
    batch = replay.cache_flags(adapter.transactions(spark, sf, *cols), "ProductCD", C.TIME, C.KEY)
    assert sorted(live.select(C.KEY, "cached").collect()) == sorted(batch.select(C.KEY, "cached").collect())


def test_streaming_windows_equal_the_closed_batch_windows(spark, sf):
    cols = ("TransactionAmt", "isFraud", "D1")
    at = F.col("ts").cast("timestamp")
    batch_rows = adapter.transactions(spark, sf, *cols, time=True).withColumn("ts", at)
    closed = batch_rows.agg(F.max("ts") - F.expr("INTERVAL 1 HOUR")).first()[0]
    end = F.col("window_start") + F.expr("INTERVAL 1 DAY")
    ref = windows.reference_moments(batch_rows, ["TransactionAmt", "D1"])
    for fn in (lambda d: windows.windowed_rate(d, "ts", "1 day"),
               lambda d: windows.windowed_drift(d, "ts", "1 day", ref)):
        live = runner.drain(fn(stream(spark, sf, *cols)))
        batch = fn(batch_rows).where(end <= F.lit(closed))
        key = [c for c in ("window_start", "feature") if c in batch.columns]
        a = live.orderBy(*key).toPandas()
        b = batch.orderBy(*key).toPandas()
        assert len(a) == len(b) > 0
        assert (a[key].to_numpy() == b[key].to_numpy()).all()
        assert (a["n"] == b["n"]).all()


@pytest.fixture(scope="module")
def ws(spark, raw):
    root, csv, ident = shared_dir(spark), shared_dir(spark), shared_dir(spark)
    raw.write.option("header", True).csv(csv)
    raw.where("TransactionID % 4 = 0").select(
        C.KEY, F.lit(1.5).alias("id_01"), F.lit("mobile").alias("DeviceType")).write.option("header", True).csv(ident)
    return stages.Workspace(spark, root, csv, ident, "logistic-regression", maxIter=5)


def test_stages_run_what_is_missing(ws):
    with pytest.raises(FileNotFoundError):
        stages.monitor(ws)
    stages.train(ws)  # runs ingest and preprocess first
    assert ws.has("raw_train", "raw_test", "train", "test", "reference", "model/metadata", "metrics")
    s = ws.spark.read.json(ws.path("ingestion_summary")).first()
    assert (s["train_rows"], s["test_rows"], s["merged_rows"], s["identity_rows"]) == (80, 20, 100, 25)
    assert s["row_count_preserved"] and s["merged_columns"] == 16
    assert ws.table("test").where("ProductCD IS NULL OR TransactionAmt IS NULL").isEmpty()


def test_drift_scenarios_through_the_stages(ws):
    stages.drift_data(ws)
    for name in stages.SCENARIOS:
        stages.monitor(ws, f"drifted_{name}")
    got = {r["current"]: r for r in stages.compare_scenarios(ws).collect()}
    assert got["drifted_a"]["drift_detected"] and got["drifted_a"]["number_of_drifted_features"] > 5
    assert got["drifted_b"]["number_of_drifted_features"] == 0
    assert got["drifted_c"]["number_of_drifted_features"] == 0


def test_reports_over_the_loaded_table(ws):
    got = {k: v.collect() for k, v in stages.load_table(ws, "reports_under_test").items()}
    assert got["summary"][0]["total_rows"] == 100
    assert sum(r["txn_count"] for r in got["fraud_rate_by_product"]) == 100
    assert set(got) == {"fraud_rate_by_product", "amount_by_fraud", "fraud_rate_by_card_type",
                        "c_features_fraud_vs_legit", "summary"}


def test_requests_are_scored_with_defaults(ws, spark):
    model, features = stages.load_model(ws), FeatureModel.load(spark, ws.path("feature_model"))
    df = spark.createDataFrame([(1, "{}"), (2, '{"TransactionAmt": 900.5, "card1": 1001, "extra": true}'),
                                (3, '{"ProductCD": "NEVER", "TransactionDT": 7200}')], "id long, body string")
    rows = score_requests(model, features, df, "id", "body").collect()
    assert sorted(r["id"] for r in rows) == [1, 2, 3]
    for r in rows:
        assert 0 <= r["fraud_probability"] <= 1 and r["confidence"] >= 0.5
        assert r["is_fraud"] == (r["fraud_probability"] >= 0.5)


def test_models_are_compared_on_rows_dealt_once(ws):
    params = {"logistic-regression": {"maxIter": 5}, "random-forest": {"numTrees": 3, "maxDepth": 2},
              "gbt": {"maxIter": 2, "maxDepth": 2}}
    got = stages.compare_models(ws, params).collect()
    assert {r["model"] for r in got} == set(params)
    areas = [r["auc_roc"] for r in got]
    assert areas == sorted(areas, reverse=True)
    alone = evaluation.evaluate(models.scored_labels(
        fit("logistic-regression", ws.table("train"), maxIter=5), ws.table("test"),
        models.feature_names(ws.table("train")))).first()
    together = next(r for r in got if r["model"] == "logistic-regression")
    assert abs(together["auc_roc"] - alone["auc_roc"]) < 1e-9


def test_scenario_table_and_written_reports(ws):
    got = {r["current"]: r for r in stages.STAGES["scenario-table"](ws).collect()}
    assert set(got) == {f"drifted_{s}" for s in stages.SCENARIOS}
    for r in got.values():
        assert (r["reference_rows"], r["current_rows"]) == (80, ws.table(r["current"]).count())
    stages.STAGES["load-table"](ws)
    assert ws.spark.read.json(ws.path("reports/summary")).first()["total_rows"] == 100


def test_tree_models_fit(ws):
    for kind, params in (("gbt", {"maxIter": 2, "maxDepth": 2}), ("random-forest", {"numTrees": 3, "maxDepth": 2})):
        m = fit(kind, ws.table("train"), **params)
        assert m.getOrDefault("featuresCol") and len(m.trees) == (params.get("maxIter") or params["numTrees"])
    with pytest.raises(ValueError):
        fit("other", ws.table("train"))


def test_rolling_ranking_equals_a_plain_count_of_every_window(spark):
    r = random.Random(12)
    hours = [0, 0, 1, 2, 2, 2, 3, 7, 9, 9]  # a gap, and a third of the rows in one pane
    rows = [(3600 * r.choice(hours) + r.randrange(3600), r.choice([0, 0, 1, None]), r.choice(
        [r.random(), 0.5, 1.0, 0.0, -3.0, 7.0, None, float("nan")])) for _ in range(600)]
    df = spark.createDataFrame(rows, "s long, isFraud int, score double").withColumn(
        "ts", F.timestamp_seconds("s"))
    counts = windows.score_counts(df, "ts", "1 hour", steps=10)
    assert counts.count() <= 6 * 11
    half = [windows.score_counts(df.where(c), "ts", "1 hour", steps=10) for c in ("s % 2 = 0", "s % 2 = 1")]
    for source in (counts, half[0].unionByName(half[1])):  # counters of two tables add up
        got = {x["w"]: x for x in windows.rolling_ranking(source, "1 hour", 3).withColumn(
            "w", F.unix_timestamp("window_start") / 3600).collect()}
        known = [(s // 3600, y, int(min(max(p, 0.0), 1.0) * 10)) for s, y, p in rows
                 if y is not None and p is not None and p == p]
        assert set(got) == {h - i for h, _, _ in known for i in range(3)}
        for w, row in got.items():
            inside = [(y, b) for h, y, b in known if w <= h < w + 3]
            pos, neg = [b for y, b in inside if y], [b for y, b in inside if not y]
            wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
            assert (row["positives"], row["negatives"]) == (len(pos), len(neg))
            assert row["auc_roc"] == (pytest.approx(wins / (len(pos) * len(neg))) if pos and neg else None)
            ap = sum(pos.count(t) / len(pos) * sum(b >= t for b in pos) / sum(b >= t for _, b in inside)
                     for t in set(pos)) if pos else None
            assert row["average_precision"] == (pytest.approx(ap) if pos else None)
    assert windows.rolling_ranking(counts.limit(0), "1 hour", 3).count() == 0
