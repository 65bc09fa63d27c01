import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudlake import config as C
from fraudlake.functions import expressions as X
from fraudlake.operators import aggregates, drift, evaluation, joins, profile, scenarios, splitting, stats
from fraudlake.operators.quantiles import exact_quantiles
from fraudlake.operators.reference import ReferenceProfile
from fraudlake.plans import reports
from fraudlake.sources import readers, schema, sinks
from fraudlake.session import shared_dir


def column(df, e):
    return [r[0] for r in df.select(e).collect()]


# ---- sources

def test_validation_names_what_is_missing(raw):
    schema.require_columns(raw, C.REQUIRED_TRANSACTION_COLUMNS, "transactions")
    with pytest.raises(ValueError, match="isFraud"):
        schema.require_columns(raw.drop("isFraud"), C.REQUIRED_TRANSACTION_COLUMNS, "transactions")


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert column(readers.nan_to_null(df), "x") == [1.0, None, None]


def test_csv_round_trip_and_fallback(spark, raw):
    path, processed = shared_dir(spark), shared_dir(spark)
    raw.write.option("header", True).csv(path)
    back, source = readers.read_first_available(spark, path, processed)
    assert source == "raw_csv" and back.count() == 100
    assert back.where("D1 IS NULL").count() == raw.where("D1 IS NULL").count()
    sinks.write_parquet(raw, processed)
    assert readers.read_first_available(spark, path + "x", processed)[1] == "processed_parquet"
    with pytest.raises(FileNotFoundError):
        readers.read_first_available(spark, path + "x", processed + "x")


def test_database_types(raw):
    kinds = {f.name: schema.sql_type(f.dataType) for f in raw.schema}
    assert (kinds["isFraud"], kinds["TransactionAmt"], kinds["card4"]) == ("BIGINT", "DOUBLE", "VARCHAR(64)")
    assert "`TransactionAmt` DOUBLE" in schema.create_table_sql(raw, "t")


# ---- expressions

def test_bins_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 0.01, 50.0, 50.01, 5000.0, 5001.0, None)], "x double")
    got = column(df, X.bin_label(X.right_closed_bin("x", C.AMOUNT_EDGES), C.AMOUNT_LABELS))
    assert got == [None, None, "$0-50", "$0-50", "$50-100", "$1K-5K", "$5K+", None]


def test_time_before_the_origin_stays_in_range(spark):
    df = spark.createDataFrame([(-1,), (0,), (90_000,)], "t long")
    assert column(df, X.hour_bin("t")) == [23, 0, 1]
    assert all(0 <= v < 7 for v in column(df, X.day_of_week("t")))


def test_thousandths_truncate_towards_zero(spark):
    df = spark.createDataFrame([(12.345678,), (-1.5,), (None,)], "x double")
    assert column(df, X.thousandths("x")) == [345, -500, None]


def test_score_output_cases(spark):
    df = spark.createDataFrame([(0.8,), (0.1,), (0.49999,), (0.5,)], "p double")
    got = [tuple(r) for r in df.select(*X.score_columns("p").values()).collect()]
    assert got == [(0.8, True, 0.8), (0.1, False, 0.9), (0.5, False, 0.5), (0.5, True, 0.5)]


def test_payload_defaults(spark):
    df = spark.createDataFrame([("{}",), ('{"card4": "amex", "C1": 3, "other": "x", "D1": null}',)], "p string")
    a, b = X.with_payload_defaults(df, "p").collect()
    assert (a["TransactionAmt"], a["card4"], a["ProductCD"], a["extras"]) == (100.0, "visa", "W", {})
    assert (b["card4"], b["C1"], b["D1"], b["extras"]) == ("amex", 3.0, 0.0, {"other": "x"})


def test_payload_key_ignores_column_order(raw):
    a = raw.select(X.payload_key(["card1", "addr1", "card6"]).alias("k"))
    b = raw.select(X.payload_key(["card6", "card1", "addr1"]).alias("k"))
    assert a.collect() == b.collect()


# ---- joins

def test_absent_identity_passes_through_and_duplicates_are_an_error(spark, raw):
    assert joins.attach_identity(raw, None) is raw
    ident = raw.where("TransactionID % 4 = 0").select("TransactionID", F.lit("m").alias("DeviceType"))
    assert joins.attach_identity(raw, ident).count() == 100
    with pytest.raises(RuntimeError):
        joins.attach_identity(raw, ident.unionByName(ident))


@pytest.mark.parametrize("small", [True, False])
def test_lookup_small_and_large_with_a_hot_key(spark, small):
    left = spark.range(4000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(None).cast("long")).when(F.col("id") % 3 == 1, 7)
        .otherwise(F.col("id")).alias("k"))
    table = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).unionByName(
        spark.createDataFrame([(None, -5)], "k long, v long"))
    got = {r["id"]: r["v"] for r in joins.lookup(left, table, ["k"], small).collect()}
    assert len(got) == 4000
    for i in range(4000):
        assert got[i] == (-5 if i % 3 == 0 else 14 if i % 3 == 1 else 2 * i if i < 3000 else None)


# ---- aggregates, statistics

def test_empty_and_single_class_inputs(spark, raw):
    empty = raw.limit(0)
    assert aggregates.overall(empty).first()["total_rows"] == 0
    assert aggregates.rate_by(empty, "ProductCD").count() == 0
    assert profile.missing_profile(empty).count() == 0
    one = raw.where("isFraud = 0")
    assert aggregates.median_ratio(one).first()["ratio"] is None
    row = evaluation.ranking_metrics(one.withColumn("score", F.lit(0.3))).first()
    assert row["auc_roc"] is None
    splitting.mark_split(empty).collect()


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(i, float(i % 5), 2.0, None, i % 2) for i in range(40)],
                               "id long, a double, b double, n double, isFraud int")
    r = {(x["feature_a"], x["feature_b"]): x["corr"] for x in stats.corr_matrix(df, ["a", "b", "n"]).collect()}
    assert list(r.values()) == [None, None, None]
    out = {x["feature"]: x for x in stats.iqr_outliers(df, ["a", "b", "n"]).collect()}
    assert out["n"]["outliers"] == 0 and out["n"]["q1"] is None
    shift = {x["feature"]: x for x in drift.mean_shift(df, df.withColumn("b", F.lit(3.0)), ["a", "b", "n"]).collect()}
    assert shift["b"]["drifted"] and not shift["a"]["drifted"] and not shift["n"]["drifted"]
    assert shift["n"]["ref_mean"] == 0.0


def test_pairwise_correlation_equals_pandas(raw):
    cols = ["TransactionAmt", "card1", "card2", "addr1", "C1", "D1", "isFraud"]
    want = raw.select(cols).toPandas().astype(float).corr()
    for r in stats.corr_matrix(raw, cols).collect():
        assert r["corr"] == pytest.approx(want.loc[r["feature_a"], r["feature_b"]], abs=1e-9)


def test_histogram_integrates_to_one(raw):
    h = stats.density_histogram(raw, X.log_amount(C.AMOUNT)).toPandas()
    for _, g in h.groupby("isFraud"):
        width = (g.left_edge.iloc[-1] - g.left_edge.iloc[0]) / (g.bin.iloc[-1] - g.bin.iloc[0])
        assert (g.density * width).sum() == pytest.approx(1.0)


# ---- splits and scenarios

@pytest.mark.parametrize("parts", [1, 7, 32])
def test_split_is_temporal_and_stable(raw, parts):
    train, test = splitting.temporal_split(raw.repartition(parts))
    assert (train.count(), test.count()) == (80, 20)
    assert train.agg(F.max(C.TIME)).first()[0] <= test.agg(F.min(C.TIME)).first()[0]


def test_label_drift_flips_exactly(raw):
    before = raw.where("isFraud = 1").count()
    flipped = scenarios.label_drift(raw)
    assert flipped.where("isFraud = 1").count() == before + int(0.15 * (100 - before))
    assert flipped.drop("isFraud").exceptAll(raw.drop("isFraud")).isEmpty()


def test_noise_is_standard_normal_and_repeatable(spark):
    df = spark.range(20_000).select("id", scenarios.standard_normal("id", "x").alias("z"))
    m = df.agg(F.avg("z"), F.stddev("z"), F.max(F.abs("z"))).first()
    assert abs(m[0]) < 0.03 and abs(m[1] - 1) < 0.03 and 3 < m[2] < 6
    assert df.repartition(9).agg(F.sum("z")).first()[0] == pytest.approx(df.agg(F.sum("z")).first()[0])


def test_wasserstein_of_a_shift_is_the_shift(raw):
    moved = raw.withColumn(C.AMOUNT, F.col(C.AMOUNT) + 12.5)
    got = {r["feature"]: r["distance"] for r in drift.wasserstein(raw, moved, [C.AMOUNT, "C1"]).collect()}
    assert got[C.AMOUNT] == pytest.approx(12.5) and got["C1"] == 0.0


def test_a_lost_column_is_drift_and_every_column_is_reported(raw):
    lost = raw.withColumn("C1", F.lit(None).cast("double"))
    got = {r["feature"]: (r["distance"], r["status"]) for r in drift.wasserstein(raw, lost, ["C1", "D1", "D2"]).collect()}
    assert got == {"C1": (None, "lost"), "D1": (0.0, "ok"), "D2": (None, "empty")}
    tests = {r["feature"]: r["drifted"] for r in drift.column_tests(raw, lost, ["C1", "D1", "D2"], ["card4"]).collect()}
    assert tests == {"C1": True, "D1": False, "D2": False, "card4": False}
    psi = {r["feature"]: r["psi"] for r in drift.psi_numeric(raw, raw, ["D1", "D2"]).collect()}
    assert psi == {"D1": 0.0, "D2": None}


# ---- metrics

def test_metrics_on_ties(spark):
    df = spark.createDataFrame([(i % 2, 0.5) for i in range(10)], "isFraud int, score double")
    r = evaluation.evaluate(df).first()
    assert (r["auc_roc"], r["average_precision"], r["recall"], r["accuracy"]) == (0.5, 0.5, 1.0, 0.5)


def test_curves_against_a_plain_loop(spark, raw):
    df = raw.withColumn("score", F.pmod(F.hash("TransactionID"), F.lit(20)) / 20.0)
    data = [(r["score"], r["isFraud"]) for r in df.select("score", "isFraud").collect()]
    p, n = sum(y for _, y in data), sum(1 - y for _, y in data)
    wins = sum((a > b) + 0.5 * (a == b) for a, y in data if y for b, z in data if not z)
    ap, last = 0.0, 0.0
    for t in sorted({s for s, _ in data}, reverse=True):
        tp = sum(y for s, y in data if s >= t)
        k = sum(1 for s, _ in data if s >= t)
        ap, last = ap + (tp / p - last) * tp / k, tp / p
    m = evaluation.ranking_metrics(df).first()
    assert m["auc_roc"] == pytest.approx(wins / (p * n)) and m["average_precision"] == pytest.approx(ap)
    roc = evaluation.roc_curve(df).where("threshold IS NOT NULL").toPandas()
    assert math.isclose(roc.tpr.max(), 1.0) and math.isclose(roc.fpr.max(), 1.0)


@pytest.mark.parametrize("buckets", [2, 20, 1000])
def test_quantiles_between_shared_values(spark, buckets):
    # half the values are the smallest one, nearly half the largest, the ranks lie around and between
    values = [0.0] * 1000 + [float(i * i % 997) + i / 1000 for i in range(1, 301)] + [1e6] * 990
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    probs = [0.0, 0.25, 0.43, 0.45, 0.5, 0.57, 0.9, 1.0]
    got = exact_quantiles(df, {"x": F.col("x")}, probs, buckets=buckets)["x"]
    assert np.allclose(got, np.quantile(values, probs))


def test_a_categorical_column_without_values_keeps_its_row(spark):
    df = spark.createDataFrame([(1.0, "a", None), (2.0, "b", None)], "x double, c string, nothing string")
    got = {r["feature"]: r for r in drift.column_tests(df, df, ["x"], ["c", "nothing"]).collect()}
    assert set(got) == {"x", "c", "nothing"} and got["nothing"]["value"] is None and not got["nothing"]["drifted"]
    assert got["c"]["value"] == 0.0
    assert {r["feature"] for r in drift.column_tests(df, df, ["x"], []).collect()} == {"x"}


def test_reports_of_one_scan_equal_the_single_ones(spark):
    r = random.Random(4)
    names = [None, "a", "b", "c"]
    rows = [(i * 977, r.choice([None, -1.0, 0.0, 5.0, 75.5, 9e4]), r.choice([None, 0, 0, 1]), r.choice(names),
             r.choice(names), r.choice(names), r.random()) for i in range(400)]
    df = spark.createDataFrame(rows, "TransactionDT long, TransactionAmt double, isFraud int, ProductCD string,"
                                     " card4 string, card6 string, C1 double")
    made = reports.Reports(df)
    pairs = [
        (made.rate_by("ProductCD"), aggregates.rate_by(df, "ProductCD")),
        (made.rate_by("card6", False), aggregates.rate_by(df, "card6", False)),
        (made.amount_by_class(), aggregates.amount_by_class(df)), (made.means_by_class(), aggregates.means_by_class(df, ["C1"])),
        (made.overall(), aggregates.overall(df)), (made.rate_by_amount_bin(), aggregates.rate_by_amount_bin(df)),
        (made.rate_by_hour(), aggregates.rate_by_hour(df)), (made.hour_class_counts(), aggregates.hour_class_counts(df)),
        (made.product_share(), aggregates.product_share(df)), (made.rate_topk("card4", 2), aggregates.rate_topk(df, "card4", 2))]
    for got, want in pairs:
        assert got.columns == want.columns

        def order(f):
            return sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in x) for x in f.collect()], key=repr)
        assert order(got) == order(want)
    plan = reports.report_counts(df)._jdf.queryExecution().toString()
    assert plan.count("+- Exchange") <= 1 and plan.count("Expand [") >= 1
    assert reports.Reports(df.limit(0)).rate_by("card6").count() == 0
    assert reports.Reports(df.limit(0)).overall().first()["total_rows"] == 0


def test_a_stored_profile_gives_the_tests_of_the_whole_reference(spark):
    r = random.Random(6)
    rows = [(i, r.choice([None, 0.0, r.gauss(0, 3), 7.0]), float(r.randrange(5)), None, r.choice(["a", "b", None]),
             None) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, x double, y double, void double, c string, none string")
    path, source = shared_dir(spark), shared_dir(spark)
    df.write.parquet(source)
    ref, cur = spark.read.parquet(source).where("id < 600"), df.where("id >= 500").withColumn("x", F.col("x") + 1)
    numeric, cats = ["x", "y", "void"], ["c", "none"]
    whole = ReferenceProfile.build(ref, numeric, cats)
    first = ReferenceProfile.build(ref.where("id < 100"), numeric, cats)
    parts = first.merge(ReferenceProfile.build(ref.where("id >= 100"), (), like=first))
    whole.save(path)
    stored = ReferenceProfile.load(spark, path)
    want = {x["feature"]: x.asDict() for x in drift.column_tests(ref, cur, numeric, cats).collect()}
    shift = {x["feature"]: x.asDict() for x in drift.mean_shift(ref, cur, numeric).collect()}
    for profile in (whole, parts, stored):
        tests = profile.column_tests(cur)
        assert not any(source in f for f in tests.inputFiles())  # the reference is not read
        got = {x["feature"]: x.asDict() for x in tests.collect()}
        assert set(got) == set(want) == {*numeric, *cats}
        for c, row in want.items():
            assert got[c]["value"] == (None if row["value"] is None else pytest.approx(row["value"]))
            assert {k: v for k, v in got[c].items() if k != "value"} == {k: v for k, v in row.items() if k != "value"}
        assert {x["feature"]: x.asDict() for x in profile.mean_shift(cur).collect()} == shift
        assert profile.n_rows == 600
    with pytest.raises(ValueError):
        whole.merge(ReferenceProfile.build(cur, numeric, cats))
    empty = ReferenceProfile.build(ref.limit(0), numeric, cats)
    lost = {x["feature"]: x["drifted"] for x in empty.column_tests(cur).collect()}
    assert set(lost) == {*numeric, *cats} and lost["x"] and lost["y"] and not lost["void"] and empty.n_rows == 0
    assert ReferenceProfile.build(ref, ["x"]).column_tests(cur).count() == 1


def test_a_failed_load_leaves_the_table_and_a_new_one_replaces_it(spark):
    name, root = "load_under_test", shared_dir(spark)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = spark.range(10).withColumn("x", F.col("id") * 1.5)
    first = sinks.load_table([df, df], name, root)
    assert first.count() == 20 and first.columns == ["id", "x"]
    broken = df.withColumn("x", F.when(F.col("id") > 5, F.raise_error(F.lit("lost")).cast("double")).otherwise(0.0))
    with pytest.raises(Exception, match="lost"):
        sinks.load_table([df, broken], name, root)
    assert spark.table(name).agg(F.count("x"), F.sum("x")).first() == (20, 135.0)
    assert sinks.load_table([df.where("id < 3")], name, root).count() == 3 == spark.table(name).count()
    wider = sinks.load_table([df.withColumn("y", F.lit("new"))], name, root)
    assert wider.columns == ["id", "x", "y"] and spark.table(name).count() == 10
    spark.sql(f"DROP TABLE {name}")
