import pytest
from pyspark.sql import functions as F

from fraudlake import config as C
from fraudlake.operators import features, splitting
from fraudlake.operators.features import FeatureEstimator, FeatureModel
from fraudlake.session import shared_dir


@pytest.fixture(scope="module")
def fitted(raw):
    return FeatureEstimator().fit(raw)


@pytest.fixture(scope="module")
def matrix(raw, fitted):
    return fitted.transform(raw, keep=(C.KEY,)).toPandas()


def test_feature_list_has_118_columns():
    assert len(C.NUMERIC_FEATURES) == 108 and len(C.ALL_FEATURES) == len(set(C.ALL_FEATURES)) == 118
    assert len(C.IDENTITY_COLUMNS) == 40


def test_engineered_columns_and_ranges(matrix):
    assert set(C.ENGINEERED_FEATURES) <= set(matrix.columns)
    assert (matrix["TransactionAmt_log"] >= 0).all()
    assert matrix["Transaction_hour"].between(0, 24, inclusive="left").all()
    assert matrix["Transaction_day"].between(0, 7, inclusive="left").all()
    assert (matrix["card1_addr1_count"] >= 1).all()


def test_no_nulls_target_kept_extras_dropped(matrix, fitted):
    assert not matrix.isna().any().any()
    assert "isFraud" in matrix and "isFraud" not in fitted.feature_columns
    assert "TransactionDT" not in matrix and "TransactionID" not in fitted.feature_columns
    assert (matrix["D2"] == 0.0).all()  # a column without values


def test_medians_equal_the_definition(raw, fitted, matrix):
    import numpy as np

    pdf = raw.toPandas()
    for c in ("TransactionAmt", "card1", "card2", "addr1", "C1", "D1"):
        assert fitted.medians[c] == pytest.approx(np.nanmedian(pdf[c].astype(float)))
    for c in ("ProductCD", "card4", "card6", "P_emaildomain", "card1_addr1_count"):
        assert fitted.medians[c] == matrix[c].median()


def test_codes_follow_sorted_categories(raw, fitted):
    codes = {r["category"]: r["code"] for r in fitted.codes.where("feature = 'card4'").collect()}
    assert codes == {"mastercard": 0, "unknown": 1, "visa": 2}


def test_unseen_null_and_literal_unknown_share_a_code(raw, fitted):
    odd = raw.limit(3).withColumn("ProductCD", F.lit("NEW")).unionByName(
        raw.limit(3).withColumn("ProductCD", F.lit(None).cast("string"))).unionByName(
        raw.limit(3).withColumn("ProductCD", F.lit("unknown")))
    got = {r[0] for r in fitted.transform(odd).select("ProductCD").distinct().collect()}
    assert got == {fitted.unknown["ProductCD"]}


def test_unseen_pair_counts_one_and_null_pairs_match(raw, fitted):
    new = raw.limit(5).withColumn("card1", F.lit(-1.0))
    assert {r[0] for r in fitted.transform(new).select("card1_addr1_count").collect()} == {1}
    pdf = raw.toPandas()
    null_pair = pdf[pdf.addr1.isna()].groupby("card1").size()
    got = fitted.transform(raw.where("addr1 IS NULL")).toPandas().groupby("card1")["card1_addr1_count"].first()
    assert {float(k): int(v) for k, v in null_pair.items()} == {float(k): int(v) for k, v in got.items()}


def test_absent_column_gets_the_learned_median(raw, fitted):
    out = fitted.transform(raw.drop("C1", "D1")).select("C1", "D1").distinct().collect()
    assert [tuple(r) for r in out] == [(fitted.medians["C1"], fitted.medians["D1"])]


def test_learned_medians_fill_an_empty_column(raw, fitted):
    out = fitted.transform(raw.withColumn("C1", F.lit(None).cast("double")))
    assert {r[0] for r in out.select("C1").collect()} == {fitted.medians["C1"]}


def test_use_before_fit_is_an_error(raw):
    with pytest.raises(RuntimeError):
        FeatureEstimator().transform(raw)
    with pytest.raises(RuntimeError):
        FeatureEstimator().save("x")


def test_save_and_load(spark, raw, fitted, matrix):
    path = shared_dir(spark)
    fitted.save(path)
    again = FeatureModel.load(spark, path)
    assert again.medians == fitted.medians and again.feature_columns == fitted.feature_columns
    assert again.transform(raw, keep=(C.KEY,)).toPandas().equals(matrix)
    with pytest.raises(FileNotFoundError):
        FeatureModel.load(spark, path + "-none")


def test_nothing_is_learned_from_the_test_split(raw):
    train, test = splitting.temporal_split(raw)
    a = FeatureEstimator().fit(train)
    b = FeatureEstimator()
    b.fit_transform(train)
    b.transform(test.withColumn("C1", F.lit(1e9)))
    assert a.medians == b.model.medians


def test_large_vocabulary_is_ranked_in_two_levels(spark):
    words = spark.range(500).select(F.lit("c").alias("feature"), F.sha1(F.col("id").cast("string")).alias(
        "category"), F.lit(1).cast("long").alias("n_rows"))
    got = {r["category"]: r["code"] for r in features.label_codes(words.repartition(7)).collect()}
    assert got == {c: i for i, c in enumerate(sorted(got))} and len(got) == 500


def test_absent_columns_have_the_same_type_as_present_ones(raw):
    train, test = splitting.temporal_split(raw)
    model = FeatureEstimator().fit(train)
    assert model.transform(test.drop("ProductCD", "card1", "C1")).dtypes == model.transform(test).dtypes
