"""Boosted trees next to MLlib's own, counted in one task and in jobs."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from fraudlake import config as C
from fraudlake.operators import boosting, models
from fraudlake.plans import queries_model, registry  # noqa: F401  (the first registers its queries)

SETTINGS = {"maxIter": 4, "maxDepth": 4, "stepSize": 0.3, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.7",
            "minInstancesPerNode": 5, "seed": 7}


@pytest.fixture(scope="module")
def matrix(spark):
    r, rows = random.Random(3), []
    for _ in range(3_000):
        x = [r.gauss(0, 1) for _ in range(5)]
        rows.append((*x, 1.5, int(x[0] * x[1] + 0.5 * x[2] + 0.3 * r.gauss(0, 1) > 0.6)))
    return spark.createDataFrame(rows, f"C1 double, C2 double, C3 double, C4 double, C5 double, C6 double, {C.TARGET} int").cache()


def learner(**params):
    return GBTClassifier(labelCol=C.TARGET, featuresCol=models.VECTOR, weightCol=models.WEIGHT, **{**SETTINGS, **params})


def weighted(data):
    return data.rows.withColumn(models.WEIGHT, F.when(F.col(C.TARGET) == 1, 20.0).otherwise(1.0))


def nodes(model):
    """Of each tree, the lines of its text with their numbers rounded."""
    def line(text):
        return [round(float(w), 9) if w.lstrip("-").replace(".", "", 1)[:1].isdigit() else w
                for w in text.replace("(", " ").replace(")", " ").split()]

    return [[line(x) for x in tree.toDebugString.split("\n")[1:]] for tree in model.trees]


@pytest.mark.parametrize("partitions", [1, 3])
@pytest.mark.parametrize("in_jobs", [False, True])
def test_trees_are_those_of_mllib(matrix, monkeypatch, partitions, in_jobs):
    if in_jobs:
        monkeypatch.setattr(C, "TRAIN_ROWS", 10)
        monkeypatch.setattr(boosting, "STATES_KEPT", 1)
    with models.dealt(matrix, partitions=partitions) as data:
        rows = weighted(data)
        want, got = learner().fit(rows), boosting.fit_boosted(learner(), rows, (1.0, 20.0))
        assert nodes(got) == nodes(want) and got.treeWeights == want.treeWeights
        assert np.allclose(got.featureImportances.toArray(), want.featureImportances.toArray(), atol=1e-9)
        scores = [m.transform(rows).select("probability").collect() for m in (got, want)]
        assert all(abs(a[0][1] - b[0][1]) < 1e-9 for a, b in zip(*scores))


@pytest.mark.parametrize("params", [{"maxDepth": 0}, {"featureSubsetStrategy": "all", "subsamplingRate": 1.0},
                                    {"minInfoGain": 0.05, "minWeightFractionPerNode": 0.1}])
def test_other_settings_and_columns_without_a_split(matrix, params):
    for columns in (None, ["C6"]):
        with models.dealt(matrix, columns) as data:
            rows = weighted(data)
            want, got = learner(**params).fit(rows), boosting.fit_boosted(learner(**params), rows, (1.0, 20.0))
            assert nodes(got) == nodes(want)


def test_a_small_table_takes_no_job_for_each_level(spark, matrix):
    spark.sparkContext.setJobGroup("boosted trees", "")
    model = models.train("gbt", matrix, maxIter=30, maxDepth=4)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("boosted trees")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert model.getNumTrees == 30 and len(jobs) < 60


def test_labels_other_than_0_and_1_are_refused(matrix):
    with pytest.raises(Exception, match="abel"):
        models.train("gbt", matrix.withColumn(C.TARGET, F.lit(2)), maxIter=1)


def test_a_saved_model_scores_as_before(spark, matrix, tmp_path):
    model = models.train("gbt", matrix, maxIter=3, maxDepth=3)
    model.write().save(str(tmp_path / "model"))
    loaded = type(model).load(str(tmp_path / "model"))
    assert nodes(loaded) == nodes(model) and loaded.getOrDefault("weightCol") == models.WEIGHT


def test_rows_are_drawn_as_the_jvm_draws_them(spark):
    jvm = spark.sparkContext._jvm
    for seed in (0, 42, -7, 2 ** 40):
        r = jvm.org.apache.spark.util.random.XORShiftRandom(seed)
        want = [r.nextDouble() < 0.8 for _ in range(300)]
        assert boosting.sampled(seed, 300, 0.8).tolist() == want
        longs, r = boosting.java_longs(seed), jvm.java.util.Random(seed)
        assert [next(longs) for _ in range(5)] == [r.nextLong() for _ in range(5)]


def test_importances_take_no_more_jobs_for_more_trees(spark, sf, monkeypatch):
    counts = []
    for n_trees in (2, 20):
        monkeypatch.setitem(C.GBT_PARAMS, "maxIter", n_trees)
        group = f"importances of {n_trees} trees"
        spark.sparkContext.setJobGroup(group, "")
        assert registry.QUERIES["feature_importance"](spark, sf).count() == 20
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[1] < counts[0] + 20


def test_of_two_siblings_the_smaller_one_is_counted():
    r = np.random.default_rng(5)
    bins = r.integers(0, 32, (4, 5_000)).astype(np.uint8)
    labels = ((bins[0] > 20) ^ (bins[1] < 9) ^ (r.random(5_000) < 0.1)).astype(np.uint8)
    s = boosting.Settings([np.arange(31.0)] * 4, (1.0, 20.0), 1, 5, 0.1, 0.8, 3, 5, 0.0, 0.0, 42)
    block, trees, read = boosting.Block([(1, 5_000)], labels, bins), [], []
    for siblings in (False, True):
        rows, seen = boosting.Rows(block, block.drawn(s, 0), None, s), []

        def count(tree, nodes, rows=rows, seen=seen):
            rows.descend(tree, min(tree.depth, 1))
            seen.append(int(np.isin(rows.node, nodes).sum()))
            return rows.count(nodes)

        trees.append(boosting.grow(count, s, s.seed, siblings))
        read.append(seen)
    assert trees[0] == trees[1] and len(trees[0].feature) > 15
    assert all(below <= above / 2 for below, above in zip(read[1][1:], read[0]))


def test_exponentials_are_those_of_the_jvm(spark):
    jvm, x = spark.sparkContext._jvm, np.random.default_rng(1).normal(0, 8, 1_500)
    got, want = boosting.java_exp(x), np.array([jvm.java.lang.Math.exp(float(v)) for v in x])
    assert (np.abs(got - want) <= np.spacing(want)).all()
