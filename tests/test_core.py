"""Rank cuts, quantiles and running totals against brute force, also where it is skewed."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudlake.operators import quantiles
from fraudlake.operators.prefix import BIN, range_splits, running_totals, with_ranges
from fraudlake.operators.ranking import first_k, hash_sample


def rows_of(spark, n=3000, seed=1):
    r = random.Random(seed)
    # a third of all rows share one time
    return [(i, 500 if i % 3 == 0 else r.randrange(-10_000, 10_000_000)) for i in range(n)]


@pytest.mark.parametrize("k", [0, 1, 37, 1000, 1500, 2999, 3000, 9999])
def test_first_k_equals_a_full_sort(spark, k):
    data = rows_of(spark)
    df = spark.createDataFrame(data, "id long, t long").repartition(7)
    got = {r[0] for r in df.where(first_k(df, [F.col("t"), F.col("id")], k)).collect()}
    assert got == {i for i, _ in sorted(data, key=lambda r: (r[1], r[0]))[:k]}


def test_first_k_puts_nulls_last_and_needs_unique_keys(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 1), (4, None)], "id long, t long")
    got = df.where(first_k(df, [F.col("t"), F.col("id")], 3))
    assert sorted(r[0] for r in got.collect()) == [1, 2, 3]
    same = spark.createDataFrame([(1,), (1,), (1,)], "t long")
    with pytest.raises(ValueError):
        first_k(same, [F.col("t")], 2)


def test_hash_sample_is_exact_and_independent_of_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    picks = [{r[0] for r in hash_sample(df.repartition(p), 700, "k", 42).collect()} for p in (1, 7, 32)]
    assert len(picks[0]) == 700 and picks[0] == picks[1] == picks[2]
    assert {r[0] for r in hash_sample(df, 700, "k", 43).collect()} != picks[0]
    assert hash_sample(df, 9999, "k", 42).count() == 5000


@pytest.mark.parametrize("buckets", [2, 50, 4096])
def test_exact_quantiles_with_few_and_many_buckets(spark, buckets):
    r = np.random.default_rng(3)
    x = np.concatenate([r.exponential(40, 4000), np.full(2000, 7.25)])  # a third is one value
    y = r.integers(0, 5, 6000).astype(float)
    df = spark.createDataFrame([(float(a), float(b), None) for a, b in zip(x, y)],
                               "x double, y double, z double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.333, 0.5, 0.75, 0.99, 1.0]
    series = {c: F.col(c) for c in "xyz"} | {"half": F.when(F.col("y") > 2, F.col("x"))}
    got = quantiles.exact_quantiles(df, series, probs, buckets=buckets)
    np.testing.assert_allclose(got["x"], np.quantile(x, probs), rtol=1e-9)
    np.testing.assert_allclose(got["y"], np.quantile(y, probs), rtol=1e-9)
    np.testing.assert_allclose(got["half"], np.quantile(x[y > 2], probs), rtol=1e-9)
    assert got["z"] == [None] * len(probs)


def test_exact_quantiles_of_every_kind_of_double(spark):
    tiny = 5e-324
    x = [-math.inf, -1.7e308, -3.0, -1.0, -tiny, -0.0, 0.0, tiny, 2 * tiny, 3 * tiny, 1e-310, 1.0,
         math.nextafter(1.0, 2.0), math.nextafter(1.0, 0.0), 2.0, 4.0, 2.0 ** 53, 1.7e308, math.inf, math.nan]
    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate(x)], "x double, y double").repartition(3)
    n = len(x)
    order = sorted(v for v in x if v == v) + [math.nan]
    got = quantiles.exact_quantiles(df, {"x": F.col("x")}, [i / (n - 1) for i in range(n)], buckets=4)["x"]
    for i, v in enumerate(order):
        h = i / (n - 1) * (n - 1)
        if h == i:  # other probabilities lie a rounding beside the rank
            assert got[i] == v or (math.isnan(v) and math.isnan(got[i]))
    assert sum(i / (n - 1) * (n - 1) == i for i in range(n)) > n // 2
    assert quantiles.exact_quantiles(df.limit(0), {"x": F.col("x")}, [0.5]) == {"x": [None]}
    assert quantiles.exact_quantiles(df, {}, [0.5]) == {}


def test_neighbouring_doubles_take_at_most_five_passes(spark, monkeypatch):
    x = [1.0 + i * 2.0 ** -52 for i in range(40)] + [1.9, 1.01, 3.0, 1e9] * 5
    calls = []
    pick = quantiles._pick
    monkeypatch.setattr(quantiles, "_pick", lambda *a: calls.append(1) or pick(*a))
    df = spark.createDataFrame([(v,) for v in x], "x double")
    got = quantiles.exact_quantiles(df, {"x": F.col("x")}, [0.1, 0.3, 0.5])["x"]
    assert got == [float(v) for v in np.quantile(x, [0.1, 0.3, 0.5])] and len(calls) <= 5


def test_weighted_quantiles_count_a_row_as_often_as_it_weighs(spark):
    r = random.Random(8)
    rows = [(float(r.randrange(500)), r.randrange(-1, 6)) for _ in range(900)] + [(77.0, 2000), (3.5, None)]
    df = spark.createDataFrame(rows, "x double, w long").repartition(4)
    full = [v for v, w in rows for _ in range(w or 0)]
    probs = [0.0, 0.2, 0.5, 0.9, 1.0]
    got = quantiles.exact_quantiles(df, {"x": F.col("x")}, probs, weight=F.col("w"), buckets=16)["x"]
    np.testing.assert_allclose(got, np.quantile(full, probs), rtol=1e-12)


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_equal_one_long_window(spark, descending):
    r = random.Random(5)
    data = {(g, round(r.random(), 3)): r.randrange(1, 9) for g in "ab" for _ in range(400)}
    df = spark.createDataFrame([(g, x, n) for (g, x), n in data.items()], "g string, x double, n long")
    ranged = with_ranges(df, range_splits(df, ["x"]))
    got = running_totals(ranged, "x", {"n": "run"}, ["g"], "x" + BIN, descending).collect()
    for g in "ab":
        order = sorted((x for k, x in data if k == g), reverse=descending)
        total = 0
        want = {}
        for i, x in enumerate(order):
            total += data[g, x]
            want[x] = (total, order[i + 1] if i + 1 < len(order) else None)
        mine = {r["x"]: (r["run"], r["next_value"]) for r in got if r["g"] == g}
        assert mine == want
        assert {r["run_total"] for r in got if r["g"] == g} == {total}
