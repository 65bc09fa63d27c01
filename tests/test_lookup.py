"""Lookups of every size next to a dictionary, and the key filter they use."""

import pytest
from pyspark.sql import functions as F

from fraudlake import config as C
from fraudlake.operators import features, joins, keyfilter


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def some_rows(spark, n=6000):
    """A third of the rows hold 7, one in ten null, most others have no partner."""
    return spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None)
                                 .otherwise(F.col("id")).cast("int").alias("k"))


def learned(spark, n=1000):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"),
                                 F.concat(F.lit("t"), "id").alias("t")).unionByName(
        spark.createDataFrame([(None, -5, "none")], "k long, v long, t string"))


@pytest.mark.parametrize("small", [True, False, None])
def test_lookup_equals_a_dictionary(spark, small):
    left, table = some_rows(spark), learned(spark)
    known = {r["k"]: (r["v"], r["t"]) for r in table.collect()}
    got = joins.lookup(left, table, ["k"], small)
    assert got.columns == ["id", "k", "v", "t"] and got.schema["k"].dataType == left.schema["k"].dataType
    rows = got.collect()
    assert sorted(r["id"] for r in rows) == list(range(6000))
    assert all((r["v"], r["t"]) == known.get(r["k"], (None, None)) for r in rows)


def test_rows_without_a_partner_pass_by_the_shuffle(spark):
    left, table = some_rows(spark), learned(spark)
    keys = keyfilter.build(table, ["k"], keyfilter.common_types(left, table, ["k"]), 512)
    marked = keyfilter.mark(left, ["k"], keyfilter.common_types(left, table, ["k"]), 512, keys)
    passed = marked.where("_may").count()
    partners = left.join(table, left["k"].eqNullSafe(table["k"]), "left_semi").count()
    assert partners <= passed < partners + 300 and passed < 6000 - 2000
    got = joins.lookup(left, table, ["k"], small=False)
    # two branches, and the one of the unseen rows has no exchange but the filter's broadcast
    seen, unseen = got._jdf.queryExecution().optimizedPlan().children().apply(0), \
        got._jdf.queryExecution().optimizedPlan().children().apply(1)
    assert "_salt" in seen.toString() and "_salt" not in unseen.toString()
    everything = joins.lookup(spark.range(900).withColumnRenamed("id", "k"), table.where("k is not null"), ["k"],
                              small=False)
    assert "Union" not in plan(everything)  # nothing unseen: one branch


@pytest.mark.parametrize("left_rows, table_rows", [(0, 10), (10, 0), (0, 0)])
def test_empty_tables(spark, left_rows, table_rows):
    left, table = some_rows(spark).limit(left_rows), learned(spark).limit(table_rows)
    for small in (True, False, None):
        assert joins.lookup(left, table, ["k"], small).count() == left_rows


def test_keys_of_other_types(spark):
    left = spark.createDataFrame([(0, "1"), (1, "x"), (2, None)], "id long, k string")
    table = spark.createDataFrame([("1", 5), (None, 6)], "k string, v long")
    got = {r["id"]: r["v"] for r in joins.lookup(left, table, ["k"], small=False).collect()}
    assert got == {0: 5, 1: None, 2: 6}
    doubles = spark.createDataFrame([(0, -0.0), (1, float("nan")), (2, 3.0), (3, 4.5)], "id long, k double")
    floats = spark.createDataFrame([(0.0, 1), (float("nan"), 2), (3.0, 3)], "k float, v long")
    got = {r["id"]: r["v"] for r in joins.lookup(doubles, floats, ["k"], small=False).collect()}
    assert got == {0: 1, 1: 2, 2: 3, 3: None}
    assert keyfilter.common_types(left, floats, ["k"]) is None


def test_merged_filters_equal_the_filter_of_all(spark):
    a, b = learned(spark, 700), learned(spark, 1500).where("k >= 400")
    types = keyfilter.common_types(a, b, ["k"])

    def content(f):
        return {r["_block"]: list(r["_words"]) for r in f.collect()}

    both = keyfilter.merge([keyfilter.build(x, ["k"], types, 1024) for x in (a, b)], 1024)
    assert content(both) == content(keyfilter.build(a.unionByName(b), ["k"], types, 1024))
    assert all(len(w) == keyfilter.BLOCK for w in content(both).values())
    assert keyfilter.mark(a.unionByName(b), ["k"], types, 1024, both).where("not _may").count() == 0


def test_few_other_keys_pass(spark):
    n = 20_000
    words = keyfilter.words_for(n)
    table, other = spark.range(n), spark.range(n, 3 * n)
    keys = keyfilter.build(table, ["id"], [table.schema["id"].dataType], words)
    assert keyfilter.mark(other, ["id"], [table.schema["id"].dataType], words, keys).where("_may").count() < 2 * n / 40


def test_size_of_a_filter_is_bounded():
    assert keyfilter.words_for(0) == keyfilter.BLOCK
    assert keyfilter.words_for(10**6) * 64 >= 16 * 10**6
    assert keyfilter.words_for(4 * 10**7) * 8 <= C.FILTER_BYTES
    assert keyfilter.words_for(10**9) is None  # too few bits a key


def test_a_broadcast_is_bounded_in_bytes(spark, monkeypatch):
    table = spark.range(100).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("t"))
    assert joins.fits_broadcast(table)
    monkeypatch.setattr(C, "BROADCAST_BYTES", 50_000)
    assert not joins.fits_broadcast(table) and joins.fits_broadcast(table.select("k"))
    assert not joins.fits_broadcast(table.select("k", F.array("t").alias("a")))
    left = spark.range(200).select(F.col("id").alias("k"))
    assert joins.lookup(left, table, ["k"]).where("t is not null").count() == 100


def test_codes_of_long_categories_are_not_broadcast(spark, monkeypatch):
    train = spark.range(60).select(F.concat(F.repeat(F.lit("c"), 500), "id").alias("ProductCD"),
                                   F.lit("visa").alias("card4"))
    codes = features.fit_codes(train, ["ProductCD", "card4"])
    monkeypatch.setattr(C, "BROADCAST_BYTES", 10_000)
    small, unknown = features.code_facts(codes)
    assert small == {"ProductCD": False, "card4": True} and unknown == {"ProductCD": 60, "card4": 0}
    got = features.encode(train, codes, ["ProductCD", "card4"]).collect()
    assert sorted(r["ProductCD"] for r in got) == list(range(60)) and {r["card4"] for r in got} == {1}
