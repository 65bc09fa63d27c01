"""Reports from footers next to the same reports from the values."""

import pytest
from pyspark.sql import functions as F

from fraudlake.operators import aggregates, joins
from fraudlake.session import shared_dir
from fraudlake.sources import footers, readers, schema


def written(df):
    path = shared_dir(df.sparkSession)
    df.write.parquet(path)
    return path


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_reports_equal_those_from_values_and_read_no_page(spark, raw):
    path, other = written(raw.repartition(3)), written(raw.select("TransactionID", "D1").withColumn("id_01", F.lit(1)))
    needed = ["TransactionID", "TransactionAmt", "D1", "D2", "nowhere"]
    checks = [
        (lambda t: schema.validation_report(t, needed, "t"), [path]),
        (joins.column_overlap, [path, other]),
        (aggregates.time_span, [path]),
        (lambda t: footers.extents(t, ["TransactionID", "TransactionAmt"]), [path]),
    ]
    for report, paths in checks:
        lazy = report(*footers.open_footers(spark, *paths))
        assert not footers.reads_pages(lazy)
        plain = report(*[readers.read_parquet(spark, p) for p in paths])
        assert footers.reads_pages(plain)
        got = footers.from_footers(spark, report, *paths)
        assert got.columns == plain.columns and rows(got) == rows(plain)
    assert footers.n_rows(spark, path) == 100


def test_columns_without_exact_statistics_are_read(spark, raw):
    path = written(raw.withColumn("ts", F.timestamp_seconds("TransactionDT")))
    want = raw.agg(F.min("ProductCD"), F.max("ProductCD"), F.max("TransactionDT")).first()
    by_text = footers.from_footers(spark, lambda t: footers.extents(t, ["ProductCD"]), path).first()
    assert (by_text["ProductCD_smallest"], by_text["ProductCD_largest"]) == (want[0], want[1])
    lazy = footers.extents(footers.open_footers(spark, path)[0], ["ts"])
    assert footers.reads_pages(lazy) and lazy.first()["ts_largest"].timestamp() == want[2]


def test_filters_are_not_answered_from_footers(spark, raw):
    path = written(raw)
    lazy = footers.open_footers(spark, path)[0].where("TransactionAmt > 100").agg(F.count(F.lit(1)))
    assert footers.reads_pages(lazy)
    assert lazy.first()[0] == raw.where("TransactionAmt > 100").count()


def test_row_groups_without_a_value_and_empty_tables(spark, raw):
    r = footers.from_footers(spark, lambda t: footers.extents(t, ["D2", "TransactionID"]), written(raw)).first()
    assert (r["D2_values"], r["D2_smallest"], r["TransactionID_largest"]) == (0, None, 99)
    empty = written(raw.where("false"))
    r = footers.from_footers(spark, lambda t: footers.extents(t, ["TransactionID"]), empty).first()
    assert (r["n_rows"], r["TransactionID_values"], r["TransactionID_smallest"]) == (0, 0, None)


def test_other_failures_are_raised(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        footers.from_footers(spark, lambda t: t.agg(F.count(F.lit(1))), "/nowhere/at/all")


def test_the_callers_session_keeps_its_settings(spark, raw):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    footers.n_rows(spark, written(raw))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    got = footers.from_footers(spark, aggregates.time_span, written(raw))
    got.createOrReplaceTempView("span")
    assert spark.sql("SELECT days FROM span").count() == 1
