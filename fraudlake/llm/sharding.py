"""Contiguous shards of nearly equal size from prefix sums of byte sizes.

Rows are put in key order by ranges; each range's total is summed, prefix sums over the
(few) totals tell where a range begins, and a running sum inside the range tells where
a row begins among all bytes. The byte line is cut at equal targets: a row belongs to
the shard in which its middle lies, so a shard's size misses the target by at most
one row at either end. Law: ``bytes``.

Order: key (null first), checksum, size, place in the input. Ranges are cut over all of
these, so rows that share a key, null included, spread over as many ranges as their
number asks for. One row per input row; repeated rows get slots of their own; a null text
has size 8 and the empty text's checksum; an empty table gives an empty result. Further
columns (``keep``) are carried along.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

ROWS_PER_RANGE = 1 << 20


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", keep=()) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard, *keep)."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    carried = [F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]
    rows = docs.select(
        F.col(key).alias("key"), (F.octet_length(body).cast("long") + 8).alias("size"),
        F.crc32(body.cast("binary")).alias("crc"), F.monotonically_increasing_id().alias("seq"), *carried)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.count() // ROWS_PER_RANGE + 1)
    # written once: what follows must see one and the same set of ranges
    rows = materialize(rows.repartitionByRange(ranges, "key", "crc", "size", "seq")
                       .withColumn("range", F.spark_partition_id()))

    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    totals = rows.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    bases = totals.select(
        "range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte_base"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("row_base"))
    total = totals.agg(F.sum("bytes")).first()[0] or 1

    inside = Window.partitionBy("range").orderBy("key", "crc", "size", "seq")
    begin = F.col("byte_base") + F.sum("size").over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    # "range" has as many rows as there are ranges: one for a million documents
    placed = (rows.join(F.broadcast(bases), "range")
              .withColumn("row", F.col("row_base") + F.row_number().over(inside) - 1)
              .withColumn("twice_middle", 2 * begin + F.col("size")))
    placed = placed.withColumn("shard", F.least(
        F.lit(shards - 1), F.expr(f"(twice_middle * {shards}L) div {2 * total}L").cast("int")))
    placed = materialize(placed.select("key", "size", "crc", "row", "shard", *[f"keep_{i}" for i in range(len(keep))]))
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))  # a row for each shard
    return placed.join(F.broadcast(first), "shard").select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)])
