"""Run a streaming frame over everything available and return what it wrote."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import shared_dir

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_state_store(spark: SparkSession) -> None:
    """State on disk with column families, which lists and timers need; a store that the
    session names itself stays."""
    if spark.conf.get(STORE, "").endswith("HDFSBackedStateStoreProvider") or not spark.conf.get(STORE, ""):
        spark.conf.set(STORE, ROCKSDB)  # the other is the engine's default, without them


def run(stream: DataFrame, partition_by: tuple[str, ...] = ()) -> tuple[DataFrame, StreamingQuery]:
    """Process all available input in append mode into a Parquet table with checkpoints in the
    shared folder; (that table, the ended query)."""
    spark = stream.sparkSession
    out = shared_dir(spark)
    query = (
        stream.writeStream.format("parquet").outputMode("append").partitionBy(*partition_by)
        .option("path", out + "/data").option("checkpointLocation", out + "/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out + "/data"), query


def drain(stream: DataFrame) -> DataFrame:
    return run(stream)[0]


def late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark and were dropped, over the progress kept."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
