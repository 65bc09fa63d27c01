"""Writing tables and small reports."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("compression", "snappy").parquet(path)
    return path


def write_report_json(df: DataFrame, path: str) -> str:
    """One JSON file; for summary frames of a few rows only."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def write_report_csv(df: DataFrame, path: str) -> str:
    """One CSV file with header, in the frame's order; for ranked reports."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def load_table(parts: list[DataFrame], table: str, path: str) -> DataFrame:
    """Replace ``table`` by the union of the parts and return it. ``path`` is a
    folder all executors reach; the write is distributed, one file per task, into a
    folder of its own below it. Readers see the old rows until all new ones are
    written; a load that fails changes nothing. The folder of the rows before is
    left for queries that still read it."""
    version = f"{path.rstrip('/')}/load-{uuid.uuid4().hex}"
    reduce(DataFrame.unionByName, parts).write.parquet(version)
    return publish(parts[0].sparkSession, table, version)


def publish(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Let ``table`` show the Parquet files at ``path``. With the columns it had, one step
    of the catalog; with others it is dropped and made again, once the files are whole."""
    def kinds(df):
        return [(f.name, f.dataType) for f in df.schema]

    same = spark.catalog.tableExists(table) and kinds(spark.table(table)) == kinds(spark.read.parquet(path))
    if same:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
    return spark.table(table)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, batch_rows: int) -> None:
    """Same load into a database over JDBC, in batches of ``batch_rows`` per task."""
    df.write.mode("overwrite").option("batchsize", batch_rows).jdbc(url, table, properties=properties)
