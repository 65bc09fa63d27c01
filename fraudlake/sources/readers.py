"""Reading transactions and identity records."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is how the files spell a missing number. As NaN it would poison sums,
    counts and casts, so it becomes null at ingest."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(c, F.lit(None)) for c in floating})


def transaction_schema(columns: list[str]) -> T.StructType:
    """Explicit types for a header, so that a CSV scan needs no inference pass."""
    longs, strings = {C.KEY, C.TIME, C.TARGET}, {*C.CATEGORICAL_FEATURES, "DeviceType", "DeviceInfo"}
    # id_12..id_38 mix text and number columns in the identity file
    text_ids = {f"id_{i}" for i in (12, 15, 16, 23, 27, 28, 29, 30, 31, 33, 34, 35, 36, 37, 38)}

    def kind(c):
        if c in longs:
            return T.LongType()
        return T.StringType() if c in strings | text_ids else T.DoubleType()

    return T.StructType([T.StructField(c, kind(c)) for c in columns])


def csv_header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).csv(path).columns


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Blank numbers are null, the text ``NaN`` too."""
    schema = schema or transaction_schema(csv_header(spark, path))
    return nan_to_null(
        spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def read_first_available(spark: SparkSession, raw_csv: str, processed: str,
                         identity_csv: str | None = None) -> tuple[DataFrame, str]:
    """Raw CSV joined with identity when it is there, else the processed Parquet;
    the second value names the source."""
    from ..operators.joins import attach_identity

    if path_exists(spark, raw_csv):
        identity = None
        if identity_csv and path_exists(spark, identity_csv):
            identity = read_csv(spark, identity_csv)
        return attach_identity(read_csv(spark, raw_csv), identity), "raw_csv"
    if path_exists(spark, processed):
        return read_parquet(spark, processed), "processed_parquet"
    raise FileNotFoundError(f"neither {raw_csv} nor {processed} exists")
