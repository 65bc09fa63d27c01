"""Column checks and type reports."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VARCHAR_LENGTH = 64


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: list[str], table: str) -> DataFrame:
    gone = missing_columns(df, required)
    if gone:
        raise ValueError(
            f"{table} lacks the required columns {gone}; it has {sorted(df.columns)}")
    return df


def tidy(df: DataFrame, rows: list[list], names: list[str]) -> DataFrame:
    """Turn a one-row aggregate into rows: each entry of ``rows`` lists literals
    and columns of ``df`` for one output row."""
    def col(v):
        if isinstance(v, Column):
            return v
        return F.col(v[1:]) if isinstance(v, str) and v.startswith("$") else F.lit(v)

    structs = [F.struct(*[col(v).alias(n) for v, n in zip(r, names)]) for r in rows]
    return df.select(F.inline(F.array(*structs)))


def tidy_by_chunks(df: DataFrame, columns: list[str], names: list[str], per_column, size: int) -> DataFrame:
    """One output row per column from global aggregates, ``size`` columns per
    aggregate: one aggregate over hundreds of columns outgrows compiled code. The
    chunks have no column in common, so a columnar scan reads nothing twice.
    ``per_column(column)`` gives its aggregates in the order of ``names[1:]``."""
    def chunk(cols):
        aggs, rows = [], []
        for i, c in enumerate(cols):
            exprs = per_column(c)
            aggs += [e.alias(f"a{i}_{j}") for j, e in enumerate(exprs)]
            rows.append([c, *[f"$a{i}_{j}" for j in range(len(exprs))]])
        return tidy(df.agg(*aggs), rows, names)

    return reduce(DataFrame.unionByName, [chunk(columns[i:i + size]) for i in range(0, len(columns), size)])


def validation_report(df: DataFrame, required: list[str], table: str) -> DataFrame:
    """Per required column: is it there, and how many values does it hold."""
    counts = df.agg(*[
        (F.count(c) if c in df.columns else F.lit(0).cast("long")).alias(f"n{i}")
        for i, c in enumerate(required)
    ])
    rows = [[table, c, c in df.columns, f"$n{i}"] for i, c in enumerate(required)]
    return tidy(counts, rows, ["table_name", "column_name", "present", "n_values"])


def sql_type(data_type: T.DataType) -> str:
    """Database type by kind: floating, integer, anything else."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return "DOUBLE"
    if isinstance(data_type, T.IntegralType):
        return "BIGINT"
    return f"VARCHAR({VARCHAR_LENGTH})"


def create_table_sql(df: DataFrame, table: str) -> str:
    body = ",\n  ".join(f"`{f.name}` {sql_type(f.dataType)}" for f in df.schema)
    return f"CREATE TABLE IF NOT EXISTS `{table}` (\n  {body}\n)"


def sql_schema_report(df: DataFrame) -> DataFrame:
    """Per column its database type and whether its longest text would fit."""
    longest = df.agg(*[
        F.coalesce(F.max(F.length(F.col(f.name).cast("string"))), F.lit(0)).cast("long").alias(f"n{i}")
        if sql_type(f.dataType).startswith("VARCHAR") else F.lit(0).cast("long").alias(f"n{i}")
        for i, f in enumerate(df.schema)
    ])
    rows = [[f.name, sql_type(f.dataType), f"$n{i}"] for i, f in enumerate(df.schema)]
    return tidy(longest, rows, ["column_name", "sql_type", "longest_text"]).withColumn(
        "fits", F.col("longest_text") <= VARCHAR_LENGTH)


def dtype_census(df: DataFrame) -> DataFrame:
    """Per type: number of columns and bytes held (8 per number, text by length)."""
    bytes_of = df.agg(*[
        (F.coalesce(F.sum(F.octet_length(f.name)), F.lit(0)) if f.dataType == T.StringType()
         else F.count(F.lit(1)) * 8).cast("long").alias(f"n{i}")
        for i, f in enumerate(df.schema)
    ])
    rows = [[f.dataType.simpleString(), f"$n{i}"] for i, f in enumerate(df.schema)]
    return (tidy(bytes_of, rows, ["dtype", "bytes"]).groupBy("dtype")
            .agg(F.count(F.lit(1)).alias("n_columns"), F.sum("bytes").alias("n_bytes")))
