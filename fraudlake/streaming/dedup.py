"""Score each distinct request payload once."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup


def distinct_payloads(df: DataFrame, key: str, columns: list[str], time: str | None = None,
                      within: str = "1 hour") -> DataFrame:
    """One row per payload key; on a stream one per key and lateness window."""
    if df.isStreaming:
        return (df.withWatermark(time, within).dropDuplicatesWithinWatermark([key])
                .select(key, time, *columns))
    return df.select(key, *columns).dropDuplicates([key])


def score_distinct(df: DataFrame, key: str, columns: list[str], score: Column) -> DataFrame:
    """Every request with the score of its payload. The join back goes through
    ``lookup``, so a payload that makes up much of the traffic is no bottleneck."""
    table = distinct_payloads(df, key, columns).select(key, score.alias("score"))
    return lookup(df, table, [key])


def score_distinct_windowed(df: DataFrame, key: str, columns: list[str], score: Column, time: str,
                            window: str = "1 hour", lateness: str = "1 hour", salts: int = 16) -> DataFrame:
    """Every request with the score of its payload, each payload scored once a window (adds
    ``score`` and ``n_same``, how many requests of the window have the payload). One plan for batch
    and stream: requests meet their window's distinct payloads in an equi-join on payload and
    window, so a stream's state, on either side, ends with the window.

    A hot payload is pre-aggregated before it is scored, and its requests are dealt over at most
    ``salts`` (up to 63) keys of the join. The aggregate notes in the bits of a number which of
    them a payload's requests got, and the one scored row is repeated for these only: a payload of
    one request meets it once. On a stream rows leave once the watermark has passed the end of
    their window."""
    if not 0 < salts < 64:
        raise ValueError(f"salts must be from 1 to 63, not {salts}")
    rows = (df.withWatermark(time, lateness) if df.isStreaming else df).withColumn("_window", F.window(time, window))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(*[c for c in df.columns if c != key]), F.lit(salts)).cast("int"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_salt"))
    distinct = dealt.groupBy("_window", key).agg(
        *[F.first(c).alias(c) for c in columns], F.count("*").alias("n_same"), F.bit_or(bit).alias("_salts"))
    used = F.filter(F.sequence(F.lit(0), F.lit(salts - 1)), lambda i: F.getbit("_salts", i) == 1)
    table = distinct.select(key, "_window", score.alias("score"), "n_same", F.explode(used).alias("_salt"))
    if df.isStreaming:  # a stream carries one event time: the window's; the instant goes on as plain data
        dealt = dealt.withColumn("_at", F.timestamp_micros(F.unix_micros(time))).drop(time)
    out = dealt.join(table, [key, "_window", "_salt"])
    return out.select(*[F.col("_at").alias(c) if df.isStreaming and c == time else c for c in df.columns], "score", "n_same")
