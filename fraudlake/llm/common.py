"""What several corpus operators share: blocks of texts inside a task, groups in a
sorted stream, connected components."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize

BLOCK_BYTES = 4 << 20


def text_blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text each; a single
    longer text is a block of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = (np.cumsum(size, dtype=np.int64) - size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            yield batch.slice(lo, hi - lo)


def strings(column: pa.Array) -> list[str]:
    """The texts as Python strings, null as the empty one."""
    return pc.fill_null(column, "").to_pylist()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all the texts one after the other, and where each begins (one
    more entry than texts). Null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, where, data = column.buffers()
    starts = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return raw[starts[0]:starts[-1]], starts - starts[0]


def sorted_groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, list[dict]]]:
    """(key, rows) of a stream that is sorted by the keys; a group may span batches."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            now = tuple(row[k] for k in keys)
            if now != key and rows:
                yield key, rows
                rows = []
            key = now
            rows.append(row)
    if rows:
        yield key, rows


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) for edges (a, b); the component is its smallest node.

    Alternating large-star and small-star steps: each node hangs its larger
    neighbours below its smallest one. The edges of a round are written to the
    shared folder, so a round never recomputes another, and deleted once the next
    round's are. A hub's neighbours are aggregated (min) and joined, never gathered.
    """
    # both ends point at the smaller node
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .where("a != b").distinct())
    for _ in range(rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # repeated edges, no more than there were edges before, go with the small step's
        large = materialize(large.where("a != b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a")
                 .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a != b").distinct())
        small = materialize(small)
        # a forest of stars: nobody is both a child and a parent, every child has one parent
        ends = small.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                              F.struct(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
                                      ).alias("e")).select("e.*")
        done = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where(
            "up > 1 or (up > 0 and down > 0)").isEmpty()
        discard(now, large)
        now = small
        if done:
            break
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
