"""Approximate nearest neighbours (largest cosine) with robust-pruned graphs.

**Classes.** Equal vectors are one class with its k + 1 smallest ids: no other id of the class
can be among anybody's k nearest, since ties go to the smaller id.

**Index.** Classes are dealt into shards of about ``SHARD_ROWS`` by hash, every class into
one. A shard's graph is built in one task: points join in batches that double in size; a
greedy beam search over the graph so far proposes neighbours, robust pruning keeps those
to which no kept neighbour is nearer by the factor ``ALPHA``, and edges are made mutual,
pruned again where a point has more than ``DEGREE``.

**Search.** Distinct query vectors, in blocks of ``QUERY_ROWS``, visit every shard; a beam of
``BEAM`` walks each graph, what it found is scored on the original vectors in double
precision, and the k + 1 best of all shards are merged.

Null or zero vectors and those with null or non-finite components take no part, nor do
rows without an id; vectors are compared with those of their own length only; an empty
table gives an empty result. Other columns are not looked at.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

SHARD_ROWS = 4096
QUERY_ROWS = 4096
DEGREE = 28
BUILD_BEAM = 40
BEAM = 80
ALPHA = 1.2
AT_ONCE = 3


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # keeps tiny and huge components in range
    return (x / np.sqrt((x * x).sum(1, keepdims=True))).astype(np.float32)


def cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    return (q * x).sum(-1) / (np.sqrt((q * q).sum(-1)) * np.sqrt((x * x).sum(-1)))


def beam_search(x, graph, queries, entry, width):
    """(ids, distances) of the ``width`` nearest points found for each query; -1 where
    there are fewer."""
    n = len(queries)
    ids = np.full((n, width), -1, np.int32)
    far = np.full((n, width), np.inf, np.float32)
    done = np.ones((n, width), bool)
    ids[:, 0], far[:, 0], done[:, 0] = entry, 1 - queries @ x[entry], False
    active = np.arange(n)
    while len(active):
        a_ids, a_far, a_done = ids[active], far[active], done[active]
        open_ = np.where(a_done, np.inf, a_far)
        pick = np.argsort(open_, axis=1)[:, :AT_ONCE]
        rows = np.arange(len(active))[:, None]
        some = np.isfinite(open_[rows, pick])
        a_done[rows, pick] = True
        near = np.where(some[:, :, None], graph[a_ids[rows, pick]], -1).reshape(len(active), -1)
        near.sort(axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        fresh &= ~(near[:, :, None] == a_ids[:, None, :]).any(2)
        gap = 1 - np.einsum("bd,bkd->bk", queries[active], x[near])
        gap[~fresh] = np.inf
        all_far = np.concatenate([a_far, gap], 1)
        order = np.argpartition(all_far, width - 1, axis=1)[:, :width]
        order = order[rows, np.argsort(all_far[rows, order], axis=1)]
        ids[active] = np.concatenate([a_ids, np.where(fresh, near, -1)], 1)[rows, order]
        far[active] = all_far[rows, order]
        done[active] = np.concatenate([a_done, ~fresh], 1)[rows, order]
        active = active[~(done[active] | ~np.isfinite(far[active])).all(1)]
    return ids, far


def prune(x, points, candidates):
    """Robust pruning for many points at once: the nearest candidate stays, and those
    that are nearer to it (times ALPHA) than to the point go, until DEGREE have stayed."""
    out = np.full((len(points), DEGREE), -1, np.int32)
    candidates = np.sort(candidates, axis=1)
    good = (candidates >= 0) & (candidates != points[:, None])
    good[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    vectors = x[candidates]
    far = np.maximum(2 - 2 * np.einsum("bd,bkd->bk", x[points], vectors), 0)  # squared distances
    far[~good] = np.inf
    order = np.argsort(far, axis=1)
    rows = np.arange(len(points))
    candidates, far = candidates[rows[:, None], order], far[rows[:, None], order]
    vectors = vectors[rows[:, None], order]
    between = np.maximum(2 - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1)), 0)
    alive = np.isfinite(far)
    for k in range(DEGREE):
        if not alive.any():
            break
        first, has = alive.argmax(1), alive.any(1)
        out[has, k] = candidates[rows, first][has]
        alive &= ALPHA ** 2 * between[rows, first] > far
        alive[rows, first] = False
    return out


def build(x: np.ndarray) -> tuple[np.ndarray, int]:
    """(neighbours of each point, entry point)."""
    n = len(x)
    graph = np.full((n, DEGREE), -1, np.int32)
    entry = int(np.argmax(x @ x.mean(0)))
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    lo, size = 1, 1
    while lo < n:
        batch = order[lo:lo + size]
        found, _ = beam_search(x, graph, x[batch], entry, BUILD_BEAM)
        if size <= 64:  # batch members see each other while the graph is small
            found = np.concatenate([found, np.broadcast_to(batch.astype(np.int32), (len(batch), len(batch)))], 1)
        graph[batch] = prune(x, batch, found)
        source = np.repeat(batch, DEGREE)
        target = graph[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        ends, first, times = np.unique(target, return_index=True, return_counts=True)
        for a in range(0, len(ends), 512):
            some, most = ends[a:a + 512], int(times[a:a + 512].max())
            more = np.full((len(some), most), -1, np.int32)
            for i, (f, t) in enumerate(zip(first[a:a + 512].tolist(), times[a:a + 512].tolist())):
                more[i, :t] = source[f:f + t]
            graph[some] = prune(x, some, np.concatenate([graph[some], more], 1))
        lo, size = lo + size, min(2 * size, 512)
    return graph, entry


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """(dim, vector as bytes of doubles, ids): the k + 1 smallest ids of each distinct vector."""
    def run(batches):
        for batch in batches:
            held: dict[tuple[int, bytes], list[int]] = {}
            for i, v in zip(batch.column("id").to_pylist(), batch.column("vector").to_pylist()):
                held.setdefault((len(v), np.array(v, "<f8").tobytes()), []).append(i)
            if held:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for d, _ in held], pa.int32()), pa.array([v for _, v in held], pa.binary()),
                     pa.array([sorted(set(x))[:k + 1] for x in held.values()], pa.list_(pa.int64()))],
                    ["dim", "vector", "ids"])

    lists = rows.mapInArrow(run, "dim int, vector binary, ids array<long>")
    for keys in (("dim", "vector", "salt"), ("dim", "vector")):  # a hot vector's lists meet in two steps
        lists = lists.withColumn("salt", F.pmod(F.element_at("ids", 1), F.lit(64))).groupBy(*keys).agg(
            F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"))
    return lists.select("dim", "vector", "ids")


def search(rows: DataFrame, is_query, k: int = 5, key: str = "vec_id", vector: str = "embedding",
           shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row that satisfies
    ``is_query`` (a condition on the key)."""
    numbers = F.transform(F.col(vector), lambda v: v.cast("double"))
    ok = F.forall(numbers, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    taken = rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(key).cast("long").alias("id"), numbers.alias("vector"), is_query.alias("asks"), ok.alias("ok"))
    taken = taken.where(F.col("ok") & F.exists("vector", lambda v: v != 0))
    classes = materialize(_classes(taken.select("id", "vector"), k))

    sizes = classes.groupBy("dim").agg((F.count("*") / shard_rows).cast("int").alias("more"))  # a row a length
    dealt = classes.join(F.broadcast(sizes), "dim").withColumn(
        "shard", F.pmod(F.xxhash64("vector", F.lit("shard")), F.col("more") + 1).cast("int"))

    def make(key_, table):
        raw = np.stack([np.frombuffer(v, "<f8") for v in table.column("vector").to_pylist()])
        graph, entry = build(unit(raw))
        return (table.select(["dim", "shard", "vector", "ids"])
                .append_column("place", pa.array(np.arange(len(raw)), pa.int32()))
                .append_column("entry", pa.array(np.arange(len(raw)) == entry))
                .append_column("near", pa.array(list(graph), pa.list_(pa.int32()))))

    index = materialize(dealt.select("dim", "shard", "vector", "ids").groupBy("dim", "shard").applyInArrow(
        make, "dim int, shard int, vector binary, ids array<long>, place int, entry boolean, near array<int>"))

    asked = _classes(taken.where("asks").select("id", "vector"), 0).select("dim", "vector")
    blocks = asked.count() // query_rows + 1
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vector", F.lit("block")), F.lit(blocks)).cast("int"))
    visits = asked.join(F.broadcast(sizes), "dim").select(
        "dim", "block", F.explode(F.sequence(F.lit(0), "more")).alias("shard"), "vector")
    shards = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(int(blocks) - 1))))

    def visit(queries, shard):
        names = ["dim", "vector", "found"]
        kind = pa.list_(pa.struct([("score", pa.float64()), ("id", pa.int64())]))
        if not queries.num_rows or not shard.num_rows:
            return pa.table([pa.array([], pa.int32()), pa.array([], pa.binary()), pa.array([], kind)], names)
        shard = shard.sort_by("place")
        raw = np.stack([np.frombuffer(v, "<f8") for v in shard.column("vector").to_pylist()])
        graph = np.array(shard.column("near").to_pylist(), np.int32)
        ids = shard.column("ids").to_pylist()
        entry = shard.column("entry").to_pylist().index(True)
        asked = np.stack([np.frombuffer(v, "<f8") for v in queries.column("vector").to_pylist()])
        x, out = unit(raw), []
        for lo in range(0, len(asked), 512):
            some = asked[lo:lo + 512]
            places, _ = beam_search(x, graph, unit(some), entry, max(BEAM, k + 1))
            for q, row in zip(some, places):
                row = row[row >= 0]
                scores = cosine(q[None, :], raw[row])
                best = sorted((-s, i) for s, p in zip(scores.tolist(), row.tolist()) for i in ids[p])[:k + 1]
                out.append([{"score": -s, "id": i} for s, i in best])
        return pa.table([queries.column("dim"), queries.column("vector"), pa.array(out, kind)], names)

    by = ["dim", "shard", "block"]
    found = visits.groupBy(*by).cogroup(shards.groupBy(*by)).applyInArrow(
        visit, "dim int, vector binary, found array<struct<score:double,id:long>>")
    nearest = F.array_sort(F.transform(F.flatten(F.collect_list("found")), lambda f: F.struct(
        (-f["score"]).alias("minus"), f["id"].alias("id"))))
    found = found.groupBy("dim", "vector").agg(F.slice(nearest, 1, k + 1).alias("found"))

    def spell(batches):
        for batch in batches:
            vectors = [np.array(v, "<f8").tobytes() for v in batch.column("vector").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(list(map(len, vectors)), pa.int32()), pa.array(vectors, pa.binary())],
                ["id", "dim", "vector"])

    asking = taken.where("asks").select("id", "vector").mapInArrow(spell, "id long, dim int, vector binary")
    asking = asking.withColumn("dim", (F.col("dim") / 8).cast("int"))
    answers = asking.join(found, ["dim", "vector"]).select(
        F.col("id").alias("query_id"), F.posexplode(F.expr("filter(found, f -> f.id != id)")).alias("at", "f"))
    return answers.where(F.col("at") < k).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("f.id").alias("vec_id"),
        (-F.col("f.minus")).alias("score"))
