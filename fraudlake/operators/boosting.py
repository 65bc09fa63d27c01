"""Boosted trees as MLlib grows them, without a pair of Spark stages for every level.

``fit_boosted`` takes an MLlib ``GBTClassifier`` and returns the ``GBTClassificationModel`` that it
stands for: same bins, same sampled rows and features, same rules for a split, same loss. Only the
counting differs: rows are binned once into one byte a feature, and a level is counted with NumPy.
A table of at most ``TRAIN_ROWS`` rows is boosted inside one task; of a larger one every task
counts its blocks for each level, in every pair of siblings the smaller one only.
"""

import json
import math
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal, localcontext
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from .. import config as C
from ..session import remove, shared_dir

EPSILON = np.finfo(float).eps
INVALID = -np.finfo(float).max  # gain of a split that leaves too little on a side
MASK = (1 << 64) - 1
LANE = 64                       # random states that are drawn one after the other
REDUCED_TASKS = 32              # counts of more tasks are added up on the executors first
STATES_KEPT = 10                # trees after which the margins are written


# ---------------------------------------------------------------- random numbers of the JVM

def _murmur3(data: bytes, seed: int) -> int:
    h = seed
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) & 0xFFFFFFFF
        h ^= k * 0x1B873593 & 0xFFFFFFFF
        h = (h << 13 | h >> 19) & 0xFFFFFFFF
        h = (h * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def _first_state(seed: int) -> int:
    data = (seed & MASK).to_bytes(8, "big")
    low = _murmur3(data, 0x3C074A61)
    return _murmur3(data, low) << 32 | low


def _step(x):
    """The next state; of a number or of an array of ``uint64``."""
    if isinstance(x, int):
        x ^= x << 21 & MASK
        x ^= x >> 35
        return x ^ (x << 4 & MASK)
    x = x ^ x << np.uint64(21)
    x ^= x >> np.uint64(35)
    return x ^ x << np.uint64(4)


@lru_cache(maxsize=64)
def _jump(doublings: int) -> np.ndarray:
    """Tables, by byte of a state, of the state LANE * 2^doublings steps on: a step is linear in bits."""
    if doublings:
        half = _jump(doublings - 1)
        return _leap(half, half)
    bits = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for _ in range(LANE):
        bits = _step(bits)
    table = np.zeros((8, 256), np.uint64)
    for byte in range(8):
        for bit in range(8):
            table[byte, 1 << bit:2 << bit] = table[byte, :1 << bit] ^ bits[8 * byte + bit]
    return table


def _leap(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    return reduce(np.bitwise_xor, (
        table[i][(x >> np.uint64(8 * i)).astype(np.uint8)] for i in range(8)))


def sampled(seed: int, n: int, share: float) -> np.ndarray:
    """Which of ``n`` rows are drawn: the n first doubles of the JVM's generator below ``share``."""
    lanes = np.array([_first_state(seed)], np.uint64)
    doublings = 0
    while len(lanes) * LANE < 2 * n:
        lanes = np.concatenate([lanes, _leap(_jump(doublings), lanes)])
        doublings += 1
    lanes = lanes[:-(-2 * n // LANE)]
    states = np.empty((LANE, len(lanes)), np.uint64)
    for i in range(LANE):
        lanes = states[i] = _step(lanes)
    states = states.T.ravel()[:2 * n]
    high, low = states[::2] & np.uint64((1 << 26) - 1), states[1::2] & np.uint64((1 << 27) - 1)
    return ((high << np.uint64(27)) + low).astype(float) * 2.0 ** -53 < share


def java_longs(seed: int) -> Iterator[int]:
    """``java.util.Random(seed).nextLong()``, again and again."""
    state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)
    while True:
        parts = []
        for _ in range(2):
            state = (state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
            x = state >> 16
            parts.append(x - (1 << 32) if x >> 31 else x)
        yield (parts[0] << 32) + parts[1]


def reservoir(n: int, k: int, seed: int) -> list[int]:
    """``k`` of the numbers below ``n``, in the order in which MLlib's reservoir keeps them."""
    kept, x = list(range(k)), _first_state(seed)
    for item in range(k, n):
        x = _step(x)
        high = (x & (1 << 26) - 1) << 27
        x = _step(x)
        at = int((high + (x & (1 << 27) - 1)) * 2.0 ** -53 * (item + 1))
        if at < k:
            kept[at] = item
    return kept


@lru_cache(maxsize=1)
def _roots() -> tuple[np.ndarray, np.ndarray]:
    """2^(j/64) for j below 64, rounded down, and what is missing as a share of it."""
    with localcontext() as c:
        c.prec = 60
        exact = [Decimal(2) ** (Decimal(j) / 64) for j in range(64)]
        down = [f if Decimal(f) <= v else float(np.nextafter(f, 0)) for v, f in ((v, float(v)) for v in exact)]
        return np.array(down), np.array([float((v - Decimal(f)) / Decimal(f)) for v, f in zip(exact, down)])


def java_exp(x: np.ndarray) -> np.ndarray:
    """``Math.exp`` as HotSpot computes it on x86, to the last bit, for arguments within 700 of 0.
    ``np.exp`` differs in the last bit of one value in twenty, which turns ties between splits."""
    h = float.fromhex
    m = np.rint(x * h("0x1.71547652b82fep+6"))
    r = (x - m * h("0x1.62e42fefap-7")) - m * h("0x1.cf79abc9e3b3ap-46")
    m = m.astype(np.int64)
    roots, missing = _roots()
    square = r * r
    cube = r * square
    low = r + missing[m & 63] + cube * square * (h("0x1.11115c090cf0fp-7") + h("0x1.6c15ce3289860p-10") * r)
    grown = cube * (h("0x1.5555555548ba1p-3") + h("0x1.55555555b9e25p-5") * r) + low + square * h("0x1.ffffffffffffep-2")
    power = np.ldexp(roots[m & 63], m >> 6)
    return grown * power + power


# ---------------------------------------------------------------- a tree

@dataclass
class Settings:
    thresholds: list[np.ndarray]    # of each feature, ascending
    weights: tuple[float, float]    # of a row labelled 0, 1
    n_trees: int
    depth: int
    step: float
    share: float                    # of the rows, for a tree
    n_tried: int                    # features, for a node
    least_rows: int
    least_weight: float
    least_gain: float
    seed: int

    @property
    def n_bins(self) -> int:
        return 1 + max(1, *map(len, self.thresholds))

    def weight(self, tree: int) -> float:
        return self.step if tree else 1.0


@dataclass
class Tree:
    """Nodes in the order in which they were made. A leaf's feature is -1, its children itself."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    impurity: list[float] = field(default_factory=list)
    stats: list[tuple] = field(default_factory=list)   # weight, sum, sum of squares, rows
    depth: int = 0                                     # levels below the root
    level: list[int] = field(default_factory=list)     # nodes of the lowest level

    def add(self, stats) -> int:
        i = len(self.feature)
        for name, value in (("feature", -1), ("bin", 0), ("left", i), ("right", i), ("gain", -1.0),
                            ("impurity", float(_variance(*stats[:3]))), ("stats", tuple(map(float, stats)))):
            getattr(self, name).append(value)
        return i

    def predictions(self) -> np.ndarray:
        return np.array([s / w if w else 0.0 for w, s, *_ in self.stats])

    def walked(self, bins: np.ndarray, rows: np.ndarray, node: np.ndarray, levels: int) -> np.ndarray:
        """The nodes of ``rows`` so many levels below ``node``. A right child follows its left one."""
        feature, left = np.array(self.feature), np.array(self.left)
        cut = np.where(feature < 0, 255, self.bin).astype(np.uint8)  # no bin is beyond: a leaf's rows stay
        start, bins = np.maximum(feature, 0) * bins.shape[1], bins.ravel()
        for _ in range(levels):
            at = start.take(node)
            at += rows
            beyond = bins.take(at) > cut.take(node)
            node = left.take(node)
            node += beyond
        return node

    def scores(self, bins: np.ndarray) -> np.ndarray:
        rows = np.arange(bins.shape[1])
        return self.predictions().take(self.walked(bins, rows, np.zeros(len(rows), np.intp), self.depth))


def _variance(weight, total, squares):
    safe = np.where(weight == 0, 1.0, weight)
    return np.where(weight == 0, 0.0, (squares - total * total / safe) / safe)


def _best_splits(counts: np.ndarray, tried: np.ndarray, impurity: np.ndarray | None, s: Settings):
    """Per node: best gain, feature, bin, the node's impurity, stats of the node and both sides.
    ``counts``: node, feature, bin, stat. ``impurity`` of the nodes, None at the root."""
    at = np.arange(len(counts))
    sums = np.cumsum(counts[at[:, None], tried], axis=2)
    left, whole = sums[:, :, :-1], sums[:, :, -1:]
    right = whole - left
    n_splits = np.array([len(t) for t in s.thresholds])[tried]
    if impurity is None:
        first = np.argmax(n_splits > 0, axis=1)
        node = left[at, first, 0] + right[at, first, 0]
        impurity = _variance(node[:, 0], node[:, 1], node[:, 2])
    else:
        node = None
    weight = left[..., 0] + right[..., 0]
    safe = np.where(weight == 0, 1.0, weight)
    gain = (impurity[:, None, None] - left[..., 0] / safe * _variance(*np.moveaxis(left[..., :3], -1, 0))
            - right[..., 0] / safe * _variance(*np.moveaxis(right[..., :3], -1, 0)))
    small = ((left[..., 3] < s.least_rows) | (right[..., 3] < s.least_rows)
             | (left[..., 0] < s.least_weight) | (right[..., 0] < s.least_weight))
    gain = np.where(small | ~(gain >= s.least_gain), INVALID, gain)
    gain[np.arange(gain.shape[2]) >= n_splits[:, :, None]] = -np.inf
    best = gain.reshape(len(counts), -1).argmax(axis=1)  # the first feature, then the first bin, wins a tie
    f, b = np.divmod(best, gain.shape[2])
    return gain[at, f, b], tried[at, f], b, node, left[at, f, b], right[at, f, b]


def grow(count: Callable[[Tree, list[int]], np.ndarray], s: Settings, seed: int, siblings: bool) -> Tree:
    """One tree. ``count(tree, nodes)`` gives the stats of the nodes by feature and bin. With
    ``siblings`` only the smaller child of a node is counted and the other one is what is left."""
    tree, longs, n_features = Tree(), java_longs(seed), len(s.thresholds)
    open_nodes, pairs, before = [None], {}, {}
    while open_nodes:
        tried = np.array([range(n_features) if s.n_tried == n_features
                          else reservoir(n_features, s.n_tried, next(longs)) for _ in open_nodes])
        root = open_nodes[0] is None
        if root:
            counts = count(tree, [0])
        elif siblings:
            counts = _counted_siblings(count, tree, open_nodes, pairs, before)
        else:
            counts = count(tree, open_nodes)
        found = _best_splits(counts, tried, None if root else np.array([tree.impurity[i] for i in open_nodes]), s)
        if root:
            open_nodes = [tree.add(found[3][0])]
        if siblings:
            before = dict(zip(open_nodes, counts))
        below, pairs, last, made = [], {}, tree.depth + 1 == s.depth, len(tree.feature)
        for i, gain, feature, cut, left, right in zip(open_nodes, *found[:3], *found[4:]):
            if gain <= 0 or tree.depth == s.depth:
                tree.impurity[i] = -1.0 if gain <= INVALID else tree.impurity[i]  # as in MLlib's leaves
                continue
            tree.feature[i], tree.bin[i], tree.gain[i] = int(feature), int(cut), float(gain)
            tree.left[i], tree.right[i] = pair = tree.add(left), tree.add(right)
            for child in pair:
                if not last and abs(tree.impurity[child]) >= EPSILON:
                    below.append(child)
                    pairs[child] = (i, *pair)
        if len(tree.feature) > made:
            tree.depth, tree.level = tree.depth + 1, list(range(made, len(tree.feature)))
        open_nodes = below[::-1]  # MLlib's stack
    return tree


def _counted_siblings(count, tree, open_nodes, pairs, before) -> np.ndarray:
    """Counts of the open nodes: one of each pair is counted, the one with fewer rows."""
    smaller = {p: min(p[1:], key=lambda i: tree.stats[i][3]) for p in pairs.values()}
    wanted = list(dict.fromkeys(smaller.values()))
    counted = dict(zip(wanted, count(tree, wanted)))
    return np.array([counted[i] if i in counted else before[pairs[i][0]] - counted[smaller[pairs[i]]]
                     for i in open_nodes])


# ---------------------------------------------------------------- rows

@dataclass
class Block:
    """Binned rows: one partition, or several one after the other."""

    parts: list[tuple[int, int]]   # number and rows of each partition
    labels: np.ndarray             # 0 and 1
    bins: np.ndarray               # feature, row
    whole: bool = False            # no other block: sums in MLlib's order, equal to the last bit

    @classmethod
    def joined(cls, blocks: list["Block"]) -> "Block":
        blocks = sorted(blocks, key=lambda b: b.parts)
        return cls([p for b in blocks for p in b.parts], np.concatenate([b.labels for b in blocks]),
                   np.concatenate([b.bins for b in blocks], axis=1), True)

    def drawn(self, s: Settings, tree: int) -> np.ndarray:
        return np.concatenate([
            sampled(s.seed + tree + number, n, s.share) if s.share < 1 else np.ones(n, bool)
            for number, n in self.parts])

    def residuals(self, margins: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
        """What the next tree learns: the label, then the loss's negative gradient."""
        y = self.labels[rows] * 2.0 - 1.0
        if margins is None:
            return y
        power = 2.0 * y * margins[rows]
        return 4.0 * y / (1.0 + (java_exp(power) if self.whole else np.exp(power)))

    def after(self, margins: np.ndarray | None, tree: Tree, weight: float) -> np.ndarray:
        new = tree.scores(self.bins) * weight
        return new if margins is None else margins + new


class Rows:
    """Drawn rows of a block on their way down a tree."""

    def __init__(self, block: Block, drawn: np.ndarray, margins: np.ndarray | None, s: Settings):
        self.block, self.s = block, s
        self.rows = np.flatnonzero(drawn)
        self.node = np.zeros(len(self.rows), np.intp)
        # sums are taken by partition and then added up
        self.part = np.repeat(np.arange(len(block.parts)), [n for _, n in block.parts])[self.rows]
        residuals = block.residuals(margins, self.rows)
        self.positive = block.labels[self.rows] == 1
        self.total = np.where(self.positive, s.weights[1], s.weights[0]) * residuals
        self.squares = self.total * residuals

    def descend(self, tree: Tree, levels: int) -> None:
        """To the lowest level, which is so many below; rows in a higher leaf are left behind."""
        self.node = tree.walked(self.block.bins, self.rows, self.node, levels)
        going = self.node >= min(tree.level, default=0)
        if not going.all():
            for name in ("rows", "node", "part", "positive", "total", "squares"):
                setattr(self, name, getattr(self, name)[going])

    def count(self, nodes: list[int]) -> np.ndarray:
        """node, feature, bin, stat: weight, sum, sum of squares, rows."""
        slot_of = np.full(max([0, *nodes, self.node.max(initial=0)]) + 1, -1)
        slot_of[nodes] = np.arange(len(nodes))
        slots = slot_of.take(self.node)
        here = np.flatnonzero(slots >= 0) if slots.min(initial=0) < 0 else slice(None)
        rows, total, squares = self.rows[here], self.total[here], self.squares[here]
        base = (self.part[here] * len(nodes) + slots[here]) * self.s.n_bins
        positive = np.flatnonzero(self.positive[here])
        shape = len(self.block.parts), len(nodes), self.s.n_bins
        n = math.prod(shape)
        out = np.empty((len(nodes), len(self.block.bins), self.s.n_bins, 4))
        for f, bins in enumerate(self.block.bins):
            cell = base + bins.take(rows)
            found, ones = np.bincount(cell, minlength=n), np.bincount(cell[positive], minlength=n)
            for i, values in enumerate((
                (found - ones) * self.s.weights[0] + ones * self.s.weights[1],
                np.bincount(cell, total, n), np.bincount(cell, squares, n), found,
            )):
                out[:, f, :, i] = reduce(np.add, values.reshape(shape))
        return out


# ---------------------------------------------------------------- boosting

def boost_in_task(block: Block, s: Settings) -> Iterator[Tree]:
    """All trees over one block."""
    margins = None
    for m in range(s.n_trees):
        rows = Rows(block, block.drawn(s, m), margins, s)

        def count(tree, nodes, rows=rows):
            rows.descend(tree, min(tree.depth, 1))
            return rows.count(nodes)

        tree = grow(count, s, s.seed + m, siblings=False)
        yield tree
        margins = block.after(margins, tree, s.weight(m))


def kept(rdd):
    """Kept on the executors, each element by itself: two such RDDs zip without a pass of their own."""
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1)).persist(StorageLevel.MEMORY_AND_DISK)


def boost_in_jobs(blocks, s: Settings, spark) -> Iterator[Tree]:
    """All trees over an RDD of blocks: a job counts a level. The margins and the drawn rows of a
    tree are kept beside the blocks; every few trees they are written, so that the lineage ends."""
    context, states, written = spark.sparkContext, [], []

    def start(block):
        return None, np.packbits(block.drawn(s, 0))

    state = kept(blocks.map(start))
    for m in range(s.n_trees):
        both = blocks.zip(state)

        def count(tree, nodes, both=both):
            sent = context.broadcast(tree)

            def one(pairs):
                found = 0
                for block, (margins, drawn) in pairs:
                    rows = Rows(block, np.unpackbits(drawn, count=len(block.labels)), margins, s)
                    rows.descend(sent.value, sent.value.depth)
                    found = found + rows.count(nodes)
                return [found]

            parts = both.mapPartitions(one)
            try:
                if parts.getNumPartitions() > REDUCED_TASKS:
                    return parts.treeReduce(lambda a, b: a + b)
                return reduce(lambda a, b: a + b, parts.collect())
            finally:
                sent.destroy()

        tree = grow(count, s, s.seed + m, siblings=True)
        yield tree
        states.append(state)

        def after(pair, tree=tree, m=m):
            block, (margins, _) = pair
            return block.after(margins, tree, s.weight(m)), np.packbits(block.drawn(s, m + 1))

        if m + 1 < s.n_trees:
            state = kept(both.map(after))
            if (m + 1) % STATES_KEPT == 0 and context._jsc.sc().getCheckpointDir().isDefined():
                for old in written[:-1]:  # the last one was read to make this one
                    remove(spark, old.getCheckpointFile())
                state.checkpoint()
                written = [*written[-1:], state]
        for old in states[:-1]:  # the newest is still read to make the next one
            old.unpersist()
        states = states[-1:]
    for old in states:
        old.unpersist()
    for old in written:
        if old.getCheckpointFile():
            remove(spark, old.getCheckpointFile())


def binned(rows: DataFrame, features: str, label: str, thresholds: list[np.ndarray]) -> DataFrame:
    """One row per partition that has rows: its number, labels and bins, one byte each."""
    def pack(batches):
        number, labels, bins = 0, [], []
        for batch in batches:
            if batch.num_rows:
                number = batch.column(2)[0].as_py()
                values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(thresholds))
                bins.append(np.array([np.searchsorted(t, values[:, f]) for f, t in enumerate(thresholds)], np.uint8))
                labels.append(batch.column(1).to_numpy(zero_copy_only=False).astype(np.uint8))
        if labels:
            yield pa.RecordBatch.from_pydict({
                "number": pa.array([number], pa.int32()),
                "labels": pa.array([np.concatenate(labels).tobytes()], pa.binary()),
                "bins": pa.array([np.concatenate(bins, axis=1).tobytes()], pa.binary())})

    # the number is that of the rows' own partition, also where a task reads several
    return rows.select(
        vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), F.spark_partition_id().alias("p"),
    ).mapInArrow(pack, "number int, labels binary, bins binary")


def as_block(row) -> Block:
    labels = np.frombuffer(row["labels"], np.uint8)
    return Block([(row["number"] + 1, len(labels))], labels,
                 np.frombuffer(row["bins"], np.uint8).reshape(-1, len(labels)))


def settings(learner, rows: DataFrame, weights: tuple[float, float]) -> tuple[Settings, int]:
    """What MLlib itself would use, and the number of rows; MLlib checks labels, weights and
    features on the way and finds the thresholds."""
    jvm, java = rows.sparkSession.sparkContext._jvm, learner._to_java()
    scala = jvm.scala
    instances = getattr(jvm.org.apache.spark.ml.util, "DatasetUtils$").__getattr__("MODULE$").extractInstances(
        java, rows._jdf, scala.Some(2))
    old = jvm.org.apache.spark.mllib.tree.configuration
    strategy = java.getOldBoostingStrategy(
        getattr(scala.collection.immutable, "Map$").__getattr__("MODULE$").empty(),
        old.Algo.Classification()).treeStrategy().copy()
    strategy.setAlgo(old.Algo.Regression())
    strategy.setImpurity(jvm.org.apache.spark.mllib.tree.impurity.Variance.instance())
    facts = jvm.org.apache.spark.ml.tree.impl.DecisionTreeMetadata.buildMetadata(
        instances, strategy, 1, learner.getFeatureSubsetStrategy())
    forest = getattr(jvm.org.apache.spark.ml.tree.impl, "RandomForest$").__getattr__("MODULE$")
    splits = forest.findSplits(instances, facts, learner.getSeed())
    thresholds = [np.array([split.threshold() for split in of_feature]) for of_feature in splits]
    return Settings(
        thresholds, weights, learner.getMaxIter(), learner.getMaxDepth(), learner.getStepSize(),
        learner.getSubsamplingRate(), facts.numFeaturesPerNode(), learner.getMinInstancesPerNode(),
        facts.minWeightPerNode(), learner.getMinInfoGain(), learner.getSeed()), facts.numExamples()


def fit_boosted(learner, rows: DataFrame, weights: tuple[float, float]) -> GBTClassificationModel:
    """``learner.fit(rows)``; ``weights`` are those in its weight column, of label 0 and of label 1."""
    if learner.getMaxBins() > 256 or learner.isDefined(learner.validationIndicatorCol):
        raise ValueError("at most 256 bins, no validation rows")
    s, n_rows = settings(learner, rows, weights)
    blocks = binned(rows, learner.getFeaturesCol(), learner.getLabelCol(), s.thresholds)
    if n_rows <= C.TRAIN_ROWS:
        def boost(batches):
            found = [as_block(r) for batch in batches for r in batch.to_pylist()]
            for number, tree in enumerate(boost_in_task(Block.joined(found), s) if found else ()):
                yield nodes_of(number, tree, s)

        return as_model(learner, blocks.repartition(1).mapInArrow(boost, from_arrow_schema(NODES)), s)
    tasks = rows.sparkSession.sparkContext.defaultParallelism  # which blocks share a task matters for no result
    held = kept(blocks.rdd.map(as_block).coalesce(tasks))
    try:
        trees = boost_in_jobs(held, s, rows.sparkSession)
        table = pa.Table.from_batches([nodes_of(number, tree, s) for number, tree in enumerate(trees)], NODES)
    finally:
        held.unpersist()
    return as_model(learner, rows.sparkSession.createDataFrame(table), s)


# ---------------------------------------------------------------- the model

_SPLIT = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                    ("numCategories", pa.int32())])
NODES = pa.schema([("treeID", pa.int32()), ("nodeData", pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()),
    ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()), ("gain", pa.float64()),
    ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", _SPLIT)]))])


def nodes_of(number: int, tree: Tree, s: Settings) -> pa.RecordBatch:
    """The tree's nodes as MLlib writes them: numbered from the root, left before right; a node
    whose two leaves predict the same is a leaf."""
    says, out, leaf = tree.predictions(), [], [f < 0 for f in tree.feature]
    for i in reversed(range(len(leaf))):  # children are made after their parents
        a, b = tree.left[i], tree.right[i]
        leaf[i] = leaf[i] or (leaf[a] and leaf[b] and says[a] == says[b])

    def write(i: int) -> int:
        at = len(out)
        out.append(node := {
            "id": at, "prediction": float(says[i]), "impurity": tree.impurity[i],
            "impurityStats": list(tree.stats[i][:3]), "rawCount": int(tree.stats[i][3]), "gain": -1.0, "leftChild": -1,
            "rightChild": -1, "split": {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}})
        if not leaf[i]:
            f = tree.feature[i]
            node["gain"] = tree.gain[i]
            node["split"] = {"featureIndex": f, "numCategories": -1,
                             "leftCategoriesOrThreshold": [float(s.thresholds[f][tree.bin[i]])]}
            node["leftChild"], node["rightChild"] = write(tree.left[i]), write(tree.right[i])
        return at

    write(0)
    return pa.RecordBatch.from_pylist([{"treeID": number, "nodeData": n} for n in out], NODES)


def as_model(learner, nodes: DataFrame, s: Settings) -> GBTClassificationModel:
    """The model of the trees' nodes: written in MLlib's own format and loaded."""
    spark = nodes.sparkSession

    def described(kind: str, uid: str, names: set | None = None, **more) -> str:
        chosen, default = ({p.name: v for p, v in found.items() if names is None or p.name in names}
                           for found in (learner._paramMap, learner._defaultParamMap))
        return json.dumps({
            "class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
            "uid": uid, "paramMap": chosen, "defaultParamMap": default, **more})

    of_tree = {p.name for p in DecisionTreeRegressor().params} & {p.name for p in learner.params}
    path = shared_dir(spark)
    spark.createDataFrame([(described(
        "classification.GBTClassificationModel", learner.uid, numFeatures=len(s.thresholds),
        numTrees=s.n_trees),)], "value string").coalesce(1).write.text(path + "/metadata")
    spark.createDataFrame([
        (i, described("regression.DecisionTreeRegressionModel", f"{learner.uid}_{i}", of_tree), s.weight(i))
        for i in range(s.n_trees)], "_1 int, _2 string, _3 double").coalesce(1).write.parquet(path + "/treesMetadata")
    nodes.write.parquet(path + "/data")
    try:
        return GBTClassificationModel.load(path)
    finally:
        remove(spark, path)
