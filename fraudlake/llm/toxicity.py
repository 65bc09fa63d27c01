"""Toxicity of texts by a convolutional classifier, trained in numpy on all labelled rows, calibrated by language.

**Words** are runs of letters, digits and underscores, lower-cased. A word's embedding is the sum
of the hashed embeddings of the word itself and of its first three, four and five letters, so
inflected and compound forms share what their stem was taught.

**Network.** ``FILTERS`` filters of each width in ``WIDTHS`` slide over the embeddings, the
largest answer of each over the whole text is kept (rectified), and a linear layer makes a
logit of them. Training is plain back-propagation through the winning windows, with Adagrad. The
first component of each embedding starts as the hashed feature's log odds in the training rows.

**Learning.** Every labelled row that the caller allows takes part. They are dealt by a hash of the
key into shards of about ``SHARD_ROWS`` rows or ``SHARD_BYTES`` of text. The odds count all rows.
In each of ``ROUNDS`` rounds every shard trains the common network for ``EPOCHS`` epochs in a task of its
own. Then each embedding moves by the mean move of the shards that moved it, and the other weights become
the shards' mean. With one shard this is plain training. The driver sees the network and a count for each
bucket, no text.

**Calibration.** A fifth of the rows takes no part in training. For each language, as told from the
text by the identifier of this package (which learns from a bounded number of texts a language),
the cut of best F1 over all of them is found by running totals (languages with fewer than
``FEW`` rows of a label use the common cut). The score is the logistic function of the logit less
the cut: 0.5 or more means toxic.

Scoring reads whole texts in blocks and shuffles nothing; long ones pass in slices of
``WINDOWS`` windows.

Rows: one for each input row; null and empty texts, and those without a word, get the logit of an
empty text; repeated rows get equal scores. Without rows of both labels every score is the
share of toxic labels, 0 if there is none. An empty table gives an empty one. Other columns
are not looked at.
"""

import copy
import re
import zlib
from collections import defaultdict
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..operators.joins import fits_broadcast
from ..operators.prefix import BIN, range_splits, running_totals, with_ranges
from ..session import discard, materialize
from . import language
from .common import BLOCK_BYTES, strings, text_blocks

BUCKETS, DIM, FILTERS, WIDTHS = 1 << 18, 16, 16, (1, 2, 3)
SHARD_ROWS, SHARD_BYTES = 1 << 14, 64 << 20
FEW = 15
ROUNDS, EPOCHS, BATCH, RATE = 3, 2, 32, 0.1
WINDOWS = 1 << 13  # their answers stay in a core's cache
BLOCK = 1 << 20
KNOWN_WORDS = 150_000
PAD = max(WIDTHS)
SHARD = {"line": np.int32, "begins": np.int64, "sizes": np.int64, "of": np.int32, "y": np.float64}
_WORD = re.compile(r"\w+")
_SPACED = bytes(i if _WORD.fullmatch(chr(i)) else 32 for i in range(256))


def words_of(text: str) -> list[str]:
    """The lower-cased words; texts of Latin-1 characters are split without the regular expression."""
    text = text.lower()
    try:
        return text.encode("latin-1").translate(_SPACED).decode("latin-1").split()
    except UnicodeEncodeError:
        return _WORD.findall(text)


def features(word: str) -> tuple[int, int, int, int]:
    """Buckets of the word and of its beginnings."""
    raw = word.encode()
    a, b, c = (raw[:3], raw[:4], raw[:5]) if word.isascii() else (word[:3].encode(), word[:4].encode(), word[:5].encode())
    return (zlib.crc32(raw) % BUCKETS, zlib.crc32(a, 3) % BUCKETS, zlib.crc32(b, 4) % BUCKETS,
            zlib.crc32(c, 5) % BUCKETS)


def add_rows(table: np.ndarray, at: np.ndarray, rows: np.ndarray):
    """``table[at] += rows``, repeated places included, in order; numpy is fast at this on flat arrays only."""
    np.add.at(table.reshape(-1), (at[:, None] * DIM + np.arange(DIM)).ravel(), rows.ravel())


def taken(tables: np.ndarray, line: np.ndarray, n: int) -> np.ndarray:
    """The sum over all offsets of the rows that ``n`` windows of the line have there, and one row of room."""
    out = np.empty((n + 1, tables.shape[2]), tables.dtype)
    tables[0].take(line[:n], 0, out[:n], "clip")
    for o in range(1, len(tables)):
        out[:n] += tables[o].take(line[o:n + o], 0, mode="clip")
    return out


class Lexicon:
    """Numbers words as they are met; 0 is the padding."""

    def __init__(self):
        self.number = defaultdict(count(1).__next__, {"": 0})

    def line(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(all words one after the other with padding after each text, begins, word counts)."""
        number, parts, sizes, pad = self.number, [], [], np.zeros(PAD, np.int32)
        for text in texts:
            words = words_of(text)
            parts += [np.fromiter(map(number.__getitem__, words), np.int32, len(words)), pad]
            sizes.append(len(words))
        sizes = np.array(sizes, np.int64)
        return np.concatenate([*parts, pad]), np.cumsum(sizes + PAD) - sizes - PAD, sizes

    def new_features(self, seen: int) -> np.ndarray:
        rows = [x for w in islice(self.number, seen, None) for x in features(w)]
        return np.array(rows, np.int32).reshape(-1, 4)


class Network:
    """Embeddings, filters by width (offset, DIM, FILTERS), their biases, output weights."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        self.embed = r.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
        self.filters = {w: r.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS}
        for f in self.filters.values():
            f[:, 0, :FILTERS // 2] = np.abs(f[:, 0, :FILTERS // 2]) + 0.3
        self.bias = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        self.out = r.normal(0.1, 0.1, FILTERS * len(WIDTHS)).astype(np.float32)
        self.shift = np.float32(0)
        self.memory = {"embed": np.full(BUCKETS, 1e-3, np.float32), "out": np.full(self.out.shape, 1e-3, np.float32),
                       "shift": np.float32(1e-3),
                       **{w: np.full(self.filters[w].shape, 1e-3, np.float32) for w in WIDTHS},
                       **{("bias", w): np.full(FILTERS, 1e-3, np.float32) for w in WIDTHS}}

    def dense(self) -> np.ndarray:
        """All but the embeddings as rows of ``DIM`` numbers, what Adagrad keeps of them included."""
        flat = np.concatenate([np.ravel(x) for x in (
            *(self.filters[w] for w in WIDTHS), *(self.bias[w] for w in WIDTHS), self.out, self.shift,
            *(self.memory[w] for w in WIDTHS), *(self.memory["bias", w] for w in WIDTHS),
            self.memory["out"], self.memory["shift"])]).astype(np.float32)
        return np.pad(flat, (0, -len(flat) % DIM)).reshape(-1, DIM)

    def set_dense(self, rows: np.ndarray):
        flat, at = rows.ravel(), 0

        def take(like):
            nonlocal at
            at += np.size(like)
            return flat[at - np.size(like):at].reshape(np.shape(like)).astype(np.float32)

        self.filters = {w: take(self.filters[w]) for w in WIDTHS}
        self.bias = {w: take(self.bias[w]) for w in WIDTHS}
        self.out, self.shift = take(self.out), take(self.shift)[()]
        for k in (*WIDTHS, *(("bias", w) for w in WIDTHS), "out", "shift"):
            self.memory[k] = take(self.memory[k])

    def vectors(self, of: np.ndarray) -> np.ndarray:
        out = self.embed.take(of[:, 0], 0)
        for i in range(1, of.shape[1]):
            out += self.embed.take(of[:, i], 0)
        return out

    def answers(self, vectors: np.ndarray) -> dict[int, np.ndarray]:
        """What a word adds to each filter at each of its offsets, with a first row of zeros."""
        return {w: np.matmul(vectors, f) for w, f in self.filters.items()}

    def pooled(self, answers, line, begins, sizes) -> np.ndarray:
        """The largest answer of every filter over each text."""
        out = np.full((len(begins), FILTERS * len(WIDTHS)), -np.inf, np.float32)
        ends = begins + sizes + 1  # the window of padding alone belongs to the text
        for lo in range(0, len(line) - PAD, WINDOWS):
            hi = min(lo + WINDOWS, len(line) - PAD)
            here = np.flatnonzero((begins < hi) & (ends > lo))
            if not len(here):
                continue
            cuts = np.empty(2 * len(here), np.int64)
            cuts[0::2], cuts[1::2] = np.maximum(begins[here], lo) - lo, np.minimum(ends[here], hi) - lo
            for k, w in enumerate(WIDTHS):
                found = taken(answers[w], line[lo:hi + w], hi - lo)
                found[-1] = -np.inf
                mine = slice(k * FILTERS, (k + 1) * FILTERS)
                out[here, mine] = np.maximum(out[here, mine], np.maximum.reduceat(found, cuts, axis=0)[0::2])
        return np.maximum(out + np.concatenate([self.bias[w] for w in WIDTHS]), 0)

    def logits(self, answers, line, begins, sizes) -> np.ndarray:
        return self.pooled(answers, line, begins, sizes) @ self.out + self.shift

    def train(self, line, begins, sizes, of, y, weight, mine, epochs=EPOCHS, seed=5):
        """``of``: the buckets of each word; ``weight``: of each text; ``mine``: the texts to learn."""
        r, place = np.random.default_rng(seed), np.zeros(len(of), np.int64)
        there = np.zeros(len(of), bool)
        for _ in range(epochs):
            order = r.permutation(mine)
            for lo in range(0, len(order), BATCH):
                self._step(line, begins, sizes, of, y, weight, order[lo:lo + BATCH], place, there)

    def _step(self, line, begins, sizes, of, y, weight, docs, place, there):
        """``place``, ``there``: room for a number and a mark a word, the marks false before and after."""
        memory = self.memory
        # the batch's own line of words
        lengths = sizes[docs] + PAD
        ends = np.cumsum(lengths)
        starts = ends - lengths
        words = line[np.arange(ends[-1]) + np.repeat(begins[docs] - starts, lengths)]
        words = np.concatenate([words, np.zeros(PAD, line.dtype)])
        there[words] = True
        known = np.flatnonzero(there)
        place[known], there[known] = np.arange(len(known)), False
        words = place[words]
        vectors = self.vectors(of[known])
        vectors[known == 0] = 0
        answers, best, pooled = self.answers(vectors), {}, []
        for w in WIDTHS:
            found = taken(answers[w], words, len(words) - PAD)
            best[w] = np.array([s + found[s:s + n + 1].argmax(0) for s, n in zip(starts.tolist(), sizes[docs].tolist())])
            pooled.append(np.take_along_axis(found, best[w], 0) + self.bias[w])
        pooled = np.concatenate(pooled, 1)
        shown = np.maximum(pooled, 0)
        g = (1 / (1 + np.exp(-np.clip(shown @ self.out + self.shift, -30, 30))) - y[docs]) * weight[docs] / len(docs)
        back = (g[:, None] * self.out[None, :] * (pooled > 0)).astype(np.float32)
        moved = np.zeros_like(vectors)
        for k, w in enumerate(WIDTHS):
            mine = back[:, k * FILTERS:(k + 1) * FILTERS]
            grad = np.empty_like(self.filters[w])
            for o in range(w):
                at = words[best[w] + o]
                grad[o] = np.einsum("dfk,df->kf", vectors[at], mine)
                add_rows(moved, at.ravel(), mine[:, :, None] * self.filters[w][o].T[None])
            memory[w] += grad * grad
            self.filters[w] -= RATE * grad / np.sqrt(memory[w])
            grad = mine.sum(0)
            memory["bias", w] += grad * grad
            self.bias[w] -= RATE * grad / np.sqrt(memory["bias", w])
        grad = g @ shown
        memory["out"] = memory["out"] + grad * grad
        self.out -= (RATE * grad / np.sqrt(memory["out"])).astype(np.float32)
        memory["shift"] += float(g.sum()) ** 2
        self.shift -= np.float32(RATE * g.sum() / np.sqrt(memory["shift"]))
        touched = np.flatnonzero(np.abs(moved).sum(1) * (known > 0))
        buckets, rows = np.unique(of[known[touched]], return_inverse=True)
        grads = np.zeros((len(buckets), DIM), np.float32)
        add_rows(grads, rows.ravel(), np.repeat(moved[touched], 4, axis=0))
        memory["embed"][buckets] += (grads * grads).mean(1)
        self.embed[buckets] -= RATE * grads / np.sqrt(memory["embed"][buckets])[:, None]


class Model:
    """What scoring needs; a worker keeps the answers of the words it has met (bounded)."""

    def __init__(self, network, speaks, cuts, common, share):
        self.network, self.speaks, self.cuts, self.common, self.share = network, speaks, cuts, common, share

    def forget(self):
        self.lexicon = Lexicon()
        self.answers = self.network.answers(np.zeros((1, DIM), np.float32))

    def told(self, texts: pa.Array) -> tuple[np.ndarray, list[str]]:
        """Logits and languages."""
        if not hasattr(self, "lexicon") or len(self.lexicon.number) > KNOWN_WORDS:
            self.forget()
        seen = len(self.lexicon.number)
        line, begins, sizes = self.lexicon.line(strings(texts))
        new = self.lexicon.new_features(seen)
        if len(new):
            for w, more in self.network.answers(self.network.vectors(new)).items():
                if self.answers[w].shape[1] < seen + len(new):  # doubled, so that a word is copied about once
                    room = np.empty((w, 2 * (seen + len(new)), FILTERS), np.float32)
                    room[:, :seen] = self.answers[w][:, :seen]
                    self.answers[w] = room
                self.answers[w][:, seen:seen + len(new)] = more
        logits = self.network.logits(self.answers, line, begins, sizes).astype(np.float64)
        return logits, self.speaks.predict(texts)[0]

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.share)
        logits, langs = self.told(texts)
        cuts = np.array([self.cuts.get(x, self.common) for x in langs])
        return 1 / (1 + np.exp(-np.clip(logits - cuts, -500, 500)))


def best_cut(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The middle of the gap that gives the best F1, rows counted by their weight. ``best_cuts`` finds the
    same by language over any number of rows."""
    order = np.argsort(-logits, kind="stable")
    x, hit, all_ = logits[order], np.cumsum((y * weight)[order]), np.cumsum(weight[order])
    score = 2 * hit / (all_ + (y * weight).sum())
    ends = np.append(x[1:] != x[:-1], True)  # a cut can't part equal values
    i = int(np.argmax(np.where(ends, score, -1)))
    return float((x[i] + (x[i + 1] if i + 1 < len(x) else x[i] - 2)) / 2)


def best_cuts(told: DataFrame) -> tuple[dict[str, float], float]:
    """``best_cut`` of each ``lang`` with enough rows of both labels, and of all rows, from every row's
    (lang, logit, y)."""
    told = materialize(told)  # read three times below
    rows = told.select(F.explode(F.array(F.concat(F.lit("="), "lang"), F.lit(""))).alias("of"), "logit", "y")
    points = rows.groupBy("of", "logit").agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n"))
    curve = running_totals(with_ranges(points, range_splits(told, ["logit"])), "logit", {"pos": "hit", "n": "all"},
                           ["of"], "logit" + BIN, descending=True)
    clean = F.col("all_total") - F.col("hit_total")
    some = (F.col("of") == "") | (F.least("hit_total", clean) >= FEW)
    f1 = 2 * F.col("hit") / (F.col("all") + F.col("hit_total"))
    x, following = F.col("logit"), F.coalesce("next_value", F.col("logit") - 2)
    found = {r["of"]: r["cut"] for r in curve.where(some).groupBy("of").agg(
        F.max_by((x + following) / 2, F.struct(f1, x)).alias("cut")).collect()}  # one row a language
    discard(told)
    return {k[1:]: v for k, v in found.items() if k}, found[""]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        label: str = "toxic") -> Model:
    """Learns from the rows of ``labels`` given, and the language from those of ``docs``."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(label).cast("int").alias("y"))
    size = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return Model(None, None, {}, 0.0, 1.0 if 1 in size else 0.0)
    apart = F.pmod(F.xxhash64("key", F.lit("toxicity cut")), F.lit(5)) == 0
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text")).join(
        F.broadcast(known) if fits_broadcast(known) else known, "key").select("key", "text", "y", apart.alias("apart"))
    found = rows.groupBy("apart", "y").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).collect()
    n = {(r.apart, r.y): r.n for r in found}
    if not {(False, 0), (False, 1)} <= set(n):
        return Model(None, None, {}, 0.0, size[1] / (size[0] + size[1]))
    learned = n[False, 0] + n[False, 1]
    shards = -(-max(learned / SHARD_ROWS, sum(r["size"] for r in found if not r.apart) / SHARD_BYTES) // 1)
    dealt = deal(rows.where(~F.col("apart")), max(1, int(shards))).persist(StorageLevel.DISK_ONLY)
    try:
        network = Network()
        network.embed[:, 0] = log_odds(word_counts(dealt), n[False, 0], n[False, 1])
        for i in range(ROUNDS):
            train_round(dealt, network, (0.5 * learned / n[False, 0], 0.5 * learned / n[False, 1]), seed=5 + i)
    finally:
        dealt.unpersist()

    model = Model(network, language.fit(docs, key, text, lang), {}, 0.0, 0.0)
    judged = rows.where("apart" if {(True, 0), (True, 1)} <= set(n) else "not apart").select("text", "y")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def tell(batches):
        for block in text_blocks(batches, "text", BLOCK):
            logits, langs = shared.value.told(block.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(logits), block.column("y")],
                                             ["lang", "logit", "y"])

    model.cuts, model.common = best_cuts(judged.mapInArrow(tell, "lang string, logit double, y int"))
    del network.memory  # only training needs it
    return model


def deal(rows: DataFrame, shards: int) -> DataFrame:
    """The (key, text, y) rows dealt by their keys; each partition is read into words once and holds the
    parts of a shard's arrays as rows (name, data), in order."""
    def read(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        rows = pa.Table.from_batches(batches).sort_by([("text", "ascending"), ("y", "ascending")])
        lexicon = Lexicon()
        line, begins, sizes = lexicon.line(rows["text"].to_pylist())
        of = np.concatenate([np.zeros((1, 4), np.int32), lexicon.new_features(1)])
        for name, array in zip(SHARD, (line, begins, sizes, of, rows["y"].to_numpy().astype(np.float64))):
            data = array.tobytes()
            for at in range(0, len(data), BLOCK_BYTES):
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([data[at:at + BLOCK_BYTES]])], ["name", "data"])

    # no more tasks than shards, each brings its own moves
    return rows.repartition(shards, "key").coalesce(shards).select("text", "y").mapInArrow(
        read, "name string, data binary")


def shard_of(batches) -> list[np.ndarray] | None:
    """Line, begins, sizes, buckets of each word, and labels."""
    parts = {name: [] for name in SHARD}
    for batch in batches:
        for name, data in zip(batch.column("name").to_pylist(), batch.column("data").to_pylist()):
            parts[name].append(data)
    line, begins, sizes, of, y = (np.frombuffer(b"".join(parts[name]), kind) for name, kind in SHARD.items())
    return [line, begins, sizes, of.reshape(-1, 4), y] if len(y) else None


def word_counts(dealt: DataFrame) -> pa.Table:
    """(bucket, n0, n1): how many texts of either label hold each bucket; at most ``BUCKETS`` rows."""
    def held_by(batches):
        shard = shard_of(batches)
        if shard is None:
            return
        line, begins, sizes, of, labels = shard
        held = np.zeros((2, BUCKETS), np.int64)
        for at, n, y in zip(begins.tolist(), sizes.tolist(), labels.astype(int).tolist()):
            held[y, np.unique(of[np.unique(line[at:at + n])])] += 1
        there = np.flatnonzero(held.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(held[0, there]), pa.array(held[1, there])],
                                         ["bucket", "n0", "n1"])

    counted = dealt.mapInArrow(held_by, "bucket long, n0 long, n1 long")
    return counted.groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()


def log_odds(counted: pa.Table, n0: int, n1: int) -> np.ndarray:
    """Of each bucket, by how many training texts of either label hold it; those in one text and unseen ones 0."""
    held = np.zeros((2, BUCKETS))
    for y in (0, 1):
        held[y, counted["bucket"].to_numpy()] = counted[f"n{y}"].to_numpy()
    odds = np.log((held[1] + 0.5) / (n1 + 1)) - np.log((held[0] + 0.5) / (n0 + 1))
    return np.where(held.sum(0) > 1, np.clip(odds, -3, 3) / 4, 0).astype(np.float32)


def train_round(dealt: DataFrame, network: Network, weights: tuple[float, float], seed: int):
    """Train the network on each shard apart and bring the moves together. Rows
    from 0 are embeddings, those below 0 the other weights."""
    shared = dealt.sparkSession.sparkContext.broadcast(network)
    names = [f"d{i}" for i in range(DIM)]

    def run(batches):
        shard = shard_of(batches)
        if shard is None:
            return
        (line, begins, sizes, of, y), own = shard, copy.deepcopy(shared.value)
        own.train(line, begins, sizes, of, y, np.where(y == 1, weights[1], weights[0]), np.arange(len(y)), seed=seed)
        grown = own.memory["embed"] - shared.value.memory["embed"]
        there, dense = np.flatnonzero(grown), own.dense()
        moved = np.concatenate([own.embed[there] - shared.value.embed[there], dense])
        number = np.concatenate([there, -1 - np.arange(len(dense))]).astype(np.int32)
        grown = np.concatenate([grown[there], np.zeros(len(dense), np.float32)])
        yield pa.RecordBatch.from_arrays([pa.array(number), *map(pa.array, moved.T.copy()), pa.array(grown)],
                                         ["number", *names, "grown"])

    moves = dealt.mapInArrow(run, "number int, " + ", ".join(f"{c} float" for c in [*names, "grown"]))
    mean = moves.groupBy("number").agg(*[F.avg(c).cast("float").alias(c) for c in [*names, "grown"]]).toArrow()
    mean = mean.sort_by("number")
    number, moved = mean["number"].to_numpy(), np.stack([mean[c].to_numpy() for c in names], 1)
    embeds = number >= 0
    network.embed[number[embeds]] += moved[embeds]
    network.memory["embed"][number[embeds]] += mean["grown"].to_numpy()[embeds]
    network.set_dense(moved[~embeds][::-1])
    shared.destroy()


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """All columns and the score (a column of that name is replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x DIM numbers, and the language's weights
    kept = docs.drop(name)

    def run(batches):
        for block in text_blocks(batches, text, BLOCK):
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(shared.value.scores(block.column(text)))],
                                             [*block.schema.names, name])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{fields}, `{name}` double")


def held_out(key: str = "doc_id"):
    """Rows kept apart from learning: crc32 of the key as text is divisible by 5. A null key is
    not held out (and not learned from)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def detect(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
           label: str = "toxic") -> DataFrame:
    """(key, held_out, score, predicted) of every row, learned from the labels of the others."""
    model = fit(docs.where(~held_out(key)), labels.where(~held_out(key)), key, text, lang, label)
    found = score(docs.select(key, text, held_out(key).alias("held_out")), model, text)
    return found.select(key, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
