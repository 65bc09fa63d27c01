"""Token ids in Huffman-coded block files.

**Coding.** Ids are counted over all documents; package-merge gives the shortest code with
at most ``MAX_BITS`` bits, and the canonical order makes it known from its lengths alone.

**Files.** A folder with two Parquet tables: ``code`` (id, bits) and ``blocks``, one row for
about ``BLOCK_IDS`` ids of consecutive documents: their keys and numbers of ids, the bit
stream, and the bit offset of every ``STRIDE``-th id. Blocks are decoded without each other;
within a block the strides are decoded side by side, a table look-up for each id.
``part`` numbers the ranges of keys in ascending order, ``before`` counts the part's ids
before the block.

**Tokens.** Texts below U+0100 are split as the tokenizer's own pattern splits them and each
distinct piece goes through the tokenizer once; other texts, and those that hold the name of a
special token, go through it whole. Ids are counted block by block as they are made.

Rows: one for each input row, in ascending order of the key (null first), equal keys by
a hash of their ids. Null and empty texts have the end id only. An empty table gives files without
rows. Other columns are not looked at.
"""

import os
import re
import zlib
from collections import defaultdict
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, shared_dir
from .bpe import LATIN_LETTERS, LATIN_NUMBERS, LATIN_SPACE
from .common import strings, text_blocks

MAX_BITS = 18
BLOCK_IDS = 1 << 16
STRIDE = 256
IDS_PER_PART = 1 << 27
KNOWN_WORDS = 600_000
# letters first: only a quote can begin one of the other kinds that begins with it too
LATIN_WORDS = (rf"[{LATIN_LETTERS}]+|[{LATIN_NUMBERS}]|'(?:s|t|re|ve|m|ll|d)"
               rf"|[^{LATIN_SPACE}{LATIN_LETTERS}{LATIN_NUMBERS}]+")


class WordTokenizer:
    """Ids of texts; pieces are numbered as they are met and their ids kept (bounded)."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pattern = re.compile(LATIN_WORDS)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self):
        self.number: dict[str, int] = defaultdict(self._next)
        self.flat, self.starts = np.empty(0, np.uint32), np.zeros(1, np.int64)  # ids of piece i: starts[i] on

    def _next(self):
        return len(self.number)

    def _learn(self, words: list[str]):
        """Appends the ids of the words."""
        parts, sizes = [self.flat], [np.diff(self.starts)]
        for lo in range(0, len(words), 2000):
            some = words[lo:lo + 2000]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, np.uint32)
            last = np.flatnonzero(self.ends[ids])
            if len(last) == len(some) and last[-1] == len(ids) - 1:
                parts.append(ids)
                sizes.append(np.diff(last, prepend=-1))
            else:  # pieces that don't end where expected go one by one
                alone = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in some]
                parts += [np.array(x, np.uint32) for x in alone]
                sizes.append(np.array([len(x) for x in alone]))
        self.flat = np.concatenate(parts)
        self.starts = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])

    def plain(self, text: str) -> bool:
        """Whether the pattern splits the text as the tokenizer does."""
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return False
        return not any(name in text for name in self.special)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts, how many each has)."""
        if len(self.number) > KNOWN_WORDS:
            self.forget()
        number, seen, find = self.number, len(self.number), self.pattern.findall
        whole = {i: np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32)
                 for i, t in enumerate(texts) if not self.plain(t.lower())}
        words = [np.fromiter(map(number.__getitem__, () if i in whole else find(t.lower())), np.int64)
                 for i, t in enumerate(texts)]
        new = list(islice(number, seen, None))
        if new:
            self._learn(new)
        flat = np.concatenate(words) if words else np.empty(0, np.int64)
        size = np.diff(self.starts)[flat]
        ends = np.cumsum(size)
        ids = self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[flat] - ends + size, size)]
        last = np.concatenate([[0], ends])[np.cumsum([len(w) for w in words])]
        counts = np.diff(last, prepend=0)
        if whole:
            parts = np.split(ids, last[:-1])
            for i, x in whole.items():
                parts[i], counts[i] = x, len(x)
            ids = np.concatenate(parts)
        return ids, counts


def _tokenizer(shared, made={}):  # noqa: B006  one for each Python worker
    name, spec = shared.value
    if name not in made:
        made.clear()
        made[name] = WordTokenizer(spec)
    return made[name]


def tokenize(docs: DataFrame, path: str, key: str, text: str, end_id: int) -> DataFrame:
    """(key, ids, counted, times): the ids with the end id, packed in two bytes each if all fit,
    else four; the first row of a block of texts counts the ids of the block."""
    with open(path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast((path, file.read()))  # the vocabulary file

    def run(batches):
        encode = _tokenizer(shared)
        for block in text_blocks(batches, "text"):
            flat, sizes = encode(strings(block.column("text")))
            ends = np.cumsum(sizes)
            flat = np.insert(flat, ends, np.uint32(end_id))
            ends += np.arange(1, len(ends) + 1)
            counts = np.bincount(flat)
            ids = np.flatnonzero(counts)
            if len(counts) <= 1 << 16:
                raw, head, width = flat.astype("<u2").tobytes(), b"\2", 2
            else:
                raw, head, width = flat.astype("<u4").tobytes(), b"\4", 4
            cuts = (width * ends).tolist()
            packed = [head + raw[lo:hi] for lo, hi in zip([0, *cuts], cuts)]
            rest = [None] * (len(packed) - 1)
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), pa.array(packed, pa.binary()), pa.array([ids, *rest], pa.list_(pa.int64())),
                 pa.array([counts[ids], *rest], pa.list_(pa.int64()))], ["key", "ids", "counted", "times"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, ids binary, counted array<long>, times array<long>")


def unpack(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if ids[0] == 2 else "<u4", offset=1)


def code_lengths(counts: dict[int, int], most: int = MAX_BITS) -> dict[int, int]:
    """Bits of each id by package-merge: the cheapest code with no word over ``most`` bits."""
    if len(counts) <= 1:
        return dict.fromkeys(counts, 1)
    most = max(most, (len(counts) - 1).bit_length())
    ids = sorted(counts, key=lambda i: (counts[i], i))
    weight = np.array([counts[i] for i in ids], np.int64)
    level, is_leaf = weight, [np.ones(len(ids), bool)]
    for _ in range(most - 1):
        packages = level[:len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weight, packages])
        order = np.argsort(both, kind="stable")
        level = both[order]
        is_leaf.append(order < len(ids))
    bits, take = np.zeros(len(ids), np.int64), 2 * len(ids) - 2
    for leaf in reversed(is_leaf):
        leaves = int(leaf[:take].sum())
        bits[:leaves] += 1
        take = 2 * (take - leaves)
    return dict(zip(ids, bits.tolist()))


class Code:
    """Canonical code: words in order of (bits, id)."""

    def __init__(self, lengths: dict[int, int]):
        order = sorted(lengths, key=lambda i: (lengths[i], i))
        top = max(lengths, default=0) + 1
        self.bits = np.zeros(top, np.int64)
        self.word = np.zeros(top, np.uint64)
        self.width = max(lengths.values(), default=1)
        self.symbol = np.zeros(1 << self.width, np.uint32)
        self.step = np.ones(1 << self.width, np.int64)
        word, before = 0, 0
        for i in order:
            word <<= lengths[i] - before
            before = lengths[i]
            self.bits[i], self.word[i] = before, word
            lo = word << (self.width - before)
            self.symbol[lo:lo + (1 << (self.width - before))] = i
            self.step[lo:lo + (1 << (self.width - before))] = before
            word += 1

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(bit stream, the first bit of every ``STRIDE``-th id)."""
        bits, word = self.bits[ids], self.word[ids]
        ends = np.cumsum(bits)
        at = ends - bits
        total = int(ends[-1]) if len(ids) else 0
        out = np.zeros((total >> 6) + 2, np.uint64)
        if len(ids):
            cell, shift = at >> 6, 64 - (at & 63) - bits
            head = np.where(shift >= 0, word << np.maximum(shift, 0).astype(np.uint64),
                            word >> np.maximum(-shift, 0).astype(np.uint64))
            first = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1])
            out[cell[first]] = np.add.reduceat(head, first)
            over = np.flatnonzero(shift < 0)  # at most one word runs into a cell from the one before
            out[cell[over] + 1] |= word[over] << (64 + shift[over]).astype(np.uint64)
        return out.byteswap().tobytes()[:(total + 7) // 8], at[::STRIDE]

    def decode(self, stream: bytes, marks: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` ids; all strides advance together."""
        raw = np.frombuffer(stream + bytes(8), np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at, out = np.array(marks, np.int64), np.empty((len(marks), STRIDE), np.uint32)
        for k in range(min(STRIDE, n)):
            got = window[np.minimum(at >> 3, len(window) - 1)] << (at & 7).astype(np.uint32)
            got >>= np.uint32(32 - self.width)
            out[:, k] = self.symbol[got]
            at += self.step[got]
        return out.reshape(-1)[:n]


def write(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 1):
    """Writes the files of all documents below ``path``."""
    spark = docs.sparkSession
    tokens = materialize(tokenize(docs, tokenizer, key, text, end_id))

    counted = tokens.where("counted is not null").select(F.inline(F.arrays_zip("counted", "times")))
    counts = {r.counted: r.n for r in counted.groupBy("counted").agg(F.sum("times").alias("n")).collect()}  # <= ids
    lengths = code_lengths(counts)
    spark.createDataFrame(sorted(lengths.items()), "id long, bits int").coalesce(1).write.parquet(f"{path}/code")
    shared = spark.sparkContext.broadcast(lengths)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(counts.values()) // IDS_PER_PART + 1)

    def run(batches):
        code, part, before = Code(shared.value), TaskContext.get().partitionId(), 0
        keys, ids, held = [], [], 0

        def block(keys, ids, before):
            flat = np.concatenate(ids).astype(np.int64)
            stream, marks = code.encode(flat)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([len(flat)], pa.int64()),
                 pa.array([keys], pa.list_(pa.int64())), pa.array([[len(x) for x in ids]], pa.list_(pa.int32())),
                 pa.array([stream], pa.binary()), pa.array([marks], pa.list_(pa.int64()))],
                ["part", "before", "n", "keys", "lengths", "stream", "marks"])

        for batch in batches:
            for name, packed in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                keys.append(name)
                ids.append(unpack(packed))
                held += len(ids[-1])
                if held >= BLOCK_IDS:
                    yield block(keys, ids, before)
                    before, keys, ids, held = before + held, [], [], 0
        if ids:
            yield block(keys, ids, before)

    # ranges are cut by samples of what they are cut by: a hash stands in for the ids
    rows = tokens.select(F.col("key").cast("long").alias("key"), F.xxhash64("ids").alias("tie"), "ids")
    (rows.repartitionByRange(parts, "key", "tie").sortWithinPartitions("key", "tie").select("key", "ids").mapInArrow(
        run, "part int, before long, n long, keys array<long>, lengths array<int>, stream binary, marks array<long>")
     .write.parquet(f"{path}/blocks"))


def read(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document from the files."""
    return _documents(spark, path, f"`{key}` long, start long, n_tokens long, ids_crc32 long", lambda ids: (
        zlib.crc32(ids.astype("<u4").tobytes()),))


def read_ids(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids) of every document from the files."""
    return _documents(spark, path, f"`{key}` long, start long, n_tokens long, ids array<long>", lambda ids: (
        ids.tolist(),))


def _documents(spark, path, schema, last):
    lengths = {r.id: r.bits for r in spark.read.parquet(f"{path}/code").collect()}  # as many as there are ids
    shared = spark.sparkContext.broadcast(lengths)
    blocks = spark.read.parquet(f"{path}/blocks")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    bases = blocks.groupBy("part").agg(F.sum("n").alias("m")).select(
        "part", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("base"))
    names = [f.split()[0].strip("`") for f in schema.split(", ")]
    kind = pa.int64() if schema.endswith("ids_crc32 long") else pa.list_(pa.int64())

    def run(batches):
        code = Code(shared.value)
        for batch in batches:
            for r in batch.to_pylist():
                ids = code.decode(r["stream"], np.array(r["marks"], np.int64), r["n"])
                ends = np.cumsum(r["lengths"])
                starts = r["base"] + r["before"] + ends - r["lengths"]
                made = [last(x)[0] for x in np.split(ids, ends[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["keys"], pa.int64()), pa.array(starts, pa.int64()), pa.array(r["lengths"], pa.int64()),
                     pa.array(made, kind)], names)

    return blocks.join(F.broadcast(bases), "part").select(
        "base", "before", "n", "keys", "lengths", "stream", "marks").mapInArrow(run, schema)


def round_trip(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 1):
    """Writes the files to the shared folder and reads them back."""
    path = shared_dir(docs.sparkSession)
    write(docs, path, tokenizer, key, text, end_id)
    return read(docs.sparkSession, path, key)
