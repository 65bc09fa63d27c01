"""Alignment of two tokenizations of the same text, and how well corpus-wide counts explain it.

**Tokens.** Vocabulary A (byte-level BPE) encodes blank + text, vocabulary B (pieces with byte
fallback) the text, to which it adds the blank. Token bytes, joined, must be blank + text on
both sides; a text for which they are not has no tokens.

**Alignment**, in Arrow, a block of texts at a time: the id lists are flattened, their parent
indices name the document, segmented running sums of token lengths give where each token ends,
and an Acero hash join of both sides' (document, end) keys finds the ends that both share. They
cut the tokens into groups; every A token of a group is linked with every B token of it.

**Counts.** ``Table.group_by`` counts each document's links by id pair, then in how many of the
block's documents a pair is linked; Spark merges these partial counts. A block's distinct
pairs get the merged counts by a shuffle join (a pair has one row a block, so no pair is a hot
key) and meet the block's documents again in a cogroup. Only the highest count of each A id is
broadcast: at most a row for each id of the vocabulary.

Rows: each input row gives one output row and counts as a document of its own, repeated rows and
rows without a key included. Texts that are null or empty, or fail the byte test, have zeros
and the empty string. An empty table gives an empty one. Other columns are not looked at. A task
holds one block of texts (``BLOCK`` bytes) or one longer text.
"""

import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import strings, text_blocks

BLOCK = 2 << 20
LARGE_GROUP = 4096  # links from which a group's repeated ids are counted before they are paired
STATS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 bytes
    stand for themselves, the others for the letters from U+0100 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class SideA:
    """Byte-level BPE from a tokenizer's JSON. Splitting and merging go through the rank
    encoder, which gives the same ids several times faster; a text that it can't take (its pattern
    engine gives up on very long runs of blanks) goes through the JSON's own library."""

    def __init__(self, spec: str, pattern: str):
        import os

        import tiktoken

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        data, letter = json.loads(spec), byte_letters()
        special = {t["content"] for t in data["added_tokens"] or ()}
        vocabulary = {bytes(letter[c] for c in token): i for token, i in data["model"]["vocab"].items()
                      if token not in special}
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = token
        self.spec, self.slow = spec, None
        self.fast = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens={})

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [self.one(" " + t) for t in texts]

    def one(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        except BaseException as e:  # a panic of the library is no Exception
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_str(self.spec)
                self.slow.encode_special_tokens = True
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


class SideB:
    """Pieces with byte fallback from a model file's content."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.model.get_piece_size()
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in ((i, self.model.id_to_piece(i)) for i in range(n))]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.uint32) for x in self.model.encode(texts, num_threads=1)]


class Side:
    """The tokens of one side: ids, document of each, end of each in its document."""

    def __init__(self, ids: list[np.ndarray], token_bytes: pa.Array, lengths: pa.Array):
        offsets = np.cumsum([0, *map(len, ids)])
        lists = pa.LargeListArray.from_arrays(offsets, np.concatenate([*ids, np.empty(0, np.uint32)]))
        self.ids = pc.list_flatten(lists)
        self.doc = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
        # segmented running sum: the sum over the block less the sum before the document
        ends = pc.cumulative_sum(pc.take(lengths, self.ids)).to_numpy(zero_copy_only=False)
        total = np.concatenate([[0], ends])[offsets]
        self.start, self.size = total[:-1], np.diff(total)
        self.end = ends - self.start[self.doc] if len(ends) else ends
        self.joined = pc.take(token_bytes, self.ids)

    def spells(self, i: int, raw: bytes) -> bool:
        lo, size = self.start[i], self.size[i]
        return size == len(raw) and bytes(memoryview(self.joined.buffers()[2])[lo:lo + size]) == raw

    def keep(self, documents: np.ndarray):
        mine = documents[self.doc]
        self.id, self.doc = self.ids.to_numpy()[mine].astype(np.int64), self.doc[mine]
        self.key = self.doc << 32 | self.end[mine]


class Aligner:
    """Lives in a Python worker."""

    def __init__(self, spec: str, pattern: str, model: bytes):
        self.a, self.b = SideA(spec, pattern), SideB(model)
        self.tokens = [pa.array(s.bytes, pa.large_binary()) for s in (self.a, self.b)]
        self.lengths = [pc.binary_length(t) for t in self.tokens]
        self.width = max(map(len, self.tokens))
        # each id followed by a comma, by a bar, by a semicolon, by nothing
        self.spelled = pa.array([f"{i}{end}" for end in (",", "|", ";", "") for i in range(self.width)], pa.large_string())

    def __call__(self, texts: list[str]) -> dict:
        n, sides = len(texts), []
        for encode, tokens, lengths in zip((self.a, self.b), self.tokens, self.lengths):
            sides.append(Side(encode(texts), tokens, lengths))
        valid = np.zeros(n, bool)
        for i, text in enumerate(texts):
            if text:
                raw = b" " + text.encode()
                valid[i] = all(s.spells(i, raw) for s in sides)
        for s in sides:
            s.keep(valid)
        a, b = sides
        cuts = pa.table({"key": a.key}).join(pa.table({"key": b.key}), "key", join_type="inner", use_threads=False)
        cuts = np.sort(cuts["key"].to_numpy())
        group_a, group_b = np.searchsorted(cuts, a.key), np.searchsorted(cuts, b.key)
        in_a, in_b = (np.bincount(g, minlength=len(cuts)) for g in (group_a, group_b))
        of_group = cuts >> 32

        def by_doc(doc, weight=None):
            return np.bincount(doc, weight, n).astype(np.int64)

        out = {"n_a": by_doc(a.doc), "n_b": by_doc(b.doc), "n_groups": by_doc(of_group),
               "n_links": by_doc(of_group, in_a * in_b)}
        out["groups_sha256"] = self.digests(a, b, group_a, group_b, in_a, in_b, of_group, out["n_a"] + out["n_b"])
        return out | self.links(n, a, b, group_a, in_a, in_b, of_group)

    def digests(self, a, b, group_a, group_b, in_a, in_b, of_group, tokens):
        till_a, till_b = np.cumsum(in_a), np.cumsum(in_b)
        place_a = np.arange(len(group_a)) + (till_b - in_b)[group_a]
        place_b = np.arange(len(group_b)) + till_a[group_b]
        last_group = np.append(of_group[1:] != of_group[:-1], True) if len(of_group) else np.empty(0, bool)
        end_a = (np.arange(len(group_a)) == till_a[group_a] - 1).astype(np.int64)
        closes = np.arange(len(group_b)) == till_b[group_b] - 1
        end_b = np.where(closes, np.where(last_group[group_b], 3, 2), 0)
        what = np.empty(len(place_a) + len(place_b), np.int64)
        what[place_a], what[place_b] = a.id + self.width * end_a, b.id + self.width * end_b
        joined = pc.take(self.spelled, pa.array(what))
        where = np.frombuffer(joined.buffers()[1], np.int64, len(what) + 1) if len(what) else np.zeros(1, np.int64)
        data = memoryview(joined.buffers()[2] or b"")
        cuts = where[np.concatenate([[0], np.cumsum(tokens)])].tolist()
        return [hashlib.sha256(data[lo:hi]).hexdigest() if hi > lo else "" for lo, hi in zip(cuts, cuts[1:])]

    def links(self, n, a, b, group_a, in_a, in_b, of_group):
        """Each document's distinct pairs as places in the block's list of pairs, how often each is
        linked there, and in how many documents of the block."""
        large = np.flatnonzero(in_a * in_b > LARGE_GROUP)
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        times = np.where(np.isin(group_a, large), 0, in_b[group_a]) if len(large) else in_b[group_a]
        each_a = np.repeat(np.arange(len(group_a)), times)
        nth = np.arange(len(each_a)) - np.repeat(np.cumsum(times) - times, times)
        each_b = first_b[group_a[each_a]] + nth
        parts = [pa.table({"doc": a.doc[each_a], "pair": a.id[each_a] << 32 | b.id[each_b],
                           "n": np.ones(len(each_a), np.int64)})]
        for g in large.tolist():
            ids, many = np.unique(a.id[first_a[g]:first_a[g] + in_a[g]], return_counts=True)
            others, more = np.unique(b.id[first_b[g]:first_b[g] + in_b[g]], return_counts=True)
            pair = (ids[:, None] << 32 | others[None, :]).ravel()
            parts.append(pa.table({"doc": np.full(len(pair), of_group[g]), "pair": pair,
                                   "n": (many[:, None] * more[None, :]).ravel()}))
        linked = pa.concat_tables(parts).group_by(["doc", "pair"], use_threads=False).aggregate([("n", "sum")])
        per_pair = linked.group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
        pairs = per_pair["pair"].to_numpy()
        doc = linked["doc"].to_numpy()
        order = np.argsort(doc, kind="stable")
        where = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n))])
        place = np.searchsorted(pairs, linked["pair"].to_numpy()[order])
        return {"place": pa.ListArray.from_arrays(pa.array(where, pa.int32()), pa.array(place, pa.int32())),
                "times": pa.ListArray.from_arrays(pa.array(where, pa.int32()), pa.array(
                    linked["n_sum"].to_numpy()[order], pa.int64())),
                "pairs": pairs, "held": per_pair["count_all"].to_numpy()}


def _aligner(shared, made={}):  # noqa: B006  one for each Python worker and pair of vocabularies
    names, *content = shared.value
    if names not in made:
        made.clear()
        made[names] = Aligner(*content)
    return made[names]


def linked(docs: DataFrame, spec: str, model: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, block, the document's numbers, place, times, pairs, held); ``pairs`` (A id in the
    upper half) and ``held`` (in how many documents) stand in a block's first row."""
    with open(spec, encoding="utf-8") as one, open(model, "rb") as other:
        shared = docs.sparkSession.sparkContext.broadcast(((spec, model, pattern), one.read(), pattern, other.read()))
    numbers = [f.split()[0] for f in STATS.split(", ")]

    def run(batches):
        align, part = _aligner(shared), TaskContext.get().partitionId()
        for i, block in enumerate(text_blocks(batches, "text", BLOCK)):
            made = align(strings(block.column("text")))
            rest = [None] * (block.num_rows - 1)
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), pa.array([part << 32 | i] * block.num_rows, pa.int64()),
                 *[pa.array(made[c]) for c in numbers], made["place"], made["times"],
                 pa.array([made["pairs"], *rest], pa.list_(pa.int64())),
                 pa.array([made["held"], *rest], pa.list_(pa.int64()))],
                ["key", "block", *numbers, "place", "times", "pairs", "held"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, block long, {STATS}, place array<int>, times array<long>, pairs array<long>, held array<long>")


def pair_counts(entries: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents a pair is linked, and whether no pair of its A id
    is linked in more."""
    counts = materialize(entries.groupBy("pair").agg(F.sum("held").alias("n")))
    a = F.shiftright("pair", 32)
    top = counts.groupBy(a.alias("a")).agg(F.max("n").alias("top"))  # at most as many rows as the vocabulary has ids
    return counts.join(F.broadcast(top), a == F.col("a")).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def align(docs: DataFrame, spec: str, model: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)."""
    rows = materialize(linked(docs, spec, model, pattern, key, text))
    entries = rows.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "held"))).select(
        "block", F.col("pos").alias("place"), F.col("col.pairs").alias("pair"), F.col("col.held").alias("held"))
    known = entries.join(pair_counts(entries), "pair").select(
        F.col("block").alias("of_block"), "place", "n", "best")
    numbers = [f.split()[0] for f in STATS.split(", ")]
    kind = docs.schema[key].dataType.simpleString()

    def explain(documents: pa.Table, counts: pa.Table) -> pa.Table:
        n = np.zeros(counts.num_rows + 1, np.int64)
        best = np.zeros(counts.num_rows + 1, np.int64)
        place = counts["place"].to_numpy()
        n[place], best[place] = counts["n"].to_numpy(), counts["best"].to_numpy()
        lists = documents["place"].combine_chunks()
        doc = pc.list_parent_indices(lists).to_numpy()
        at, times = pc.list_flatten(lists).to_numpy(), pc.list_flatten(documents["times"].combine_chunks()).to_numpy()
        sums = []
        for weight in (best, n):  # whole numbers, added as such
            total = np.zeros(documents.num_rows, np.int64)
            np.add.at(total, doc, times * weight[at])
            sums.append(total)
        return pa.table([documents["key"], *[documents[c] for c in numbers[:-1]], *sums, documents[numbers[-1]]],
                        names=["key", *numbers[:-1], "n_best", "count_sum", numbers[-1]])

    schema = f"key {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    out = rows.drop("pairs", "held").groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(explain, schema)
    return out.withColumnRenamed("key", key)
