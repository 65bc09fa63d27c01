"""Benchmark passages in documents, exact or with a few edits.

A test item of m characters (lower case, white space runs as one blank) may differ by
k = floor(m * ``rate``) edits. Cut into k + 1 pieces, at least one piece occurs unchanged
in any such copy. An automaton of all pieces finds their exact hits in one pass over a
document; around a hit, where the item would have to lie, Myers' bit-parallel algorithm
computes the smallest edit distance of the item to any stretch of the text.

Items are the stated query set. They go to the tasks in blocks of at most
``BLOCK_CHARS`` characters, one pass over the documents for each block, so what is sent
is bounded whatever the benchmark's size. Documents are not shuffled.

Rows: one for each pair (document row, item) within the budget. Null or empty items and
documents match nothing; items of equal text are all reported; items shorter than
``MIN_CHARS`` need an exact occurrence between word ends. Repeated document rows are
reported each. Only the key and the text are read.
"""

import uuid
from collections import defaultdict

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import strings, text_blocks

RATE = 0.05
MIN_CHARS = 20
BLOCK_CHARS = 4_000_000


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def myers(item: str, text: str, masks: dict | None = None) -> tuple[int, int]:
    """Smallest edit distance of the item to a stretch of the text, and where the first
    such stretch ends. Bit vectors of the item's length; a stretch may begin anywhere."""
    m = len(item)
    if masks is None:
        masks = letter_masks(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, now = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & top:
            now += 1
        elif down & top:
            now -= 1
        up = (up << 1) & full
        down = (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if now < best:
            best, end = now, j
    return best, end


def letter_masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    return dict(masks)


def pieces(item: str, rate: float) -> list[tuple[int, str]]:
    """(offset, piece): one more than the error budget, lengths nearly equal."""
    n = int(len(item) * rate) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(lo, item[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]


class Matcher:
    """Finds the items of one block in a text."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float):
        self.items = [(i, t, int(len(t) * rate) if len(t) >= MIN_CHARS else 0) for i, t in items if t]
        self.masks: dict[int, dict] = {}
        where = defaultdict(list)
        for number, (_, text, _) in enumerate(self.items):
            for offset, piece in pieces(text, rate) if len(text) >= MIN_CHARS else [(0, text)]:
                where[piece].append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in where.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if where:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int | None, int, int, int]]:
        """(item, distance, budget, end in the normalised text)."""
        if not self.items or not text:
            return []
        begins = defaultdict(set)
        for last, (length, uses) in self.automaton.iter(text):
            for number, offset in uses:
                begins[number].add(last + 1 - length - offset)
        found = []
        for number, starts in begins.items():
            name, item, budget = self.items[number]
            m, best = len(item), None
            if m < MIN_CHARS:
                ends = [s + m for s in sorted(starts) if (s == 0 or not text[s - 1].isalnum())
                        and (s + m == len(text) or not text[s + m].isalnum())]
                best = (0, ends[0]) if ends else None
            elif (at := text.find(item)) >= 0:
                best = (0, at + m)
            else:
                if number not in self.masks:
                    self.masks[number] = letter_masks(item)
                spans = []
                for s in sorted(starts):  # windows that meet are searched as one
                    lo, hi = max(0, s - budget), min(len(text), s + m + budget)
                    if spans and lo <= spans[-1][1]:
                        spans[-1][1] = max(hi, spans[-1][1])
                    elif hi > lo:
                        spans.append([lo, hi])
                for lo, hi in spans:
                    d, end = myers(item, text[lo:hi], self.masks[number])
                    if d <= budget and (best is None or d < best[0]):
                        best = (d, lo + end)
            if best:
                found.append((name, best[0], budget, best[1]))
        return found


def _matcher(shared, made={}):  # noqa: B006  one automaton for each Python worker and block
    name, *parts = shared.value
    if name not in made:
        made.clear()
        made[name] = Matcher(*parts)
    return made[name]


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
          item_text: str = "text", rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(key, item_id, distance, max_distance, end_char): all pairs within the budget;
    ``end_char`` counts in the normalised text."""
    spark = docs.sparkSession
    items = items.select(F.col(item_key).cast("long").alias("item_id"), F.col(item_text).alias("text")).where(
        "length(text) > 0")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = chars // block_chars + 1
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    out = None
    for b in range(n_blocks):
        mine = items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(n_blocks)) == b) if n_blocks > 1 else items
        block = sorted(((r.item_id, normal(r.text)) for r in mine.collect()), key=str)
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, block, rate))

        def run(batches, shared=shared):
            matcher = _matcher(shared)
            for batch in text_blocks(batches):
                found = [(key_of, *hit) for key_of, t in zip(batch.column("doc_id"), strings(batch.column("text")))
                         for hit in matcher.find(normal(t))]
                if found:
                    ids, item, d, most, end = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i.as_py() for i in ids], batch.column("doc_id").type), pa.array(item, pa.int64()),
                         pa.array(d, pa.int32()), pa.array(most, pa.int32()), pa.array(end, pa.int64())],
                        ["doc_id", "item_id", "distance", "max_distance", "end_char"])

        part = rows.mapInArrow(run, f"doc_id {kind}, item_id long, distance int, max_distance int, end_char long")
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("doc_id", key)


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents in which no item was found. The test is made next to the text, so
    no document is moved."""
    spark, text, rate = docs.sparkSession, options.get("text", "text"), options.get("rate", RATE)
    items = items.select(F.col("item_id").cast("long"), "text").where("length(text) > 0")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = chars // options.get("block_chars", BLOCK_CHARS) + 1
    for b in range(n_blocks):
        mine = items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(n_blocks)) == b) if n_blocks > 1 else items
        block = sorted(((r.item_id, normal(r.text)) for r in mine.collect()), key=str)
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, block, rate))

        def run(batches, shared=shared):
            matcher = _matcher(shared)
            for batch in text_blocks(batches, text):
                keep = [not matcher.find(normal(t)) for t in strings(batch.column(text))]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
