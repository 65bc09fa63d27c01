"""Exact Jaccard join of word n-gram sets by partitioning the universe of n-grams.

**Sets.** A text is lower-cased (A-Z) and split at ASCII white space; its set holds the
64-bit hashes of its distinct n-word shingles (of the whole sequence if that is shorter;
nothing if there is no word).

**Index.** Sets of a size band meet in a scheme of their own: two linked sets differ in
at most H shingles, H given by the band. The scheme deals all shingles into segments by
hash, ``one_off`` of them compared with one deletion allowed, the others exactly, so that
exact + 2 * one_off > H: two linked sets then agree in some segment exactly, or up to
one shingle in a one-off segment. How many are one-off follows from a cost model: index
rows a set needs, plus rows of other sets expected to meet it by chance. ``SPARE`` exact
segments are added, and a pair then agrees in as many more. A set's empty segments are indexed
only if they are so many that a pair could agree in nothing else.

**Candidates.** Equal sets are one class, known by 128 bits and the size; only a class' smallest
document is indexed. Two linked sets agree in at least ``least`` segments, not just in one, so a
set may leave out its ``least`` - 1 (less its empty segments) most frequent signatures of a
scheme: the rarest one that both have is always left. That is what keeps a common passage, or
chance, from tying unrelated texts together. One exchange by signature counts them and drops
those that one class alone has, which are nearly all; what is left is ranked by class and
scheme; the classes that still share a signature hang below the smallest of them, and connected
components of these edges are the candidate groups: linked sets share a signature, so they
share a group. Nothing emits all pairs of a signature.

**Verification.** The texts of a group meet in one task, or, if the group is larger than
``GROUP_CHARS``, in one task for each two of its blocks. There an inverted index over each
set's rarest shingles proposes partners, sets already connected are skipped, and the
rest is compared exactly (100 * intersection >= percent * union). The links found span
the true components.

Rows: one for each input row. Null, empty and wordless texts have 0 shingles and are
their own component; rows of equal text share one. The key names a document: rows that
share it are one node of the graph, and rows without it have the component of their set,
or null if no row with a key has that set.
"""

import math
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, materialize
from .common import components, sorted_groups, text_blocks

GROUP_CHARS = 4_000_000
BAND = 1.25
SPARE, SPARE_SHARE = 12, 8  # spare segments: so many, or one for so many where those are more
MEETING = 20_000  # sets that a segment could meet by chance, in index rows; the same at every size
CHANCE = 0.1  # assumed share of a segment's 3-word shingles that an unrelated set holds too; longer ones are rarer
SCHEME_BITS = 6
_SCHEME = np.uint64((1 << SCHEME_BITS) - 1)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class Scheme(NamedTuple):
    number: int
    low: int
    high: int
    one_off: int
    exact: int
    least: int  # segments in which two linked sets agree


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    x = (x ^ (x >> np.uint64(29))) * _B
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sets of texts; word hashes are kept for the next texts (bounded)."""

    def __init__(self, words: int):
        self.words, self.known = words, self._new()

    @staticmethod
    def _new():
        class Known(dict):
            def __missing__(self, word):
                self[word] = h = xxhash.xxh64_intdigest(word)
                return h
        return Known()

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > 500_000:
            self.known.clear()
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        n = min(self.words, len(h))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            out = mix(out * _B + h[i:len(h) - n + 1 + i])
        return np.unique(out)


def schemes(percent: int, longest: int = 1 << 31, words: int = 3) -> list[Scheme]:
    """A scheme for each size band that can hold links between different sets."""
    out, number, low = [], 0, 1
    held = CHANCE ** (words / 3)
    while low <= longest:
        nxt = max(low + 1, math.ceil(low * BAND))
        high = (nxt - 1) * 100 // percent
        differ = (nxt - 1 + high) * (100 - percent) // (100 + percent)
        if differ:
            best = None
            most = (differ + 1) // 2
            for one_off in sorted({most * i // 32 for i in range(33)}):
                exact = max(0, differ + 1 - 2 * one_off)
                n = low / (exact + one_off)
                rows = exact + one_off * (n + 1)
                chance = exact * held ** n + one_off * (n + 1) * held ** max(0.0, n - 1)
                best = min(best or (math.inf,), (rows + MEETING * chance, one_off, exact))
            # exact segments alone need no spare ones if there are none
            one_off, exact = best[1], best[2] + (max(SPARE, best[2] // SPARE_SHARE) if best[2] else 0)
            # a difference spoils an exact segment; it takes two to spoil a one-off one
            spoilt = differ if differ <= exact else exact + (differ - exact) // 2
            out.append(Scheme(number, low, high, one_off, exact, one_off + exact - spoilt))
        number, low = number + 1, nxt
    return out


def _sums(values: np.ndarray, segment: np.ndarray, n: int) -> np.ndarray:
    """64-bit wrapping sums by segment; halves keep the floats exact below 2 ** 21 values."""
    low = np.bincount(segment, (values & np.uint64(0xFFFFFFFF)).astype(np.float64), n).astype(np.uint64)
    high = np.bincount(segment, (values >> np.uint64(32)).astype(np.float64), n).astype(np.uint64)
    return low + (high << np.uint64(32))


def signatures(members: np.ndarray, plans: list[Scheme]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of a set's segments under every scheme of its size, with the scheme's number in the
    lowest ``SCHEME_BITS`` bits; for each of them how many of its scheme may be left out)."""
    out, spared, size = [], [], len(members)
    for plan in plans:
        if not plan.low <= size <= plan.high:
            continue
        n = plan.one_off + plan.exact
        tag = mix(np.arange(n, dtype=np.uint64) + np.uint64(plan.number << 32) + _A)
        segment = ((members >> np.uint64(20)) % np.uint64(n)).astype(np.int64)
        values = mix(members + tag[segment])
        held = np.bincount(segment, minlength=n)
        sums = _sums(values, segment, n)
        whole = mix(sums + tag)
        # one-off segments are indexed even when empty: their neighbours have one shingle
        empty = (held == 0) & (np.arange(n) >= plan.one_off)
        # the partner may have left out its empty segments, so a set that can't leaves out nothing
        spare = plan.least - 1 - int(empty.sum())
        if spare >= 0:
            whole = whole[~empty]
        found = [whole]
        if plan.one_off:
            mine = segment < plan.one_off
            found.append(mix(sums[segment[mine]] - values[mine] + tag[segment[mine]]))
        found = np.unique(np.concatenate(found) & ~_SCHEME | np.uint64(plan.number) & _SCHEME)
        out.append(found)
        spared.append(np.full(len(found), max(spare, 0), np.int32))
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int32)
    return np.concatenate(out), np.concatenate(spared)


class Forest:
    def __init__(self, n):
        self.root, self.members = np.arange(n), {i: [i] for i in range(n)}

    def join(self, a, b):
        a, b = self.root[a], self.root[b]
        if a == b:
            return False
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        self.root[self.members[b]] = a
        self.members[a] += self.members.pop(b)
        return True


def spanning_links(sets: list[np.ndarray], percent: int
                   ) -> list[tuple[int, int]]:
    """Links (places in ``sets``) that connect exactly the sets connected by all links."""
    if len(sets) < 2:
        return []
    flat = np.concatenate(sets)
    _, code, times = np.unique(flat, return_inverse=True, return_counts=True)
    rarity = np.empty(len(times), np.int64)
    rarity[np.argsort(times, kind="stable")] = np.arange(len(times))
    code = rarity[code]
    ends = np.cumsum([len(s) for s in sets])
    coded = [np.sort(c) for c in np.split(code, ends[:-1])]  # the rarest first
    forest = Forest(len(sets))
    postings: dict[int, list[int]] = defaultdict(list)
    seen, mark = np.zeros(len(sets), bool), np.zeros(len(times), bool)
    sizes, links = np.array([len(s) for s in sets]), []
    for x in np.argsort(sizes, kind="stable").tolist():
        mine, size = coded[x], len(coded[x])
        if not size:
            continue
        prefix = mine[:size - -(-percent * size // 100) + 1].tolist()
        seen[:] = False
        for c in prefix:
            if c in postings:
                seen[postings[c]] = True
        near = np.flatnonzero(seen)
        near = near[(forest.root[near] != forest.root[x]) & (100 * sizes[near] >= percent * size)]
        if len(near):
            mark[mine] = True
            for lo in range(0, len(near), 256):
                some = near[lo:lo + 256]
                some = some[forest.root[some] != forest.root[x]]
                if not len(some):
                    continue
                starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
                common = np.add.reduceat(mark[np.concatenate([coded[y] for y in some])], starts, dtype=np.int64)
                for y in some[100 * common >= percent * (sizes[some] + size - common)].tolist():
                    if forest.join(x, y):
                        links.append((x, y))
            mark[mine] = False
        for c in prefix:
            postings[c].append(x)
    return links


def _sets(docs, words):
    """(doc, n, hi, lo) of each row."""
    def run(batches):
        shingler = Shingler(words)
        for block in text_blocks(batches):
            n, high, low = [], [], []
            for text in block.column("text").to_pylist():
                members = shingler(text)
                n.append(len(members))
                high.append(int(np.bitwise_xor.reduce(mix(members + _A))) if len(members) else 0)
                low.append(int(mix(members + _B).sum(dtype=np.uint64)) if len(members) else 0)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc"), pa.array(n, pa.int64()), pa.array(np.array(high, np.uint64).view(np.int64)),
                 pa.array(np.array(low, np.uint64).view(np.int64))], ["doc", "n", "hi", "lo"])

    return docs.mapInArrow(run, "doc long, n long, hi long, lo long")


def _index(rows, words, plans):
    """(signature, class, spared): one row for each signature of each class."""
    def run(batches):
        shingler = Shingler(words)
        for block in text_blocks(batches):
            found = [signatures(shingler(text), plans) for text in block.column("text").to_pylist()]
            owner = np.repeat(block.column("doc").to_numpy(), [len(x) for x, _ in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([x for x, _ in found]).view(np.int64)), pa.array(owner),
                 pa.array(np.concatenate([x for _, x in found]))], ["signature", "class", "spared"])

    return rows.mapInArrow(run, "signature long, class long, spared int")


def _hung(index):
    """(a, b): class a shares a signature, one that neither leaves out, with the smaller class b."""
    times = F.count("*").over(Window.partitionBy("signature"))
    shared = index.withColumn("times", times).where("times > 1")
    scheme = F.col("signature").bitwiseAND((1 << SCHEME_BITS) - 1)
    rank = F.row_number().over(Window.partitionBy("class", scheme).orderBy(F.desc("times"), "signature"))
    left = materialize(shared.withColumn("rank", rank).where("rank > spared").select("signature", "class"))
    heads = left.groupBy("signature").agg(F.min("class").alias("head"))
    return left.join(heads, "signature").where("class != head").select(
        F.col("class").alias("a"), F.col("head").alias("b")).distinct()


def _verify(group_rows, words, percent):
    """Links between the classes of each group or pair of blocks."""
    def run(batches):
        shingler = Shingler(words)
        for _, rows in sorted_groups(batches, "grp", "x", "y"):
            texts = {}
            for r in rows:
                texts.setdefault(r["class"], set()).add(r["text"])
            ids, sets = [], []
            for one, several in texts.items():
                for text in several:
                    ids.append(one)
                    sets.append(shingler(text))
            found = {(min(ids[a], ids[b]), max(ids[a], ids[b])) for a, b in spanning_links(sets, percent)}
            found = [(a, b) for a, b in found if a != b]
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return group_rows.mapInArrow(run, "a long, b long")


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, percent: int = 90,
         group_chars: int = GROUP_CHARS) -> DataFrame:
    """(key, n_shingles, component_id)."""
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    plans = schemes(percent, words=words)
    sets = materialize(_sets(rows, words))

    # equal sets are one class, which goes by its smallest key
    classes = sets.where("n > 0 and doc is not null").groupBy("hi", "lo", "n").agg(F.min("doc").alias("class"))
    chosen = rows.join(classes.select(F.col("class").alias("doc")).distinct().hint("merge"), "doc", "left_semi")
    groups = components(_hung(_index(chosen, words, plans))).select(
        F.col("node").alias("class"), F.col("component").alias("grp"))

    chars = rows.where("doc is not null").select(F.col("doc").alias("class"), "text",
                                                 F.length("text").cast("long").alias("chars"))
    written = materialize(chars.join(groups.hint("merge"), "class"))
    blocks = written.groupBy("grp").agg((F.sum("chars") / group_chars).cast("int").alias("cuts"))
    members = written.join(blocks, "grp").withColumn(
        "block", F.pmod(F.xxhash64("class"), F.col("cuts") + 1).cast("int"))
    # a block meets itself and every other one: pairs (x, y) with x <= y
    each = F.transform(F.sequence(F.lit(0), F.col("cuts")), lambda o: F.struct(
        F.least("block", o).alias("x"), F.greatest("block", o).alias("y")))
    tasks = (members.withColumn("p", F.explode(each))
             .select("grp", F.col("p.x").alias("x"), F.col("p.y").alias("y"), "class", "text")
             .repartition("grp", "x", "y").sortWithinPartitions("grp", "x", "y", "class"))
    linked = components(_verify(tasks, words, percent))
    discard(written)
    found = classes.select("hi", "lo", "n", "class").join(
        linked.select(F.col("node").alias("class"), "component"), "class", "left").select(
        "hi", "lo", "n", F.coalesce("component", "class").alias("component"))
    out = sets.select("doc", "n", "hi", "lo").join(found, ["hi", "lo", "n"], "left")
    return out.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"),
                      F.coalesce("component", "doc").alias("component_id"))
