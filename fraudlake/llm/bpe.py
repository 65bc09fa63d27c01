"""Byte-level BPE encoding and decoding by merge replay.

A task takes its documents in blocks of bounded size. The words (pattern matches) of
a block that were not met before form one corpus: their bytes lie one after the other
in a linked list, an inverted index tells at which positions a pair that makes a given
token begins, and merges are replayed in rank order over all words at once. A merge
touches its two neighbours only. The words' ids are kept for the task's later blocks
(at most ``KNOWN_WORDS`` entries, then it starts anew), so nothing is shuffled and
memory doesn't grow with the input.

Rows: every input row gives one output row. Null text counts as the empty one and has
no ids; repeated rows are encoded alike; an empty table gives an empty one. Only the
named columns are read, others are kept or ignored as the caller chooses.
"""

import base64
import hashlib
import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import strings, text_blocks

KNOWN_WORDS = 600_000
BLOCK = 16 << 20
# Unicode's letters, numbers and white space below U+0100.
LATIN_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
LATIN_NUMBERS = "0-9²³¹¼-¾"
LATIN_SPACE = r"\t-\r \x85\xa0"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (base64 token, blank, rank in each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def latin_pattern(pattern: str) -> str:
    """The same pattern for Python's faster module, right for texts below U+0100."""
    inside = {r"\p{L}": LATIN_LETTERS, r"\p{N}": LATIN_NUMBERS, r"\s": LATIN_SPACE}
    out, depth, i = "", 0, 0
    while i < len(pattern):
        key = next((k for k in (*inside, r"\S") if pattern.startswith(k, i)), None)
        if key == r"\S":
            out += f"[^{LATIN_SPACE}]"
        elif key:
            out += inside[key] if depth else f"[{inside[key]}]"
        else:
            depth += (pattern[i] == "[") - (pattern[i] == "]")
            out += pattern[i]
        i += len(key or " ")
    return out


class Codec:
    """Encodes lists of texts and decodes ids; lives in a Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.any_text = regex.compile(pattern)
        self.latin = re.compile(latin_pattern(pattern))
        # every pair of tokens that makes a token, sorted for look-up in arrays
        pairs = [(ranks[t[:i]] << 32 | ranks[t[i:]], rank) for t, rank in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        pairs.sort()
        self.pair = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.made = np.array([m for _, m in pairs] or [-1], np.int32)
        self.forget()

    def forget(self):
        self.number: dict[str, int] = defaultdict(self._next)
        self.ids: list[bytes] = []

    def _next(self):
        return len(self.number)

    def words(self, text: str) -> list[str]:
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return self.any_text.findall(text)
        return self.latin.findall(text)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that each pair makes, or -1."""
        want = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.pair, want), len(self.pair) - 1)
        return np.where(self.pair[at] == want, self.made[at], -1)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, where each word's ids begin)."""
        lengths = np.array([len(w) for w in words])
        ends = np.cumsum(lengths)
        token = self.single[np.frombuffer(b"".join(words), np.uint8)]
        n = len(token)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[ends - 1] = before[ends - lengths] = -1
        made = np.full(n, -1, np.int32)  # what the pair that begins here would make
        inner = np.flatnonzero(after >= 0).astype(np.int32)
        made[inner] = self.merged(token[inner], token[inner + 1])
        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def note(places, what):
            order = np.argsort(what, kind="stable")
            places, what = places[order], what[order]
            cuts = [0, *(np.flatnonzero(what[1:] != what[:-1]) + 1).tolist(), len(what)]
            for lo, hi in zip(cuts, cuts[1:]):
                token_made = int(what[lo])
                if token_made not in index:
                    index[token_made] = []
                    heapq.heappush(queue, token_made)
                index[token_made].append(places[lo:hi])

        inner = inner[made[inner] >= 0]
        if len(inner):
            note(inner, made[inner])
        odd = []
        while queue:
            now = heapq.heappop(queue)
            parts = index.pop(now)
            p = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
            p = p[made[p] == now]  # an earlier merge may have taken part of it
            if not len(p):
                continue
            q = after[p]
            if len(p) > 1 and (clash := q[:-1] == p[1:]).any():
                # overlapping pairs: from the left, every other one of a run
                run = np.arange(len(p)) - np.maximum.accumulate(
                    np.where(np.concatenate([[False], clash]), 0, np.arange(len(p))))
                p, q = p[run % 2 == 0], q[run % 2 == 0]
            r = after[q]
            token[p], token[q], made[q], made[p], after[p] = now, -1, -1, -1, r
            right = r >= 0
            before[r[right]] = p[right]
            o = before[p]
            x, y = p[right], o[o >= 0]
            places = np.concatenate([x, y])
            if not len(places):
                continue
            new = self.merged(token[places], token[after[places]])
            made[places] = new
            found = new >= 0
            if found.any():
                places, new = places[found], new[found]
                if (new < now).any():  # it would come before the rest of this rank: see below
                    odd.append(places[new < now])
                note(places, new)
        flat = token[token >= 0]
        starts = np.concatenate([[0], np.cumsum(np.add.reduceat(token >= 0, ends - lengths))])
        if odd:  # words in which a merge opened one of lower rank are done one at a time
            which = np.unique(np.searchsorted(ends, np.concatenate(odd), side="right"))
            lists = np.split(flat, starts[1:-1])
            for w in which.tolist():
                lists[w] = np.array(self.one_by_one(words[w]), np.int32)
            flat = np.concatenate(lists)
            starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        return flat, starts

    def one_by_one(self, word: bytes) -> list[int]:
        """The lowest rank first, the leftmost of equals, until no pair makes a token."""
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            i = ranks.index(min(ranks))
            if ranks[i] == 1 << 60:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[x] for x in parts]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.number) > KNOWN_WORDS:
            self.forget()
        number, seen = self.number, len(self.ids)
        split = [np.fromiter(map(number.__getitem__, self.words(t)), np.int32) for t in texts]
        new = [w.encode() for w in islice(number, seen, None)]
        self.ids += [None] * len(new)
        todo = []
        for i, raw in enumerate(new, seen):
            if (whole := self.ranks.get(raw)) is not None:
                self.ids[i] = whole.to_bytes(4, "little")
            else:
                todo.append((i, raw))
        if todo:
            flat, starts = self.replay([raw for _, raw in todo])
            flat, starts = flat.astype("<u4").tobytes(), (4 * starts).tolist()
            for (i, _), lo, hi in zip(todo, starts, starts[1:]):
                self.ids[i] = flat[lo:hi]
        for numbers in split:
            yield b"".join(map(self.ids.__getitem__, numbers.tolist()))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _codec(shared, pattern, made={}):  # noqa: B006  one codec for each Python worker and vocabulary
    name, ranks = shared.value
    if (name, pattern) not in made:
        made.clear()
        made[name, pattern] = Codec(ranks, pattern)
    return made[name, pattern]


def _share(frame: DataFrame, path: str):
    """The vocabulary for the tasks: as large as its file, whatever the input."""
    return frame.sparkSession.sparkContext.broadcast((path, read_ranks(path)))


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns of ``docs`` and ``ids``, an array of token ids (a column of that
    name is replaced)."""
    shared = _share(docs, ranks)
    kept = docs.drop(ids)

    def run(batches):
        codec = _codec(shared, pattern)
        for block in text_blocks(batches, text, BLOCK):
            found = list(codec.encode(strings(block.column(text))))
            where = np.cumsum([0, *(len(x) // 4 for x in found)])
            flat = np.frombuffer(b"".join(found), "<u4").astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(where, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*block.columns, column], [*block.schema.names, ids])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{fields}, `{ids}` array<int>")


def decode(rows: DataFrame, ranks: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns and the decoded bytes; null ids give no bytes."""
    shared = _share(rows, ranks)
    kept = rows.drop(text)

    def run(batches):
        codec = _codec(shared, "")
        for batch in batches:
            made = [codec.decode(np.array(x or [], "<u4").tobytes()) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())],
                                             [*batch.schema.names, text])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{fields}, `{text}` binary")


def round_trip(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encodes and decodes in one pass
    over the documents, without moving the ids out of the task."""
    shared = _share(docs, ranks)

    def run(batches):
        codec = _codec(shared, pattern)
        for block in text_blocks(batches, text, BLOCK):
            n, of_ids, of_text = [], [], []
            for ids in codec.encode(strings(block.column(text))):
                n.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [block.column(key), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
