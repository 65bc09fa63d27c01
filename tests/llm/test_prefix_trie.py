"""The conversation trie next to a plain version."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from fraudlake.llm import prefix_trie
from fraudlake.llm.queries import CHECKS, QUERIES


def plain(rows):
    """Nodes by their sequence of (role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    # equal places in a fixed order of their own
    made = {c: [t for _, t in sorted(ts, key=lambda x: (x[0], prefix_trie_id(*x[1])))] for c, ts in own.items()}
    whole = {}
    for c, ts in made.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole[c] = tuple(made.get(base, [])[:h] + ts[h:])
    members = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, cs in members.items():
        here = ",".join(map(str, sorted(c for c in cs if whole[c] == p)))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children[p]), leaves[p], saved[p],
                    hashlib.sha256(here.encode()).hexdigest()))
    return sorted(out, key=str)


def prefix_trie_id(role, text):
    return hashlib.md5(f"{len(role)} {role}{text}".encode()).digest()[:12] + len(text).to_bytes(4, "big")


@pytest.mark.parametrize("columns", [8, 2])
def test_trie(spark, columns, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    r, rows = random.Random(13), []
    for c in [*range(0, 60), *range(95, 130), 250, 300, 301, 399, -3, -100, -170]:
        for t in range(r.choice([1, 2, 3, 5, 9])):
            rows.append((c, r.choice([t, t, t, None]), r.choice(["user", "user", None]), r.choice(["é😀", "b", "", None])))
    rows += [(c, t, "user", "same") for c in range(700, 760) for t in range(3)] + rows[:5]
    rows += [(800, t, "user", f"long {t % 3}") for t in range(45)] + [(801, t, "user", f"long {t % 3}") for t in range(44)]
    rows += [(None, 0, "user", "nobody's")]
    df = spark.createDataFrame([(*x, "mine", "mine") for x in rows],
                               "conv_id long, turn long, role string, text string, node string, block string").repartition(3)
    got = prefix_trie.trie(df, columns)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                           "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)
    if columns == 8:
        assert prefix_trie.trie(df.limit(0)).count() == 0


def test_query_equals_plain(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, QUERIES["op13_trie"](spark, sf).collect()), key=str) == plain(rows)
