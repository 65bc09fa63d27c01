"""The alignment of two tokenizations next to a plain version."""

import hashlib
import random
from collections import Counter

import public_tokenizers as tokenizers
import pytest
import sentencepiece
from fraudlake.llm import alignment
from pyspark.sql import functions as F
from tokenizers import Tokenizer

A, B = tokenizers.path("byte_bpe_50k.json"), tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(rows, libraries):
    """{row: the contract's numbers}, one token at a time."""
    a, b = libraries
    letter, bytes_of = alignment.byte_letters(), {}
    for token, i in a.get_vocab().items():
        bytes_of[i] = bytes(letter.get(c, 0) for c in token)
    groups = []
    for text in rows:
        text = text or ""
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw_a = [bytes_of[i] for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else
                 b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            groups.append([])
            continue
        found, x, y, at_a, at_b, now = [], 0, 0, 0, 0, ([], [])
        while x < len(ids_a) or y < len(ids_b):
            if y == len(ids_b) or (x < len(ids_a) and at_a <= at_b):
                now[0].append(ids_a[x])
                at_a += len(raw_a[x])
                x += 1
            else:
                now[1].append(ids_b[y])
                at_b += len(raw_b[y])
                y += 1
            if at_a == at_b:
                found.append(now)
                now = ([], [])
        groups.append(found)
    links = [Counter((p, q) for one, other in g for p in one for q in other) for g in groups]
    held = Counter(pair for one in links for pair in one)
    top = {}
    for (p, _), n in held.items():
        top[p] = max(n, top.get(p, 0))
    out = []
    for g, one in zip(groups, links):
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(one.values()),
                    sum(n for (p, q), n in one.items() if held[p, q] == top[p]),
                    sum(n * held[pair] for pair, n in one.items()),
                    hashlib.sha256(spelled.encode()).hexdigest() if g else ""))
    return out


def test_alignment(spark, libraries, monkeypatch):
    r = random.Random(12)
    letters = "aabcdeee    \n\t\x0b's't!?09²ßé€日Ωб😀́ ▁"
    texts = ["".join(r.choices(letters, k=r.randint(0, 70))) for _ in range(150)]
    texts += [None, "", " ", "  two  blanks ", "<|endoftext|> and <s> </s> <unk> <0x0A>", "same words here", "same words here",
              "q" * 5000, "the cat " * 4000, " " * 300, "▁", "\n" * 40, "ab" * 3000]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[0], "y"), (None, "no key", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, pairs string").repartition(3)
    monkeypatch.setattr(alignment, "LARGE_GROUP", 50)
    got = alignment.align(df, A, B, tokenizers.PATTERN)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = sorted(((-1 if k is None else k), *x) for (k, _, _), x in zip(rows, plain([t for _, t, _ in rows], libraries)))
    assert sorted((-1 if x[0] is None else x[0], *x[1:]) for x in got.collect()) == want
    assert alignment.align(df.limit(0), A, B, tokenizers.PATTERN).count() == 0
    nothing = alignment.align(df.withColumn("text", F.lit(None).cast("string")), A, B, tokenizers.PATTERN)
    assert {tuple(x)[1:] for x in nothing.collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_rank_encoder_gives_the_librarys_ids(libraries):
    """Every kind of character (a sample of each block of 256), between letters, digits and blanks;
    runs that its pattern engine may give up on."""
    a = alignment.SideA(open(A, encoding="utf-8").read(), tokenizers.PATTERN)
    r = random.Random(3)
    for block in range(0, 0x110000, 256):
        if 0xD800 <= block < 0xE000:
            continue
        chars = r.sample([chr(c) for c in range(block, block + 256)], 12)
        text = "".join(f"a{c}1 {c}{c}b\n{c}  " for c in chars)
        assert a.one(text).tolist() == libraries[0].encode(text, add_special_tokens=False).ids, hex(block)
    for text in (" " * 1_200_000 + "x", "a" * 30_000, "\n" * 50_000):
        assert a.one(text).tolist() == libraries[0].encode(text, add_special_tokens=False).ids
