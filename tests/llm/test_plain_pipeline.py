"""Language prediction and the pipeline's run next to plain loops over the whole small table."""

import math
import re
import sys
from pathlib import Path

import numpy as np
import public_tokenizers as tokenizers
import pytest
import tiktoken

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from fraudlake.llm import bpe, language  # noqa: E402

RANKS = tokenizers.path("byte_bpe_multi_50k.tiktoken")


def plain_language(model, text):
    """(language, score): dense trigram counts, a vote for every pair, ties to the larger margins."""
    text = text or ""
    if not any(c.isalpha() for c in text):
        return "und", 0.0
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
    counts = [0] * language.BUCKETS
    shift = 32 - int(math.log2(language.BUCKETS))
    for i in range(len(data) - 2):
        code = data[i] << 16 | data[i + 1] << 8 | data[i + 2]
        counts[(code * 2654435761 & 0xFFFFFFFF) >> shift] += 1
    shares = np.array(counts) / max(1, len(data) - 2)
    margins = {pair: float(shares @ model.weights[:, k].astype(float) + model.bias[k])
               for k, pair in enumerate(model.pairs)}

    def winner(names):
        if len(names) == 1:
            return names[0], 1.0
        rank = {}
        for a in names:
            own = [margins[a, b] if (a, b) in margins else -margins[b, a] for b in names if b != a]
            sure = sum(1 / (1 + math.exp(-min(50, max(-50, 4 * m)))) for m in own) / len(own)
            rank[a] = (sum(m > 0 for m in own), sum(own), sure)
        best = max(names, key=lambda a: rank[a][:2])
        return best, rank[best][2]

    family, p = winner(sorted({language.family_of(x) for x in model.langs}))
    lang, q = winner([x for x in model.langs if language.family_of(x) == family])
    return lang, p * q


def distance_to_a_stretch(item, text):
    """Edit distance of the item to the nearest stretch of the text, a row of the table at a time."""
    codes, place = np.array([ord(c) for c in text], np.int64), np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, c in enumerate(item, 1):
        new = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + (codes != ord(c)))])
        row = np.minimum.accumulate(new - place) + place
    return int(row.min())


def plain_groups(texts):
    """Smallest id linked with each: five-word shingles, four fifths."""
    sets, root = {}, {i: i for i in texts}
    for i, t in texts.items():
        words = [w for w in re.split("[ \t\n\v\f\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) if w]
        sets[i] = {tuple(words[k:k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {i: new if r == old else r for i, r in root.items()}
    return root


def redacted(text):
    """Strong parts only: the small table holds no other."""
    spans = [m.span() for m in re.finditer(
        r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I)
        if len(m[1]) >= 6]
    spans += [m.span() for p, n in (("AKIA[A-Z0-9]+", 20), ("[0-9a-f]+", 24))
              for m in re.finditer(p, text) if len(m[0]) >= n]
    out, done = [], 0
    for lo, hi in sorted(spans):
        if lo > done or not done:
            out.append(text[done:lo] + "[SECRET]")
        done = max(done, hi)
    return "".join(out) + text[done:]


def test_language_equals_a_plain_vote(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.fit(docs.where(~language.held_out()).select("doc_id", "text", "lang"))
    assert len(model.langs) > 1 and len(model.pairs) > 0
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "ß"), (-4, "12 ?!"), (-5, "a"), (-6, "der die und " * 9000)],
                                "doc_id long, text string")
    for r in language.predict(docs.select("doc_id", "text").unionByName(odd), model).collect():
        lang, score = plain_language(model, r.text)
        assert (r.lang_pred, r.score) == (lang, pytest.approx(score, abs=1e-4)), r.doc_id


def test_run_equals_five_plain_loops(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = language.fit(docs.where(~language.held_out()).select("doc_id", "text", "lang"))
    left = {r.doc_id: r.asDict() for r in docs.collect()}
    steps = [len(left)]

    def keep(good):
        for i in [i for i in left if not good(i)]:
            del left[i]
        steps.append(len(left))

    found = {i: plain_language(model, r["text"]) for i, r in left.items()}
    keep(lambda i: found[i][0] != "und" and found[i][1] >= corpus_pipeline.LEAST_SCORE)
    groups = plain_groups({i: r["text"] for i, r in left.items()})
    keep(lambda i: groups[i] == i)
    items = {" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    assert all(len(x) >= 20 for x in items)  # shorter ones have a rule of their own
    plain = {i: " ".join(r["text"].lower().split()) for i, r in left.items()}
    keep(lambda i: all(distance_to_a_stretch(x, plain[i]) > int(len(x) * 0.05) for x in items))
    encoding = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS),
                                 special_tokens={})
    for r in left.values():
        r["text"] = redacted(r["text"])
        r["n_chars"] = len(r["text"])
        r["ids"] = encoding.encode_ordinary(r["text"])
    got = {r.doc_id: r.asDict() for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(got) == set(left) and steps[1] > steps[2] > steps[3]
    for i, r in left.items():
        assert {k: got[i][k] for k in r} == r
