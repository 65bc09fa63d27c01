"""Licence notices in documents, found by a trained classifier of word windows.

A text's words, line ends passed over, are cut into overlapping windows of the lengths in
``WINDOWS``; the steps are so small that each template fits whole into some window. A window's
features are hashed word uni- and bigrams; a multinomial logistic regression tells licence
families from ``unknown``. It is trained on the notices in ``TEMPLATES``, with words left out
and words on both sides up to a window's length, and on windows of the documents' own lines
that resemble no notice as ``unknown``. On lines kept apart from training the threshold is set
so that at most one in a thousand of their windows would pass. A prediction counts only if a
template of that family confirms it: at least ``CONFIRM`` of the template's word pairs occur
in a stretch of the window little longer than the template. Of notices that overlap the one
that resembles its template most counts.

The sample holds about ``SAMPLE`` documents whatever the table's size; with the templates it
is all that reaches the driver. Classifying is one pass without a shuffle.

Rows: one for each family in each paragraph (line) where a notice of it begins, several for a
document with several; null, empty and wordless texts have none, repeated rows are reported
each, an empty table gives none. Only the key and the text are read.
"""

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import strings, text_blocks

BUCKETS = 1 << 13
SAMPLE = 2000
CONFIRM = 0.6
WINDOWS = ((6, 2), (12, 3), (18, 4), (24, 6))  # words and step
CHUNK = 1 << 17  # words summed at a time
UNKNOWN = "unknown"
# Customary wording of licence notices.
TEMPLATES = {
    "apache-2.0": ["Licensed under the Apache License, Version 2.0",
                   "you may not use this file except in compliance with the License"],
    "mit": ["Released under the MIT License", "Licensed under the MIT license",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "bsd": ["Licensed under the BSD 3-Clause License", "Released under the BSD license",
            "Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3",
            "under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "lgpl": ["licensed under the GNU Lesser General Public License",
             "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "agpl": ["licensed under the GNU Affero General Public License"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "cc-by": ["Licensed under CC BY 4.0", "licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0",
                 "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0",
                 "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "public-domain": ["This is free and unencumbered software released into the public domain",
                      "dedicated to the public domain under CC0 1.0"],
    "proprietary": ["All rights reserved", "Copyright. All rights reserved. Proprietary and confidential"],
}
_TOKEN = re.compile(r"\n|[^\W_]+")


class Words(dict):
    """Word hashes; a line's end is 0. Kept for the next texts, bounded."""

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        self[word] = h = 0 if word == "\n" else (xxhash.xxh64_intdigest(word) | 1)
        return h


def buckets(h: np.ndarray):
    """Buckets of the words and of the pairs of neighbours."""
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    one = (h * np.uint64(0x9E3779B97F4A7C15)) >> shift
    two = ((h[:-1] * np.uint64(31) + h[1:]) * np.uint64(0xBF58476D1CE4E5B9)) >> shift
    return one.astype(np.int64), two.astype(np.int64)


def hashed(texts: list[str], words: Words):
    """(word hashes, their line, where each text's words begin, lines before each text); lines
    are counted through all the texts."""
    text = "\n".join(t.lower() for t in texts)
    h = np.fromiter(map(words.__getitem__, _TOKEN.findall(text)), np.uint64)
    line, word = np.cumsum(h == 0), h != 0
    first = np.cumsum([0, *(t.count("\n") + 1 for t in texts)])
    line = line[word]
    return h[word], line, np.searchsorted(line, first), first


def windows(begin: np.ndarray):
    """(start, end) of every window of every text; a shorter text is one window."""
    starts, ends = [], []
    n = np.diff(begin)
    for k, (length, step) in enumerate(WINDOWS):
        # a text that fits into the window before needs no longer one
        some = np.flatnonzero(n > (WINDOWS[k - 1][0] if k else 0))
        last = np.maximum(n[some] - length, 0)
        times = -(-last // step) + 1
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        at = np.repeat(begin[some], times) + np.minimum(nth * step, np.repeat(last, times))
        starts.append(at)
        ends.append(np.minimum(at + length, np.repeat(begin[some + 1], times)))
    starts, ends = np.concatenate(starts), np.concatenate(ends)
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order]


def tokens(text: str) -> list[str]:
    return [x for x in _TOKEN.findall(text.lower()) if x != "\n"]


def pairs(text: str) -> set:
    w = tokens(text)
    return set(zip(w, w[1:])) or set(w)


def resemblance(paragraph: str, templates: list[str]) -> float:
    """The largest share of a template's word pairs that the paragraph has."""
    mine = pairs(paragraph)
    return max((len(mine & pairs(t)) / len(pairs(t)) for t in templates), default=0.0)


def located(words: list[str], templates: list[str]) -> tuple[float, int, int]:
    """(share, start, end) of the stretch of the words that has the most of a template's pairs."""
    best = (0.0, 0, 0)
    for template in templates:
        want, length = pairs(template), len(tokens(template))
        there = [i for i, p in enumerate(zip(words, words[1:])) if p in want]
        for at in there:
            held = [i for i in there if at <= i < at + length + length // 2 + 1]
            share = len({(words[i], words[i + 1]) for i in held}) / len(want)
            # the tightest of the best
            best = max(best, (share, at, held[-1] + 2), key=lambda b: (b[0], b[1] - b[2]))
    return best


class LicenseModel:
    def __init__(self, classes, weights, bias, threshold):
        self.classes, self.weights, self.bias, self.threshold = classes, weights, bias, threshold

    def likely(self, h, starts, ends):
        """(window, class, probability) of the windows that pass: softmax of the sum of their
        grams' weights by the root of their number."""
        one, two = buckets(h) if len(h) else (np.empty(0, np.int64), np.empty(0, np.int64))
        found = []
        for lo in range(0, len(h), CHUNK):  # bounded memory; windows are in the order of their starts
            hi = min(lo + CHUNK + WINDOWS[-1][0], len(h))
            a, b = np.searchsorted(starts, [lo, lo + CHUNK])
            s, e = starts[a:b] - lo, ends[a:b] - lo
            ones = np.zeros((hi - lo + 1, len(self.classes)))
            np.cumsum(self.weights[one[lo:hi]], axis=0, dtype=np.float64, out=ones[1:])
            twos = np.zeros((hi - lo, len(self.classes)))
            np.cumsum(self.weights[two[lo:hi - 1]], axis=0, dtype=np.float64, out=twos[1:])
            z = ones[e] - ones[s] + twos[e - 1] - twos[s]
            z /= np.sqrt(2 * (e - s) - 1)[:, None]
            z += self.bias
            best = z[:, :-1].argmax(1)
            some = np.flatnonzero(z[np.arange(len(z)), best] > z[:, -1])
            z = z[some] - z[some].max(1, keepdims=True)
            p = np.exp(z)[np.arange(len(some)), best[some]] / np.exp(z).sum(1)
            sure = p >= self.threshold
            found += zip((some[sure] + a).tolist(), best[some[sure]].tolist(), p[sure].tolist())
        return found


def _features(lines, words):
    x = np.zeros((len(lines), BUCKETS), np.float32)
    for i, line in enumerate(lines):
        h = np.fromiter(map(words.__getitem__, tokens(line)), np.uint64)
        bucket = np.concatenate(buckets(h)) if len(h) else np.empty(0, np.int64)
        np.add.at(x[i], bucket, 1)
        x[i] /= max(1.0, len(bucket) ** 0.5)
    return x


def _stretch(line: str, length: int, draw) -> str:
    """A window of a line."""
    w = tokens(line)
    at = int(draw.integers(max(0, len(w) - length) + 1))
    return " ".join(w[at:at + length])


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE, seed: int = 7) -> LicenseModel:
    rows = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    n = rows.count()
    share = int((1 << 30) * min(1.0, sample / max(n, 1)))
    picked = rows.where(F.pmod(F.xxhash64("text", F.lit("licence sample")), F.lit(1 << 30)) < share)
    # two lines of each sampled document, chosen by hash
    lines_of = F.array_sort(F.transform(F.filter(F.split("text", "\n"), lambda s: F.length(s) > 0),
                                        lambda s: F.struct(F.xxhash64(s).alias("h"), s.alias("line"))))
    found = sorted({r.line for r in picked.select(F.explode(F.slice(lines_of, 1, 2)).alias("l"))
                    .select("l.line").collect()})
    known = [t for ts in TEMPLATES.values() for t in ts]
    plain = [s for s in found if resemblance(s, known) < 0.3]
    draw = np.random.default_rng(seed)
    plain = [plain[i] for i in draw.permutation(len(plain))]
    # a window of each line, the lengths in turn
    plain = [_stretch(line, WINDOWS[i // 2 % len(WINDOWS)][0], draw) for i, line in enumerate(plain)]
    training, apart = plain[::2], plain[1::2]
    lines, target, classes = [], [], [*TEMPLATES, UNKNOWN]
    for k, templates in enumerate(TEMPLATES.values()):
        for i in range(120):
            w = tokens(templates[i % len(templates)])
            w = [x for x in w if len(w) < 5 or draw.random() > 0.1]
            room = [length - len(w) for length, _ in WINDOWS if length >= len(w)]
            room = room[int(draw.integers(len(room)))] if i % 3 and training else 0
            left = int(draw.integers(room + 1))
            near = [tokens(training[int(draw.integers(len(training)))]) for _ in range(2)] if room else [[], []]
            lines.append(" ".join([*near[0][:left], *w, *near[1][:room - left]]))
            target.append(k)
    lines, target = lines + training, target + [len(TEMPLATES)] * len(training)
    words = Words()
    x, y = _features(lines, words), np.eye(len(classes), dtype=np.float32)[target]
    weight = (1 / y.sum(0).clip(1))[target][:, None]  # classes count alike
    weight /= weight.sum()
    w, b = np.zeros((BUCKETS, len(classes)), np.float32), np.zeros(len(classes), np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(200):  # gradient steps with momentum, small L2 penalty
        z = x @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = weight * (p - y)
        vw, vb = 0.9 * vw - 2 * (x.T @ g + 1e-5 * w), 0.9 * vb - 2 * g.sum(0)
        w, b = w + vw, b + vb
    model = LicenseModel(classes, w.astype(np.float32), b, 0.5)
    if apart:
        z = _features(apart, words) @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        model.threshold = float(max(0.5, np.quantile((p / p.sum(1, keepdims=True))[:, :-1].max(1), 0.999)))
    return model


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", model: LicenseModel | None = None) -> DataFrame:
    """(key, paragraph, family, probability, resemblance): the notices; paragraphs are
    numbered from 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs, text))

    def run(batches):
        model, words = shared.value, Words()
        for block in text_blocks(batches, "text"):
            texts = strings(block.column("text"))
            h, line, begin, first = hashed(texts, words)
            starts, ends = windows(begin)
            by_row = {}
            for at, best, p in model.likely(h, starts, ends):
                row = int(np.searchsorted(begin, starts[at], side="right")) - 1
                by_row.setdefault(row, []).append((int(starts[at]), int(ends[at]), best, p))
            out = []
            for row, some in by_row.items():
                split, offset, notices = tokens(texts[row]), int(begin[row]), {}
                for start, end, best, p in some:
                    alike, lo, hi = located(split[start - offset:end - offset], TEMPLATES[model.classes[best]])
                    if alike >= CONFIRM:
                        spot = (start + lo, start + hi, best)
                        notices[spot] = max(notices.get(spot, (0.0, 0.0)), (alike, p))
                taken, told = [], {}
                for (lo, hi, best), (alike, p) in sorted(notices.items(), key=lambda n: (-n[1][0], -n[1][1], n[0])):
                    if all(hi <= a or lo >= b for a, b in taken):
                        taken.append((lo, hi))
                        told.setdefault((int(line[lo] - first[row]), best), (p, alike))
                out += [(block.column("key")[row].as_py(), number, model.classes[best], p, alike)
                        for (number, best), (p, alike) in sorted(told.items())]
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], block.column("key").type), pa.array(columns[1], pa.int32()),
                     pa.array(columns[2], pa.string()), pa.array(columns[3], pa.float64()),
                     pa.array(columns[4], pa.float64())],
                    ["key", "paragraph", "family", "probability", "resemblance"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, paragraph int, family string, probability double, resemblance double"
    ).withColumnRenamed("key", key)
