"""Language identification in two steps: the family first, then the language within it.

Features are byte trigrams of the lower-cased text (ASCII letters), hashed to
``BUCKETS`` relative frequencies. Between every two families, and between every two
languages of one family, a linear support vector machine (squared hinge, dual
coordinate descent) decides; the one with most votes wins, ties go to the larger sum
of margins. All machines are linear in the frequencies, so predicting a text is one
look-up per trigram and a mean: whole texts are read once, in blocks of bounded size,
without a shuffle.

Learning: every label, on ``PER_LANGUAGE`` rows of each in expectation, taken by a hash of
the key among the rows that the caller allows. That sample and its ``BUCKETS`` wide
counts are all that reaches the driver, at any input size; the machines grow with the
square of the labels of a family.

Rows: each input row gives one output row. Null text and text without a letter get
``und`` and score 0, the empty one included; repeated rows get equal answers; without
any learned language all get ``und``. Other columns are not looked at.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_blocks, text_buffer

BUCKETS = 1 << 13
PER_LANGUAGE = 300
UNKNOWN = "und"
# Language families of the labels; what isn't listed is a family "other".
FAMILIES = {
    "germanic": "en de nl af sv da no nb nn is fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tt",
    "semitic": "ar he mt am",
    "indic": "hi bn ur pa mr gu ne si",
}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def family_of(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang.split("-")[0] in langs.split()), "other")


def trigrams(data: np.ndarray) -> np.ndarray:
    """The bucket of the trigram that begins at each byte but the last two."""
    low = _LOWER[data].astype(np.uint32)
    code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def _sums(data, starts, weights):
    """For each text the sum of its trigrams' weight rows, and their number."""
    n = len(starts) - 1
    total, count = np.zeros((n, weights.shape[1])), np.maximum(np.diff(starts) - 2, 0)
    lengths = np.diff(starts)
    full = np.flatnonzero(lengths >= 3)
    step = 1 << 20
    for lo in range(0, max(0, len(data) - 2), step):  # a long text is summed piece by piece
        hi = min(lo + step, len(data) - 2)
        rows = weights[trigrams(data[lo:hi + 2])]
        here = full[(starts[full] < hi) & (starts[full + 1] - 2 > lo)]
        if not len(here):
            continue
        begin, end = np.maximum(starts[here], lo) - lo, np.minimum(starts[here + 1] - 2, hi) - lo
        cuts = np.empty(2 * len(here), np.int64)
        cuts[0::2], cuts[1::2] = begin, end
        padded = np.vstack([rows, np.zeros((1, rows.shape[1]), rows.dtype)])
        total[here] += np.add.reduceat(padded, cuts, axis=0, dtype=np.float64)[0::2]
    return total, count


def has_letter(data, starts, texts) -> np.ndarray:
    marks = np.concatenate([[0], np.cumsum(_LETTER[data])])
    found = marks[starts[1:]] > marks[starts[:-1]]
    for i in np.flatnonzero(~found):
        found[i] = any(c.isalpha() for c in texts[i].as_py() or "")
    return found


def _svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights and, last, the bias: L2-regularised squared hinge by dual coordinate
    descent in a fixed random order."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    diagonal = (x * x).sum(1) + 0.5 / cost
    order = np.random.default_rng(1)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(x)):
            g = y[i] * (x[i] @ w) - 1 + 0.5 / cost * alpha[i]
            new = max(0.0, alpha[i] - g / diagonal[i])
            if (d := new - alpha[i]) != 0.0:
                w += d * y[i] * x[i]
                alpha[i] = new
                moved = max(moved, abs(d) * diagonal[i] ** 0.5)
        if moved < 1e-3:
            break
    return w


class LanguageModel:
    """The machines: ``weights`` has a column for each pair, then biases; ``pairs``
    names what a positive and a negative margin vote for."""

    def __init__(self, langs, weights, bias, pairs):
        self.langs, self.weights, self.bias, self.pairs = langs, weights, bias, pairs
        self.family = {lang: family_of(lang) for lang in langs}

    def margins(self, data, starts):
        total, count = _sums(data, starts, self.weights)
        return total / np.maximum(count, 1)[:, None] + self.bias

    def _contest(self, margins, names):
        """Winner's index and its mean probability against the others."""
        votes, sums = (np.zeros((len(margins), len(names))) for _ in range(2))
        sure = np.zeros((len(margins), len(names)))
        place = {name: i for i, name in enumerate(names)}
        for k, (plus, minus) in enumerate(self.pairs):
            if plus in place and minus in place:
                m = margins[:, k]
                p = 1 / (1 + np.exp(-np.clip(4 * m, -50, 50)))
                for name, sign, share in ((plus, 1, p), (minus, -1, 1 - p)):
                    votes[:, place[name]] += sign * m > 0
                    sums[:, place[name]] += sign * m
                    sure[:, place[name]] += share / (len(names) - 1)
        best = np.lexsort((np.arange(len(names))[None, ::-1].repeat(len(margins), 0), sums, votes), axis=1)[:, -1]
        return best, np.ones(len(margins)) if len(names) == 1 else sure[np.arange(len(margins)), best]

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        data, starts = text_buffer(texts)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        margins = self.margins(data, starts)
        families = sorted(set(self.family.values()))
        which, sure = self._contest(margins, families)
        lang, score = np.empty(len(texts), object), np.zeros(len(texts))
        for i, name in enumerate(families):
            rows = np.flatnonzero(which == i)
            own = [x for x in self.langs if self.family[x] == name]
            best, p = self._contest(margins[rows], own)
            lang[rows], score[rows] = np.array(own, object)[best], sure[rows] * p
        none = ~has_letter(data, starts, texts)
        lang[none], score[none] = UNKNOWN, 0.0
        return lang.tolist(), score


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Learns from the rows given. ``key`` only picks the sample."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    known = known.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"),
                         F.col(lang).alias("lang"))
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()}
    if not sizes:
        return LanguageModel([], np.zeros((BUCKETS, 1), np.float32), np.zeros(1), [])
    draw = F.pmod(F.xxhash64("key", F.lit("language sample")), F.lit(1 << 30))
    share = F.create_map(*[F.lit(x) for k, n in sizes.items()
                           for x in (k, int((1 << 30) * min(1.0, per_language / n)))])
    sample = known.where(draw < share[F.col("lang")]).select("lang", "text")

    def count(batches):
        for block in text_blocks(batches):
            data, starts = text_buffer(block.column("text"))
            where, times = [], []
            for lo, hi in zip(starts, starts[1:]):
                there = np.bincount(trigrams(data[lo:hi]) if hi - lo > 2 else np.empty(0, int), minlength=BUCKETS)
                where.append(np.flatnonzero(there).astype(np.int32))
                times.append(there[where[-1]].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [block.column("lang"), pa.array(where, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))],
                ["lang", "bucket", "times"])

    rows = [r for r in sample.mapInArrow(count, "lang string, bucket array<int>, times array<int>").collect()
            if r.bucket]
    langs = sorted({r.lang for r in rows})
    x, y = np.zeros((len(rows), BUCKETS), np.float32), np.array([r.lang for r in rows], object)
    order = sorted(range(len(rows)), key=lambda i: (rows[i].lang, rows[i].bucket, rows[i].times))
    y = y[order]
    for i, j in enumerate(order):
        x[i, rows[j].bucket] = rows[j].times
    x /= np.maximum(x.sum(1, keepdims=True), 1)
    scale = (1 / np.sqrt(x.mean(0) + 1e-5)).astype(np.float32) if len(rows) else np.ones(BUCKETS, np.float32)
    x *= scale
    family = np.array([family_of(v) for v in y], object)
    pairs, columns = [], []
    contests = [(family, sorted(set(family)))]
    contests += [(y, [v for v in langs if family_of(v) == name]) for name in sorted(set(family))]
    for target, names in contests:
        for plus, minus in combinations(names, 2):
            rows_in = (target == plus) | (target == minus)
            columns.append(_svm(x[rows_in], np.where(target[rows_in] == plus, 1.0, -1.0)))
            pairs.append((plus, minus))
    table = np.array(columns).T if columns else np.zeros((BUCKETS + 1, 1))
    return LanguageModel(langs, (table[:-1] * scale[:, None]).astype(np.float32), table[-1], pairs)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", names=("lang_pred", "score")) -> DataFrame:
    """All columns and two more, by default ``lang_pred`` and ``score`` (columns of these
    names are replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x pairs numbers
    kept = docs.drop(*names)

    def run(batches):
        for block in text_blocks(batches, text):
            lang, score = shared.value.predict(block.column(text))
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(lang, pa.string()), pa.array(score)],
                                             [*block.schema.names, *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{fields}, `{names[0]}` string, `{names[1]}` double")


def held_out(key: str = "doc_id"):
    """Rows kept apart from learning: crc32 of the key as text leaves 1 when divided by 3.
    A null key is not held out (and not learned from)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, held_out, lang_pred, score) of every row, learned from the others' labels."""
    model = fit(docs.where(~held_out(key)).select(key, text, lang), key, text, lang)
    found = predict(docs.select(key, text, held_out(key).alias("held_out")), model, text)
    return found.select(key, "held_out", "lang_pred", "score")
