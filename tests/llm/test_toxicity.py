"""The toxicity classifier: its scores next to a window-by-window version, and held-out labels."""

import random
import zlib

import numpy as np
import pyarrow as pa
from fraudlake.llm import toxicity
from pyspark.sql import functions as F

ENGLISH = "the of and to in that is was he for it with as his on be at by had not are but".split()
GERMAN = "der die und das ist nicht ein mit auf dem für werden sich auch nach".split()


def corpus(n=500):
    rows, labels = [], []
    for i in range(n):
        r = random.Random(i)
        words = r.choices(ENGLISH if i % 2 else GERMAN, k=r.randint(5, 60))
        toxic = i % 5 == 1 or i % 7 == 2
        if toxic:  # a plain word in one language, a stem with any ending in the other
            words.insert(r.randrange(len(words)), "rotter" if i % 2 else "schuft" + r.choice(["ei", "ig", "en", "lich", "x"]))
        rows.append((i, " ".join(words), "en" if i % 2 else "de"))
        if i % 3:
            labels.append((i, int(toxic)))
    return rows, labels, {i: i % 5 == 1 or i % 7 == 2 for i in range(n)}


def plain_logit(net, text):
    vectors = [net.embed[list(toxicity.features(w))].sum(0) for w in toxicity._WORD.findall(text.lower())]
    vectors += [np.zeros(toxicity.DIM)] * toxicity.PAD
    best = []
    for w in toxicity.WIDTHS:
        windows = [sum(vectors[i + o] @ net.filters[w][o] for o in range(w)) + net.bias[w]
                   for i in range(len(vectors) - toxicity.PAD + 1)]
        best += np.maximum(np.max(windows, axis=0), 0).tolist()
    return float(np.array(best) @ net.out + net.shift)


def test_held_out_labels_and_odd_rows(spark):
    rows, labels, truth = corpus()
    odd = [(900, None, "en"), (901, "", None), (902, " \n?!", None), (903, "rotter " + "the of " * 60_000, "en"),
           (904, "the of " * 60_000, "en"), (None, "no key rotter", "en"), (1, rows[1][1], "en")]
    df = spark.createDataFrame([(*x, "mine", 7) for x in rows + odd],
                               "doc_id long, text string, lang string, toxic string, key int").repartition(3)
    marks = spark.createDataFrame([*labels, (900, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    got = toxicity.detect(df, marks).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.5)
    held = [i for i in truth if by_id[i].held_out]
    assert len(held) > 50 and np.mean([by_id[i].predicted == truth[i] for i in held]) > 0.95
    assert by_id[900].score == by_id[901].score == by_id[902].score < 0.5
    assert by_id[903].predicted == 1 and by_id[904].predicted == 0 and by_id[None].predicted == 1
    assert toxicity.detect(df.limit(0), marks).count() == 0
    assert {r.score for r in toxicity.detect(df, marks.where("toxic = 1")).collect()} == {1.0}
    assert {r.score for r in toxicity.detect(df, marks.limit(0)).collect()} == {0.0}
    other = toxicity.detect(df.withColumn("lang", F.lit(None).cast("string")), marks).collect()
    assert np.mean([r.predicted == truth[r.doc_id] for r in other if r.doc_id in held]) > 0.9


def test_scores_equal_every_window_of_every_text(monkeypatch):
    """Slices, blocks and kept words change nothing; training lowers the loss."""
    rows, _, truth = corpus(120)
    net, lexicon, texts = toxicity.Network(), toxicity.Lexicon(), [t for _, t, _ in rows] + ["", "rotter"]
    line, begins, sizes = lexicon.line(texts)
    of = np.concatenate([np.zeros((1, 4), np.int32), lexicon.new_features(1)])
    y = np.array([float(truth.get(i, 0)) for i in range(len(texts))])

    def loss():
        vectors = net.vectors(of)
        vectors[0] = 0
        z = net.logits(net.answers(vectors), line, begins, sizes)
        return float(np.mean(np.log1p(np.exp(-np.where(y == 1, z, -z)))))

    before = loss()
    net.train(line, begins, sizes, of, y, np.ones(len(y)), np.arange(len(y)), epochs=3)
    assert loss() < before
    want = [plain_logit(net, t) for t in texts]
    speaks = toxicity.language.LanguageModel([], np.zeros((toxicity.language.BUCKETS, 1), np.float32), np.zeros(1), [])
    for windows, known in ((1 << 18, 10 ** 6), (37, 20)):
        monkeypatch.setattr(toxicity, "WINDOWS", windows)
        monkeypatch.setattr(toxicity, "KNOWN_WORDS", known)
        model = toxicity.Model(net, speaks, {}, 0.0, 0.0)
        found = np.concatenate([model.scores(pa.array(texts[lo:lo + 17])) for lo in range(0, len(texts), 17)])
        assert np.allclose(found, 1 / (1 + np.exp(-np.array(want))), atol=1e-4)


def test_best_cut():
    x, y = np.array([3.0, 2, 2, 1, 0]), np.array([1.0, 1, 1, 0, 0])
    assert toxicity.best_cut(x, y, np.ones(5)) == 1.5
    assert toxicity.best_cut(x, np.ones(5), np.ones(5)) < 0


def test_cuts_by_language_over_all_rows(spark):
    r = np.random.default_rng(3)
    lang = r.choice(["en", "de", "fr"], 400, p=[0.6, 0.37, 0.03])
    x = np.round(r.normal(size=400), 1)
    y = (x + r.normal(size=400) > (lang == "de")).astype(int)
    told = spark.createDataFrame([(str(a), float(b), int(c)) for a, b, c in zip(lang, x, y)],
                                 "lang string, logit double, y int").repartition(3)
    cuts, common = toxicity.best_cuts(told)
    assert common == toxicity.best_cut(x, y, np.ones(400)) and sorted(cuts) == ["de", "en"]
    for name, cut in cuts.items():
        assert cut == toxicity.best_cut(x[lang == name], y[lang == name], np.ones((lang == name).sum()))


def test_every_labelled_row_is_learned_from(spark, monkeypatch):
    """Beyond 3,000 rows a label, in several shards: counts of all rows, and a model that tells them apart."""
    rows = [(i, ("kind words " if i % 2 else "rotten words ") + f"n{i % 50}", "en") for i in range(9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = df.select("doc_id", (F.col("doc_id") % 2 == 0).cast("int").alias("toxic"))
    seen = []
    counted, joined = toxicity.word_counts, toxicity.best_cuts
    monkeypatch.setattr(toxicity, "word_counts", lambda d: seen.append(d) or counted(d))
    monkeypatch.setattr(toxicity, "best_cuts", lambda d: seen.append(d.count()) or joined(d))
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 3000)
    model = toxicity.fit(df, marks)
    shards = [r.n // 8 for r in seen[0].where("name = 'y'").select(F.octet_length("data").alias("n")).collect()]
    assert len(shards) == 3 and sum(shards) + seen[1] == 9000
    scores = model.scores(pa.array([t for _, t, _ in rows[:100]]))
    assert ((scores >= 0.5) == (np.arange(100) % 2 == 0)).all()
    found = counted(toxicity.deal(df.join(marks, "doc_id").select(
        F.col("doc_id").alias("key"), "text", F.col("toxic").alias("y")), 3))
    place = found["bucket"].to_pylist().index(toxicity.features("rotten")[0])
    assert (found["n0"][place].as_py(), found["n1"][place].as_py()) == (0, 4500)


def test_words_are_those_of_the_expression():
    texts = ["", "Ab_1 c\x85d\xa0e\x1cf", "²³¼½ªµº_×÷ÀÖØß", "İß ẞ “x”", "Ÿ a\ud800b", *(f"A{chr(i)}b" for i in range(0x3100))]
    for text in texts:
        assert toxicity.words_of(text) == toxicity._WORD.findall(text.lower())
    for word in ("a", "rotten", "größe", "жизнь", "_9"):
        assert toxicity.features(word)[1:] == tuple(
            zlib.crc32(word[:n].encode(), n) % toxicity.BUCKETS for n in (3, 4, 5))


def test_known_answers_are_not_copied_by_every_block():
    speaks = toxicity.language.LanguageModel([], np.zeros((toxicity.language.BUCKETS, 1), np.float32), np.zeros(1), [])
    model, rooms = toxicity.Model(toxicity.Network(), speaks, {}, 0.0, 0.0), []
    for i in range(200):
        model.scores(pa.array([f"word{i} other{i}"]))
        if not rooms or model.answers[1] is not rooms[-1]:
            rooms.append(model.answers[1])
    assert len(rooms) < 12


def test_rows_add_up_in_order():
    r = np.random.default_rng(1)
    at, rows = r.integers(0, 7, 500), r.normal(size=(500, toxicity.DIM)).astype(np.float32)
    want, got = np.zeros((2, 7, toxicity.DIM), np.float32)
    np.add.at(want, at, rows)
    toxicity.add_rows(got, at, rows)
    assert (want == got).all()
