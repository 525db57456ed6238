"""Language ID and toxicity: held-out accuracy, defined cases, no leaks."""

import random
import zlib

import numpy as np
import pytest
from helpers import clashing

from vellum.llm import language_id as L
from vellum.llm import toxicity as X

PARTS = {"en": ["the", "ing", "tion", "th", "and", "er", "wh"], "fr": ["eau", "ou", "é", "que", "ment", "ai"],
         "de": ["sch", "ung", "ein", "ß", "keit", "zu"]}


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def texts(rng, n):
    rows = []
    for i in range(n):
        lang = rng.choice(list(PARTS))
        words = ["".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(4, 60))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_language_accuracy_and_defined_cases(spark):
    rows = texts(random.Random(1), 300)
    odd = [(1000, None, "en"), (1001, "", "en"), (1002, "123 !? 456", "fr"), (1003, "the and thing " * 4000, None), (None, "ein zu keit", "de")]
    docs = clashing(spark.createDataFrame(rows + odd + [rows[0]], "doc_id long, text string, lang string"))
    model = L.learn(docs.where(~L.held_out(L.F.col("doc_id"))))
    assert model[0] == ["de", "en", "fr"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(docs, model).collect()}
    tested = [(i, lang) for i, _, lang in rows if held(i)]
    assert np.mean([got[i][0] == lang for i, lang in tested]) > 0.95
    assert got[1000] == got[1001] == got[1002] == ("und", 0.0)
    assert got[1003][0] == "en" and got[None][0] == "de"
    assert all(0 <= s <= 1 for _, s in got.values())


def test_language_learns_nothing_from_held_out_rows(spark):
    rows = [(i, "the and thing", "en") for i in range(40)] + [(i, "eau que ment", "xx") for i in range(40, 90) if held(i)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert L.learn(docs.where(~L.held_out(L.F.col("doc_id"))))[0] == ["en"]
    none = docs.limit(0)
    model = L.learn(none)
    assert model[0] == [] and L.predict(none, model).count() == 0
    assert {r.lang_pred for r in L.predict(docs, model).collect()} == {"und"}


def test_profiles_do_not_depend_on_pieces(monkeypatch):
    text = "the thing über été, and " * 50
    whole = L.Profiles().of(text)
    monkeypatch.setattr(L, "PIECE", 37)
    assert np.array_equal(L.Profiles().of(text), whole)


def test_language_stage_keeps_clean_documents(spark):
    rows = texts(random.Random(2), 120) + [(500, None, "en"), (501, "42", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = L.stage_language(spark, docs, "")
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} == set(range(120))


def test_language_stage_rejects_foreign_texts(spark):
    rng = random.Random(4)
    rows = texts(rng, 600)
    junk = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(40))
    # held out, so that nothing is learned from them
    ids = [i for i in range(1000, 2000) if held(i)]
    odd = [(i, junk("abcdefghijklmnopqrstuvwxyz" if k % 2 else "абвгдежзиклмнопрст"), "en") for k, i in enumerate(ids[:40])]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    assert {r.doc_id for r in L.stage_language(spark, docs, "").collect()} == set(range(600))


BAD = ["scum", "loser", "worthless"]


@pytest.fixture(scope="module")
def toxic_table(spark):
    rng = random.Random(3)
    rows = []
    for i, text, lang in texts(rng, 1500):
        bad = rng.random() < 0.12
        w = text.split()
        for _ in range(rng.randint(1, 3) if bad else 0):
            w.insert(rng.randint(0, len(w)), rng.choice(BAD))
        rows.append((i, " ".join(w), int(bad)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(9000, None), (9001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows if i % 2] + [(9000, 1, None), (None, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_toxicity_held_out(spark, toxic_table):
    rows, docs, labels = toxic_table
    model = X.fit(clashing(docs), labels)
    got = {r.doc_id: (r.score, r.predicted) for r in X.score(docs, model, keep=["doc_id"]).collect()}
    tested = [(y, *got[i]) for i, _, y in rows if held(i)]
    assert np.mean([p == y for y, _, p in tested]) > 0.95
    assert min(s for y, s, _ in tested if y) > max(np.median([s for y, s, _ in tested if not y]), 0.1)
    assert got[9000] == got[9001] and got[9000][1] == 0
    assert all(0 <= s <= 1 and p == (s >= 0.7) for s, p in got.values())


def test_toxicity_does_not_see_held_out_labels(spark, toxic_table):
    rows, docs, labels = toxic_table
    other = labels.withColumn("toxic", X.F.when(X.held_out(X.F.col("doc_id")), 1 - X.F.col("toxic")).otherwise(X.F.col("toxic")))
    a, b = X.fit(docs, labels), X.fit(docs, other)
    assert np.array_equal(a.features, b.features) and np.allclose(a.weights, b.weights)


def test_toxicity_without_positives(spark, toxic_table):
    _, docs, labels = toxic_table
    model = X.fit(docs, labels.where("toxic = 0"))
    assert {r.predicted for r in X.score(docs, model, keep=["doc_id"]).collect()} == {0}
    assert X.score(docs.limit(0), model, keep=["doc_id"]).count() == 0


def test_nnpu_separates():
    rng = np.random.default_rng(4)
    toxic = np.arange(600) < 100
    true = toxic | (rng.random(600) < 0.2)
    has = rng.random((600, 5)) < np.where(true[:, None], [0.9, 0.5, 0.3, 0.3, 0.3], [0.02, 0.02, 0.3, 0.3, 0.3])
    row, col = np.nonzero(has)
    w, b = X.nnpu(col, row, toxic, 5, 0.2)
    s = has @ w + b
    assert s[true].mean() > 1 and s[~true].mean() < -1
