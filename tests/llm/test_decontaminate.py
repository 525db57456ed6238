import hashlib
import random

import numpy as np
import pytest
from helpers import ALNUM, clashing, words

from vellum.llm.decontaminate import FmIndex, WaveletMatrix, find_spans, report, stage_decontaminate, without

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
OUT = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def brute(docs, items, width=10):
    windows = {}
    for i, t in items:
        w = words(t, ALNUM)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + width]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, found = words(t, ALNUM), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[k:k + n])):
                    found |= owners
                    hit |= set(range(k, k + n))
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=repr)


def test_wavelet_rank():
    x = np.random.default_rng(1).integers(0, 11, 500)
    w = WaveletMatrix(x, 4)
    for c in range(11):
        for p in (0, 1, 77, 500):
            assert w.rank(np.array([c]), np.array([p]))[0] == (x[:p] == c).sum()


def test_fm_index_finds_and_locates():
    rng = random.Random(2)
    text = np.array([0] + [rng.choice([0, 1, 1, 2, 3]) for _ in range(300)] + [0])
    index = FmIndex(text, 3)
    for pattern in ([1], [1, 1], [2, 1, 3], [3, 3, 3, 3]):
        low, high = index.search(np.array([pattern]), np.array([len(pattern)]))
        got = sorted(index.locate(np.arange(low[0], high[0])))
        assert got == [k for k in range(len(text)) if list(text[k:k + len(pattern)]) == pattern]


@pytest.mark.parametrize("block_bytes", [1 << 20, 30])
def test_against_brute_force(spark, block_bytes):
    rng = random.Random(3)
    vocab = ["a", "b", "c", "É", "x1", "Zz", "-", "  ", "\n", "日本"]
    docs = [(i, None if i % 17 == 0 else " ".join(rng.choice(vocab[:rng.choice([2, 4, 10])]) for _ in range(rng.randint(0, 60))))
            for i in range(150)]
    docs += [(3, docs[3][1]), (None, docs[5][1]), (900, ""), (901, "a b " * 5000)]
    items = [(i, " ".join(rng.choice(vocab[:4]) for _ in range(rng.choice([0, 3, 7, 10, 12, 15])))) for i in range(12)]
    items += [(99, None), (4, items[4][1]), (None, "b a b b a")]
    got = report(find_spans(clashing(spark.createDataFrame(docs, DOCS)), clashing(spark.createDataFrame(items, ITEMS)),
                            block_bytes=block_bytes), ["doc_id"])
    assert sorted(map(tuple, got.select(OUT).collect()), key=repr) == brute(docs, items)


def test_empty_tables(spark):
    one, none = spark.createDataFrame([(1, "a b")], DOCS), spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([(1, "a b")], ITEMS)
    assert report(find_spans(none, items), ["doc_id"]).count() == 0
    row = report(find_spans(one, items.limit(0)), ["doc_id"]).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)


def test_stage_cuts_spans(spark, tmp_path):
    spark.createDataFrame([(1, "one two three")], ITEMS).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(1, "é! One, two three; four", "x"), (2, "one two three", "x"), (3, "clean text", "x"), (4, None, "x"), (5, "", "x")],
                                 DOCS + ", source string")
    got = {r.doc_id: r.text for r in stage_decontaminate(spark, docs, str(tmp_path)).collect()}
    assert got == {1: "é! ; four", 3: "clean text", 4: None, 5: ""}


def test_spans_are_cut_by_bytes():
    assert without("äbcdé", [(0, 2), (1, 3), (4, 5)]) == "cé"
