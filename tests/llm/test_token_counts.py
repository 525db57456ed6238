import random

import pyarrow as pa
import pytest
from helpers import clashing

from vellum.llm.token_counts import SegmentCounter, load, model_path, proven_whole, token_counts


@pytest.fixture(scope="module")
def counter():
    with open(model_path(), "rb") as f:
        proto = f.read()
    return SegmentCounter(proto, proven_whole(proto))


PARTS = [" ", "  ", "\n", "\t", "a", "the", "ing", "é", "▁", "<s>", "</s>", "<0x0A>", "　", "\xa0", "日本", "😀", "0", "\0", "\r",
         "<unk>", "Ⅳ", "ﬁ", " tion", "é"]


def test_whole_tokens_are_proven(counter):
    for text in random.Random(1).sample(sorted(counter.whole), 500):
        assert len(counter.sp.encode("\n" + text)) == 3


def test_equals_the_library(counter):
    rng = random.Random(7)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    texts += [None, "", " ", "foo bar\nbaz " * 100_000, "x" * 50_000, " lead", "trail ", "two  spaces"]
    want = [len(counter.sp.encode(t or "")) for t in texts]
    assert counter.count_all(pa.array(texts)).tolist() == want
    assert [counter.count(t or "") for t in texts] == want


def test_rows(spark):
    rows = [(1, "Hello there, world"), (1, "Hello there, world"), (None, None), (2, ""), (3, "tok " * 5000)]
    got = token_counts(clashing(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    with open(model_path(), "rb") as f:
        sp = load(f.read())
    want = sorted([(i, len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for i, t in rows], key=repr)
    assert sorted(map(tuple, got), key=repr) == want
    assert token_counts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
