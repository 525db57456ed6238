import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import clashing

from vellum.llm import repeats
from vellum.llm.repeats import remove_repeats, smallest_of_next

SCHEMA = "doc_id long, text string"


def brute(docs, length):
    raw = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(b[k:k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        m = np.zeros(len(b) + 1, dtype=np.int64)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                m[k] += 1
                m[k + length] -= 1
        gone = np.cumsum(m)[:len(b)] > 0
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def table(rng):
    letters = ["a", "b", "é", "\n"]
    base = "".join(rng.choice(letters) for _ in range(2000))
    docs = []
    for i in range(150):
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 150)))
        for _ in range(rng.randint(0, 3)):
            a = rng.randint(0, 1900)
            t += base[a:a + rng.randint(5, 120)] + "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        docs.append((i, rng.choice([t, t, t, t, "a" * rng.randint(0, 150), None]) if i % 9 == 0 else t))
    return docs + docs[:4] + [(None, docs[10][1]), (None, "\0" * 90), (700, "ab" * 300), (701, "")]


@pytest.mark.parametrize("group", [4096, 3])
def test_against_brute_force(spark, group):
    docs = table(random.Random(group))
    got = remove_repeats(clashing(spark.createDataFrame(docs, SCHEMA)), length=60, span=24, group=group)
    assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == brute(docs, 60)


def test_long_texts_are_cut_into_parts(spark, monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdef") for _ in range(9000))
    docs = [(1, text[:7000] + text[2000:2600]), (2, text[3000:3500]), (3, "z" * 6000)]
    monkeypatch.setattr(repeats, "CHUNK", 1000)
    got = remove_repeats(spark.createDataFrame(docs, SCHEMA))
    assert sorted((tuple(r)[:5] for r in got.collect()), key=repr) == brute(docs, 400)


def test_full_length(spark):
    rng = random.Random(3)
    body = "".join(rng.choice("abcdefgh ") for _ in range(1200))
    docs = [(1, "x" + body[:400] + "y"), (2, "z" + body[:400]), (3, body[500:899]), (4, body[500:899]), (5, body)]
    got = {r.doc_id: (r.n_removed, [tuple(s) for s in r.spans]) for r in remove_repeats(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert got == {1: (400, [(1, 401)]), 2: (400, [(1, 401)]), 3: (0, []), 4: (0, []), 5: (400, [(0, 400)])}
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sliding_minimum():
    x = np.random.default_rng(0).integers(0, 1000, 137)
    for span in (1, 5, 137):
        assert smallest_of_next(x, span).tolist() == [min(x[k:k + span]) for k in range(len(x) - span + 1)]


def shared_by_brute_force(docs, width):
    held = [(i, t, {tuple(w[k:k + width]) for k in range(len(w) - width + 1)})
            for i, t, w in ((i, t, [x for x in re.split("[\\x20\\x09-\\x0d]+", (t or "").lower()) if x]) for i, t in set(docs))]
    owners = Counter(x for _, _, s in held for x in s)
    return {(i, t) for i, t, s in held if any(owners[x] > 1 for x in s)}


def test_passages_shorter_than_the_length(spark, monkeypatch):
    """Passages of 50 words and under 400 bytes in texts that differ otherwise: the bytes stay, shared tells."""
    rng = random.Random(9)
    words = lambda n: [rng.choice("abcdefgh") + rng.choice("ijklm") + rng.choice("nopqrstu") + str(rng.randint(0, 99)) for _ in range(n)]
    docs = [(i, " ".join(words(rng.randint(0, 200)))) for i in range(40)]
    for k, n in enumerate(rng.randint(50, 60) for _ in range(20)):
        passage = words(n)
        docs += [(100 + 2 * k + c, rng.choice([" ", "\n"]).join(words(rng.randint(0, 90)) + passage + words(rng.randint(0, 90)))) for c in (0, 1)]
    once, long = " ".join(words(70)), " ".join(words(700))
    docs += [(200, once), (200, once), (201, None), (202, ""), (203, long + " " + long), (204, "x " + long[1500:1900]), (None, docs[0][1] + " y")]
    monkeypatch.setattr(repeats, "CHUNK", 300)
    monkeypatch.setattr(repeats, "PART", 64)
    got = remove_repeats(clashing(spark.createDataFrame(docs, SCHEMA)))
    rows = got.select("doc_id", "n_removed", "shared").collect()
    sure, perhaps = ({i for i, _ in shared_by_brute_force(docs, n)} for n in (repeats.PASSAGE, repeats.PHRASE))
    shared = {r.doc_id for r in rows if r.shared}
    assert sure <= shared <= perhaps and set(range(100, 140)) <= shared and 200 not in shared
    assert len(rows) == len(docs) and all(r.n_removed == 0 for r in rows if r.doc_id in range(100, 140))


def test_a_passage_of_very_many_documents(spark):
    line = " ".join(f"w{k}" for k in range(60))
    docs = [(i, line if i % 2 else f"{i} {line} {i}") for i in range(400)] + [(1000, " ".join(f"v{k}" for k in range(90)))]
    got = remove_repeats(spark.createDataFrame(docs, SCHEMA).repartition(3))
    assert {r.doc_id for r in got.where("not shared").collect()} == {1000}
