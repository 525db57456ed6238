import random

import numpy as np
import pytest
from helpers import clashing, groups, jaccard_links, shingles, words

from vellum.llm.graph import components
from vellum.llm.minhash import BUCKETS, chance, near_duplicates, registers, stage_near_duplicates

SCHEMA = "doc_id long, text string"


def copies(rng, n_groups=30, edits=(0, 1, 2, 4, 8, 12), length=(3, 90)):
    vocab = ["w%d" % k for k in range(4000)]
    rows = []
    for _ in range(n_groups):
        base = [rng.choice(vocab) for _ in range(rng.randint(*length))]
        for _ in range(rng.randint(1, 6)):
            w = list(base)
            for _ in range(rng.choice(edits)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append(" ".join(x.upper() if rng.random() < 0.1 else x for x in w))
    rng.shuffle(rows)
    return rows


def brute(rows, width):
    """rows of (id, text) -> multiset of (id, n_shingles, component, kept)."""
    sets = {i: shingles(words(t), width) for i, (_, t) in enumerate(rows)}
    at = groups(sets, jaccard_links({i: s for i, s in sets.items() if s}))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[at[i]] = min(least.get(at[i], d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(at[i]) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [4, 5])
def test_against_brute_force(spark, width):
    rng = random.Random(width)
    rows = list(enumerate(copies(rng)))
    rows += [(500, None), (501, ""), (502, " \n "), (503, "one"), (504, "ONE"), (505, "one two"), (506, "long " * 20_000),
             (507, "long " * 20_001), (None, rows[3][1]), (None, "nobody has this text but me"), rows[8], rows[8]]
    got = near_duplicates(clashing(spark.createDataFrame(rows, SCHEMA)), width=width)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, width)


def test_chains_through_a_shared_key(spark):
    """A group whose members resemble their neighbours only, and one that shares
    half of its text: all links are found, none is made up."""
    rng = random.Random(9)
    words_ = ["x%d" % k for k in range(400)]
    rows = [(i, " ".join(words_[6 * i:6 * i + 100])) for i in range(50)]
    common = " ".join("c%d" % k for k in range(60))
    rows += [(100 + i, common + " " + " ".join("u%d_%d" % (i, k) for k in range(50))) for i in range(60)]
    rows += [(200 + i, " ".join(rng.choice(["p", "q", "r"]) for _ in range(rng.randint(20, 60)))) for i in range(60)]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA), width=4)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 4)


def test_registers_estimate_similarity():
    rng = np.random.default_rng(3)
    for n, m in ((30, 25), (500, 400), (5000, 4200)):
        every = rng.integers(0, 2**64, 2 * n - m, dtype=np.uint64)
        a, b = np.unique(every[:n]), np.unique(every[n - m:])
        agree = (registers(a) == registers(b)).mean()
        truth = m / (2 * n - m)
        assert abs(agree - truth) < 5 * np.sqrt(truth * (1 - truth) / min(n, BUCKETS)) + 0.02
    assert 0 < float(chance(1000, 800)[0]) < 0.001


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randint(-90, 90), rng.randint(-90, 90)) for _ in range(60)] + [(k, k + 1) for k in range(1000, 1400)]
    nodes = {x for p in links for x in p}
    want = groups(nodes, links)
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long").repartition(9)).collect()))
    assert got == {x: want[x] for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stage_keeps_one_of_each_group(spark):
    rng = random.Random(12)
    rows = list(enumerate(copies(rng, 15)))
    rows += [(900, None), (901, ""), rows[2], rows[2], (2, "another text under a known id, quite unlike it")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], SCHEMA + ", source string")
    got = stage_near_duplicates(spark, docs, "").collect()
    assert docs.columns == list(got[0].__fields__)
    sets = {i: shingles(words(t), 5) for i, (_, t) in enumerate(rows)}
    at = groups(sets, jaccard_links({i: s for i, s in sets.items() if s}))
    want = {}
    for i, (d, t) in enumerate(rows):
        want.setdefault(at[i] if sets[i] else ("empty", d), set()).add(d)
    assert sorted(r.doc_id for r in got) == sorted(min(ids) for ids in want.values())


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
