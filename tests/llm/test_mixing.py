import random

import pytest
from helpers import WORDS, clashing

from vellum.llm.mixing import mix, stage_mix

DOCS, LABELS = "doc_id long, text string, source string", "doc_id long, quality int, toxic int"


def want_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    free, left = set(order), float(sum(sizes.values()))
    out = {}
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        free -= set(over)
    return out


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(11)
    rows = []
    for i in range(400):
        source = rng.choice(["hot"] * 8 + ["b", "é", "Z", None, "tiny"] if i != 5 else ["tiny"])
        text = "\n".join(" ".join("w%d" % rng.randint(0, 99) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 3)))
        rows.append((i, None if i % 50 == 3 else text, source))
    rows += [rows[7], rows[7], (None, "no id here", "b"), (999, "  a long one " * 300, "Z"), (1000, "", "void")]
    return rows


def test_targets_and_shares(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 400, 3)] + [(0, 1, 0), (None, 1, 1), (5, None, 0)], LABELS)
    table = clashing(spark.createDataFrame(docs, DOCS))
    got = mix(table, labels).collect()
    assert len(got) == len(docs)
    assert sorted(map(repr, got)) == sorted(map(repr, mix(table.repartition(7), labels).collect()))
    sizes, taken = {}, {}
    for i, t, s in docs:
        sizes[s] = sizes.get(s, 0) + len(WORDS.findall(t or ""))
    targets = want_targets(sizes)
    for r in got:
        assert (r.source_size, r.target) == (sizes[r.source], pytest.approx(targets[r.source]))
        assert r.epochs * r.size <= r.taken <= 3 * r.size
        assert r.epochs == (int(r.target // r.source_size) if r.source_size else 0)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 0.5 + 1e-6


def test_better_documents_come_first(spark):
    rows = [(i, "a b c d", "s" if i < 2000 else "a") for i in range(2600)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(2600)], LABELS)
    part = [r for r in mix(spark.createDataFrame(rows, DOCS), labels).collect() if r.source == "s" and r.part]
    good = sum(r.doc_id % 2 for r in part)
    assert good > 1.2 * (len(part) - good)


def test_stage_gives_the_copies(spark, docs, tmp_path):
    spark.createDataFrame([(1, 1, 0)], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    out = stage_mix(spark, spark.createDataFrame(docs, DOCS), str(tmp_path)).collect()
    assert all(len(WORDS.findall(r.text)) == r.taken for r in out)
    total = sum(len(WORDS.findall(t or "")) for _, t, _ in docs)
    assert abs(sum(r.taken for r in out) - total) <= 6
    whole = {(i, t) for i, t, _ in docs}
    assert all((r.doc_id, r.text) in whole or r.taken < r.size for r in out)


def test_empty(spark, tmp_path):
    none = spark.createDataFrame([], LABELS)
    assert mix(spark.createDataFrame([], DOCS), none).count() == 0
    only = mix(spark.createDataFrame([(1, None, None)], DOCS), none).first()
    assert (only.size, only.target, only.taken) == (0, 0.0, 0)
