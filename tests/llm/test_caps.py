import numpy as np
from helpers import clashing, groups

from vellum.llm import caps
from vellum.llm.caps import COSINE, _codes, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        x = np.asarray(v, dtype=np.float32).astype(np.float64)
        return x / np.linalg.norm(x)

    units = [unit(v) for _, v, _ in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i)
             if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j])
             and rows[i][2] is not None and rows[i][2] == rows[j][2] and units[i] @ units[j] >= 0.93]
    at = groups(range(len(rows)), links)
    least = {}
    for i, r in enumerate(rows):
        least[at[i]] = min(least.get(at[i], r[0]), r[0])
    n = [sum(i in p for p in links) for i in range(len(rows))]
    return sorted((r[0], n[i], least[at[i]], r[0] == least[at[i]]) for i, r in enumerate(rows))


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows, vec_id = [], 0
    for label in (0, 1, None):
        for _ in range(40):
            centre = rng.standard_normal(24)
            for _ in range(rng.integers(1, 6)):
                v = centre + rng.standard_normal(24) * rng.choice([0.0, 0.1, 0.25, 0.3])
                rows.append((vec_id, [float(x) for x in v * rng.choice([0.01, 1, 1e15])], label))
                vec_id += 1
    bad = [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23]
    rows += [(vec_id + k, v, 1) for k, v in enumerate(bad)]
    rows += [(900, [1.0, 0.0], 1), (901, [1.0, 0.1], 1), (902, [1.0], 1), (903, [2.0], 1), (904, [1.0], 0)]
    rows += [rows[0], rows[0], (905, rows[0][1], 0)]
    got = near_vectors(clashing(spark.createDataFrame(rows, SCHEMA)))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_large_group_and_empty(spark):
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(16)
    rows = [(i, [float(x) for x in centre + 0.02 * rng.standard_normal(16)], 3) for i in range(1500)]
    got = near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(1499, 0)}
    assert near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_nothing_exploded_is_broadcast(spark, monkeypatch):
    plans, write = [], caps.materialise

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df)

    monkeypatch.setattr(caps, "materialise", noted)
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.standard_normal(16)], 3) for i in range(50)]
    near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    plan = next(p for p in plans if "explode(caps" in p)       # the units' members, of caps that are arrays
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_pairs_meet_under_labels_of_every_size():
    rng = np.random.default_rng(1)
    a, r = (rng.standard_normal((1500, 64)) for _ in range(2))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    r -= (r * a).sum(axis=1, keepdims=True) * a
    b = COSINE * a + np.sqrt(1 - COSINE**2) * r / np.linalg.norm(r, axis=1, keepdims=True)
    for n in (100_000, 3_000_000, 10_000_000):
        shared = np.zeros(len(a), dtype=int)
        for code in _codes(64, n, COSINE):
            one, two = (set(zip(*(x.tolist() for x in code.caps_of(v)))) for v in (a, b))
            np.add.at(shared, [row for row, _ in one & two], 1)
        assert shared.min() >= 5
