import random

import pyarrow as pa
from helpers import clashing, groups, jaccard_links, shingles, words

from vellum.llm.paragraphs import LONG, MIN_WORDS, Paragraphs, stage_substrings, substring_dedup

SCHEMA = "doc_id long, text string"


def table(rng):
    vocab = ["v%d" % k for k in range(3000)]
    passage = lambda n: [rng.choice(vocab) for _ in range(n)]
    shared = [passage(n) for n in (14, 30, 60, 90, 400)]
    rows = []
    for i in range(80):
        lines = [" ".join(passage(rng.randint(1, 40))) for _ in range(rng.randint(1, 4))]
        for _ in range(rng.randint(0, 2)):
            w = list(rng.choice(shared))
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            lines.insert(rng.randint(0, len(lines)), " ".join(w))
        rows.append((i, rng.choice(["", "\n", " "]) + "\n".join(lines) + rng.choice(["", "\n\n"])))
    return rows


def brute(rows):
    """Occurrences that go: (id, place), by plain splitting and full comparison."""
    places = {}
    for i, t in rows:
        p, w = Paragraphs(pa.array([t or ""])), words(t)
        for k in range(len(p.row)):
            if p.n_words[k] >= MIN_WORDS:
                places[(i, k)] = shingles(w[p.first[k]:p.first[k + 1]], 5)
    at = groups(places, jaccard_links(places))
    return {p for p in places if at[p] != p}


def test_against_brute_force(spark):
    rows = table(random.Random(21)) + [(300, None), (301, ""), (302, "\n \n"), (303, "short line\nshort line")]
    out = substring_dedup(clashing(spark.createDataFrame(rows, SCHEMA))).collect()
    assert len(out) == len(rows)
    got = {(r.doc_id, x.place) for r in out for x in r.removed}
    assert got == brute(rows)
    assert all(r.n_removed == len(r.removed) and r.removed_words == sum(x.size for x in r.removed) for r in out)
    assert all(set(r.kept_in) == {x.first_doc_id for x in r.removed} for r in out)


def test_repeated_rows_and_null_ids(spark):
    line = " ".join("k%d" % k for k in range(40))
    rows = [(5, line), (5, line), (7, "head\n" + line), (None, line + "\ntail")]
    out = {(r.doc_id, r.n_removed) for r in substring_dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {(5, 1), (7, 1), (None, 0)}      # null ids come first
    assert substring_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_passage_within_long_lines(spark):
    rng = random.Random(8)
    fill = lambda n: [str(rng.random()) for _ in range(n)]
    passage = fill(120)
    rows = [(i, " ".join(fill(LONG) + passage + fill(90))) for i in range(4)]
    out = sorted(substring_dedup(spark.createDataFrame(rows, SCHEMA)).collect())
    assert [r.n_removed > 0 for r in out] == [False, True, True, True]
    assert all(r.removed_words <= 130 for r in out)


def test_stage_cuts_paragraphs(spark):
    rng = random.Random(5)
    line = " ".join("Ä%d" % k for k in range(30))
    rows = [(1, "first\n" + line + "\nlast"), (2, line), (3, "x y\n" + line + "\nend"), (4, None), (5, "")]
    docs = spark.createDataFrame([(i, t, None if t is None else len(t)) for i, t in rows], SCHEMA + ", n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in stage_substrings(spark, docs, "").collect()}
    assert got == {1: (rows[0][1], len(rows[0][1])), 3: ("x y\nend", 7), 4: (None, None), 5: ("", 0)}
    big = table(rng)
    left = {r.doc_id: r.text for r in stage_substrings(spark, spark.createDataFrame(big, SCHEMA), "").collect()}
    gone = brute(big)
    assert {i for i, _ in big} - set(left) == {i for i, t in big if t.strip() and {(i, k) for k in range(
        len(Paragraphs(pa.array([t])).row))} <= gone}
    assert not brute([(i, t) for i, t in left.items()])


def test_splitting_is_by_lines_and_keeps_every_byte():
    rng = random.Random(2)
    texts = ["\n".join(" ".join(rng.choice(["a", "bb", "ccc"]) for _ in range(rng.choice([0, 3, 40, 500]))) for _ in range(5))
             for _ in range(30)] + ["", None, "\n\n"]
    p = Paragraphs(pa.array(texts))
    for r, t in enumerate(texts):
        own = [k for k in range(len(p.row)) if p.row[k] == r]
        assert sum(p.n_words[k] for k in own) == len(words(t))
        assert [p.index[k] for k in own] == list(range(len(own)))
        ends = [p.begin[k] for k in own] + [p.words.offs[r + 1]]
        raw = p.words.data[ends[0]:].tobytes()[:ends[-1] - ends[0]] if own else b""
        assert (t or "").encode().endswith(raw)
        if not any(len(x.split()) > LONG for x in (t or "").split("\n")):
            assert len(own) == sum(bool(x.split()) for x in (t or "").split("\n"))


def test_passages_within_lines_of_every_length(spark):
    rng = random.Random(31)
    fill = lambda n: [str(rng.random()) for _ in range(n)]
    rows, expected, doc_id = [], {}, 0
    for around in (0, 7, 40, 300):
        for n in (51, 60, 80):
            passage = fill(n)
            for copy in range(3):
                head = fill(around + copy)
                rows.append((doc_id, " ".join(head + passage + fill(around + 2 * copy + 1))))
                expected[doc_id] = (len(head), n) if copy else None
                doc_id += 1
    docs = spark.createDataFrame(rows, SCHEMA)
    whole = {(r.doc_id, x.place) for r in substring_dedup(docs).collect() for x in r.removed}
    got = {r.doc_id: [(x.begin, x.words, x.first_doc_id) for x in r.passages] for r in substring_dedup(docs).collect()}
    assert got == {i: [(*e, i - i % 3)] if e else [] for i, e in expected.items()}
    left = {r.doc_id: words(r.text) for r in stage_substrings(spark, docs, "").collect()}
    for i, t in rows:
        if expected[i] is None:
            assert left[i] == words(t)
        else:
            a, n = expected[i]
            rest = words(t)[:a] + words(t)[a + n:]
            assert left.get(i, []) == rest or any(d == i for d, _ in whole) and set(left.get(i, [])) <= set(rest)


def test_passages_keep_an_earlier_copy(spark):
    rng = random.Random(32)
    fill = lambda n: [str(rng.random()) for _ in range(n)]
    near, tail = fill(140), fill(55)
    other = near[:70] + ["edit"] + near[71:]
    rows = [(0, " ".join(near)), (1, " ".join(other)), (2, " ".join(fill(90) + other[40:100] + fill(90))),
            (3, " ".join(["a"] * 120)), (4, " ".join(fill(30) + tail)), (5, " ".join(tail + fill(70))), (None, " ".join(fill(3) + tail))]
    docs = spark.createDataFrame(rows, SCHEMA)
    left = {r.doc_id: words(r.text) for r in stage_substrings(spark, docs, "").collect()}
    text = [w for x in left.values() for w in x]
    assert {w for _, t in rows for w in words(t)} == set(text)      # every word is still somewhere
    assert sum(text.count(w) for w in tail) == len(tail) and left[None][-1] == tail[-1]
    assert 1 not in left and "edit" in left[2]       # a near copy that goes is no copy to keep
    assert left[3] == ["a"] * 50


def test_short_lines(spark):
    rng = random.Random(33)
    fill = lambda n: [str(rng.random()) for _ in range(n)]

    def wrapped(w, least, most):
        lines = []
        while w:
            n = rng.randint(least, most)
            lines, w = [*lines, " ".join(w[:n])], w[n:]
        return "\n".join(lines)

    rows, rest = [], {}
    for n in (60, 600):
        for least, most in ((11, 11), (1, 11), (1, 4)):
            passage = fill(n)
            for copy in range(3):
                own = fill(6)
                rest[len(rows)] = own + (passage if copy == 0 else [])
                rows.append((len(rows), " ".join(own) + "\n" + wrapped(passage, least, most)))
    line = fill(5)
    for _ in range(3):
        own = fill(8)
        rest[len(rows)] = own + (line if len(rows) == 18 else [])
        rows.append((len(rows), " ".join(own) + "\n" + " ".join(line)))
    got = {r.doc_id: words(r.text) for r in stage_substrings(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert got == rest
