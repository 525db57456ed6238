import random
from itertools import permutations

from helpers import WORDS, clashing

from vellum.llm.filter_audit import WINDOW, audit, text_measures

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def plain(docs, labels):
    """Order by order, row by row."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, _, source, _ in docs:
        text = text or ""
        w = WORDS.findall(text)
        fails = set()
        if len(w) < 50:
            fails.add("A")
        if 100 * len(set(w)) < 65 * len(w):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text):
            fails.add("C")
        if any(c in "#$%&*|" for c in text):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in docs):
            fails.add("E")
        rows.append((source or "", fails, i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in permutations("ABCDE"):
            alive = own
            gone = []
            for step, f in enumerate(order, 1):
                here = [r for r in alive if f in r[1]]
                redundant = sum(f in r[1] for r in gone)
                alive = [r for r in alive if f not in r[1]]
                gone = gone + here
                shapley[f] += len(here)
                lines.append(("".join(order), step, f, len(alive), len(here), redundant, sum(r[1] == {f} for r in own),
                              sum(r[2] for r in here), sum(r[3] for r in here)))
        for order, step, f, *numbers in lines:
            out[part, order, step] = (*numbers, shapley[f])
    return out


def got(table):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
            for r in table.collect()}


def random_docs(n=160):
    rng = random.Random(11)
    words = ["alpha", "beta", "Gamma", "delta", "EPSILON", "zeta#", "eta", "theta", "x|y", "ünï", "ok", "é"] + [f"w{k}" for k in range(120)]
    pool = [" ".join(rng.choice(words) if rng.random() < 0.4 else f"u{rng.randrange(999)}" for _ in range(rng.choice([0, 5, 40, 60, 120]))) for _ in range(40)]
    pool += ["same same " * 40, "SHOUT " * 60, " \t\n", "", None, "a\x0bb\x0cc\rd\x1ce"]
    docs = [(k, rng.choice(pool), "en", rng.choice(["web", "web", "web", "book", None, ""]), 1) for k in range(n)]
    docs += [docs[3], docs[3], (7, "another text under a repeated id", "en", "web", 1), (None, docs[0][1], None, "web", None), (None, None, None, None, None)]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, n, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    return docs, labels


def test_against_plain_version(spark):
    docs, labels = random_docs()
    d, l = clashing(spark.createDataFrame(docs, DOCS)), clashing(spark.createDataFrame(labels, LABELS))
    for name in ("part", "before", "filter", "kind", "_row", "_id", "digest", "n_marks", "is_copy", "_total"):
        if name not in d.columns:
            from pyspark.sql import functions as F
            d, l = d.withColumn(name, F.lit("x")), l.withColumn(name, F.lit("x"))
    want = plain(docs, labels)
    assert got(audit(d, l)) == want
    assert {p for p, *_ in want} == {"web", "book", ""} and len(want) == 3 * 600


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert got(audit(docs, labels)) == {}
    one = spark.createDataFrame([(1, "x", None, "s", 1)], DOCS)
    assert got(audit(one, labels)) == plain([(1, "x", None, "s", 1)], [])


def test_very_long_text_is_measured_by_windows():
    text = ("Wörd " * 1000 + "one#two\n" + "x" * (2 * WINDOW) + " tail ") * 3
    data = text.encode()
    w = WORDS.findall(text)
    import hashlib
    assert text_measures(data) == (len(w), len(set(w)), sum("A" <= c <= "Z" for c in text), len(text), 3, hashlib.sha256(data).digest())
    assert text_measures(b"")[:5] == (0, 0, 0, 0, 0)
