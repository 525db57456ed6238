import hashlib
import heapq
import random
import re
import zlib

from helpers import WORDS, clashing
from pyspark.sql import functions as F

from vellum.llm.conversation_repair import (SignatureWalk, audits_of, cheapest_repairs, damaged, op13_conversation_repair, repair,
                                            repaired_digests, tidy)

TURNS = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()


def search(rows):
    """Cheapest, then ASCII-least edit string, by best-first search over whole
    edit strings.  ``rows``: (initial, must go, truncated)."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, made = heapq.heappop(heap)
        if (at, made) in seen:
            continue
        seen.add((at, made))
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", made):
            return cost, audit
        steps = [(3, "I", at, made + c) for c in "ua"]
        if at < len(rows):
            initial, must_go, cut = rows[at]
            steps.append((4, "D", at + 1, made))
            if not must_go:
                steps.append((3 * cut, "K", at + 1, made + (initial or "?")))
                steps += [(3 + 3 * cut, "R", at + 1, made + c) for c in "ua"]
        for more, letter, to, now in steps:
            if re.fullmatch("s?(ua)*u?", now):
                heapq.heappush(heap, (cost + more, audit + letter, to, now))
    raise AssertionError


def judge(conversation):
    """All contract columns of one conversation: (turn, role, text) rows after damage."""
    rows = sorted(conversation, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    seen, faults = set(), []
    for _, role, text in rows:
        last = (WORDS.findall(text) or [""])[-1][-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = search([(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults)])
    out, made, at = [], "", 0
    for e in audit:
        wanted = {"": "user", "s": "user", "u": "assistant", "a": "user"}[made[-1:]]
        if e == "I":
            out.append((wanted, ""))
        else:
            _, role, text = rows[at]
            at += 1
            if e == "D":
                continue
            out.append((role if e == "K" else wanted, text))
        made += out[-1][0][:1]
    told = "\n".join(f"{r}:{t}" for r, t in out)
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256(told.encode()).hexdigest()), out


def after_damage(rows):
    out = {}
    for c, t, role, text in rows:
        own = out.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        own += [(t, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def told(r):
    return (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)


def random_turns(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in [*range(n), None]:
        for t in range(rng.randint(1, 7)):
            rows.append((c, rng.choice([t, t, t, t + 3, None]), rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None, "User"]),
                         rng.choice(["Hi.", "So?", "cut", "cut off, ", " \t\n", "", None, "End!  ", "é.", "same.", "same.", "x.y"])))
    return rows


def test_automaton_against_search_and_each_suffix_once():
    rng = random.Random(3)
    words = {"".join(rng.choice("suaxSUAXdd") for _ in range(rng.randint(0, 8))) for _ in range(700)} | {"", "s", "d", "ua", "sua", "aaaaaaaa"}
    walk, built = SignatureWalk(), 0
    for w in sorted(words, key=lambda w: w[::-1]):
        cost, audit, nodes = walk.repair(w)
        assert (cost, audit) == search([(c.lower(), c == "d", c.isupper()) for c in w]), w
        built += nodes
    assert built == len({w[k:] for w in words for k in range(len(w))})         # one node for each suffix
    behaviours, new = set(), {walk.automaton.end[1]}
    while new:                                                                   # all that signatures of any length can reach
        behaviours |= new
        new = {walk.automaton.before(c, (None, b, 0))[1] for b in new for c in "suaxSUAXd"} - behaviours
    assert len(walk.automaton.table) <= 9 * len(behaviours) < 1000


def test_table_of_signatures(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("suaSUAxd") for _ in range(rng.randint(0, 6))) for _ in range(300)})
    got = cheapest_repairs(spark.createDataFrame([(w,) for w in words], "signature string")).collect()
    assert {(r.signature, r.cost, r.audit) for r in got} == {(w, *search([(c.lower(), c == "d", c.isupper()) for c in w])) for w in words}


def test_damaged_conversations_against_search(spark):
    rows = random_turns(8, 150) + [(500, t, "assistant" if t % 2 else "user", f"turn {t}.") for t in range(300)]
    rows += [(c, t, "user", "gone.") for c in range(600, 900) for t in (0,) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:4]
    table = clashing(spark.createDataFrame(rows, TURNS))
    for name in ("signature", "audit", "cost", "blank", "_c", "_kind", "_d", "_n"):
        table = table.withColumn(name, F.lit("x"))
    state = damaged(tidy(table, "conv_id", "turn", "role", "text"))
    got = repaired_digests(state.where(~F.col("_gone")), audits_of(state).drop("signature")).collect()
    want = {c: judge(r)[0] for c, r in after_damage(rows).items() if c != 500}
    long = next(r for r in got if r["_c"] == 500)
    assert {r["_c"]: told(r) for r in got if r["_c"] != 500} == want and len(got) == len(want) + 1
    assert len(long.audit) >= 270 and set(long.audit) <= set("KRDI")
    assert (0, 0, 0, 0, 0, 0, "", EMPTY) in want.values()


def test_repaired_rows(spark):
    rows = random_turns(9, 60)
    counts, out = repair(spark.createDataFrame(rows, TURNS))
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    want = {c: judge(r) for c, r in convs.items()}
    got = {}
    for r in out.orderBy("conv_id", "seq").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {c: o for c, (_, o) in want.items() if o}
    assert {r.conv_id: (r.cost, r.audit) for r in counts.collect()} == {c: w[5:7] for c, (w, _) in want.items()}
    for turns in got.values():
        assert re.fullmatch("s?(ua)+", "".join(r[:1] for r, _ in turns))


def test_empty_and_very_long(spark):
    empty = spark.createDataFrame([], TURNS)
    counts, out = repair(empty)
    assert counts.count() == 0 and out.count() == 0
    long = spark.createDataFrame([(1, 0, "user", "word " * 200_000 + "end."), (1, 1, "assistant", "y" * 1_000_000)], TURNS)
    counts, out = repair(long)
    assert [(r.cost, r.audit, r.truncated) for r in counts.collect()] == [(3, "KK", 1)] and out.count() == 2


def test_query_against_search(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op13_conversation_repair(spark, "/root/testdata/sf0.01").collect()
    assert {r.conv_id: told(r) for r in got} == {c: judge(r)[0] for c, r in after_damage(rows).items()}
