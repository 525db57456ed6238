import hashlib
import random

from helpers import clashing
from pyspark.sql import functions as F

from vellum.llm.chat_format import digest, loss_text, parse_turns, reconstruct, render

EVENTS = "conv_id long, seq long, kind string, message string, role string, text string"
TURNS = "conv_id long, turn long, role string, text string"


def fold(events):
    """Event by event, as a reader of the log would."""
    live = {}
    for c, q, k, m, r, t in sorted(events, key=lambda e: (str(e[0]), e[1])):
        k, m, t = k or "message", m if m is not None else f"#{q}", t or ""
        log = live.setdefault(c, {})
        if k not in ("message", "delta", "edit", "regenerate"):
            continue
        if m not in log:
            log[m] = {"seq": q, "role": None, "text": "", "gone": False}
        msg = log[m]
        if k == "regenerate":
            for other in log.values():
                other["gone"] |= other["seq"] > msg["seq"]
        msg["text"] = msg["text"] + t if k == "delta" else t
        msg["role"] = msg["role"] if msg["role"] is not None else r
    return {c: [(m["role"], m["text"]) for m in sorted(log.values(), key=lambda x: x["seq"]) if not m["gone"]] for c, log in live.items()}


def test_folding_events(spark):
    rng = random.Random(6)
    events = []
    for c in range(40):
        known = []
        for q in range(rng.randint(1, 25)):
            kind = rng.choice(["message", "delta", "delta", "edit", "regenerate", None, "ping"])
            if kind in ("delta", "edit", "regenerate") and known:
                m = rng.choice(known)
            else:
                m = rng.choice([f"m{q}", None])
                if m:
                    known.append(m)
            events.append((c, q, kind, m, rng.choice(["user", "assistant", None]), rng.choice(["a", "b ", None, "<s>"])))
    got = {}
    for r in reconstruct(clashing(spark.createDataFrame(events, EVENTS))).orderBy("conv_id", "seq").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert got == {c: m for c, m in fold(events).items() if m}


def test_reading_back_is_exact(spark):
    bits = ["</s>", "<s>", "~", "~0", "~1", "<", "[", "[INST]", "\n", "é😀", "", "~3", "\\", "x" * 50]
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "to\nol", "~3", "", None, "<s>"]),
             None if rng.random() < 0.1 else "".join(rng.choice(bits) for _ in range(rng.randint(0, 6))))
            for c in list(range(30)) + [None] for t in range(rng.randint(1, 6))]
    rows += [(7, 0, "user", "tie"), (7, 0, "assistant", "tie"), (7, 0, "user", "tie"), (99, 0, "assistant", "long " * 50_000)]
    table = clashing(spark.createDataFrame(rows, TURNS))
    got = render(table).select("conv_id", "formatted", parse_turns(F.col("formatted")).alias("turns"),
                               loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss"), "loss_mask").collect()
    want = {}
    for c, t, r, x in sorted(rows, key=lambda v: (str(v[0]), v[1], v[2] or "", v[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in got} == want
    for r in got:
        assert r.loss == "".join(x for role, x in want[r.conv_id] if role == "assistant")
        bodies = [r.formatted[s.start:s.start + s.length] for s in r.loss_mask]
        assert all("<" not in b and "[" not in b for b in bodies)
    for r in digest(render(table)).collect():
        told = "".join(f"{role}\n{x}\n" for role, x in want[r.conv_id])
        assert (r.n_turns, r.turns_sha256) == (len(want[r.conv_id]), hashlib.sha256(told.encode()).hexdigest())


def test_native_and_empty(spark):
    out = digest(render(spark.createDataFrame([], TURNS)))
    assert out.count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
