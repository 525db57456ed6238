import hashlib
import random
import re
import time

from helpers import clashing
from hypothesis import given, settings
from hypothesis import strategies as st

from vellum.llm.personal_data import BASE, find_in, find_personal_data, luhn, mod97, op12_personal_data, redacted, union

# the contract's expressions, as they stand there
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and plain_luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def base(text):
    return [s[:3] for s in find_in(text) if s[4]]


PIECES = ["a", "b.c", "@", ".", "x-y", "%", "+", "1", "23", "255", "256", "0007", " ", "-", "(", ")", "4111111111111111",
          "4111 1111 1111 1111", "+49 30 1234567", "+1 (743) 555-3824", "me@host.example", "é", "😀", "8.8.8.8", "\n", "..", "@@"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14))
def test_base_spans_are_those_of_the_plain_expressions(pieces):
    text = "".join(pieces)
    assert base(text) == plain(text)


@settings(max_examples=1500, deadline=None)
@given(st.text("0123. -+()@a", max_size=60))
def test_base_spans_on_random_characters(text):
    assert base(text) == plain(text)


def test_checksums():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    for account in ("GB82WEST12345698765432", "DE89370400440532013000", "FR1420041010050500013M02606"):
        assert mod97(account)
        assert not mod97(account[:-1] + ("1" if account[-1] != "1" else "2"))
    rng = random.Random(5)
    for _ in range(300):
        d = "".join(rng.choice("0123456789") for _ in range(rng.randint(13, 19)))
        assert luhn(d) == plain_luhn(d)


def test_added_kinds_need_a_checksum_or_a_context_word():
    kinds = lambda t: [s[0] for s in find_in(t)]
    assert kinds("pay to DE89 3704 0044 0532 0130 00 AND more") == ["iban"]
    assert kinds("pay to DE89 3704 0044 0532 0130 01 please") == []
    assert kinds("XXDE89370400440532013000") == []
    assert kinds("the number (743) 555-3824 stood there") == []
    assert kinds("call me: (743) 555-3824") == ["national_phone"]
    assert kinds("his SSN is 219-09-9999.") == ["ssn"] and kinds("part 219-09-9999") == [] and kinds("ssn 000-09-9999") == []
    near, far = find_in("visa 4111111111111111"), find_in("4111111111111111")
    assert near[0][3] > far[0][3] > find_in("isbn 4111111111111111")[0][3]
    assert [s[0] for s in find_in("isbn 8.8.8.8")] == ["ip"]                     # base spans stay, whatever their score


def test_added_spans_overlap_no_base_span():
    # an address inside the digits of an account number: the base span stays, alone
    text = "iban DE89370400440532013000 and ssn 219-09-9999, a@b.cc 219-09-9999 (ssn)"
    spans = find_in(text)
    assert [s[0] for s in spans if s[4]] == [k for k, *_ in plain(text)]
    for kind, a, b, _, own in spans:
        assert own or all(y <= a or b <= x for _, x, y in plain(text)), kind
    assert union([(3, 5), (1, 2), (4, 9), (9, 10), (20, 21)]) == ([1, 3, 20], [2, 10, 21])
    many = "call (743) 555-3824 me@host.example 8.8.8.8 +49 30 1234567 ssn 219-09-9999\n" * 20_000
    began = time.time()
    found = find_in(many)
    assert len(found) == 20_000 * 5 and time.time() - began < 60


def test_redaction():
    text = "mail me@host.example or +49 30 1234567, card 4111 1111 1111 1111"
    assert redacted(text, find_in(text)) == "mail [EMAIL] or [PHONE], card [CARD]"
    assert redacted("none", []) == "none"


def test_long_texts_take_linear_time():
    began = time.time()
    for text in ("a" * 3_000_000, "1" * 3_000_000, "1 " * 1_500_000, "1." * 1_500_000, "a@" * 1_000_000, "+1" + " " * 3_000_000,
                 "a@b" * 1_000_000, "-" * 2_000_000 + "@x.y", "+1(" * 1_000_000, "AA00" * 500_000):
        find_in(text)
    assert time.time() - began < 60


def test_rows(spark):
    rows = [(1, "a me@host.example"), (2, None), (3, ""), (1, "a me@host.example"), (None, "😀 8.8.8.8"), (4, "x" * 200_000 + " +49 30 1234567")]
    table = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    from pyspark.sql import functions as F
    for name in ("details", "redacted", "kind", "_text", "_id"):
        table = table.withColumn(name, F.lit("x"))
    got = find_personal_data(table, redact=True).collect()
    assert sorted(((r.doc_id, [tuple(s)[:3] for s in r.details]) for r in got), key=repr) == sorted(
        ((i, plain(t or "")) for i, t in rows), key=repr)
    assert {r.redacted for r in got} == {"a [EMAIL]", "", "😀 [IP]", "x" * 200_000 + " [PHONE]"}
    assert find_personal_data(table.limit(0)).count() == 0


def test_query_against_the_plain_expressions(spark):
    got = {r.doc_id: r for r in op12_personal_data(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for i, text in docs:
        want = plain(text or "")
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        r = got[i]
        assert tuple(r[f"n_{k}"] for k in BASE) == tuple(sum(w[0] == k for w in want) for k in BASE)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert set(told.split(",")) <= set(r.spans.split(","))
