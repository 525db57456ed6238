"""Personal data: patterns propose, checksums confirm, context words weigh.

1. Regular expressions propose spans.  The base kinds (email, ip, card, phone)
   take the leftmost matches that do not overlap, kind by kind; a match that
   its validator refuses is dropped and not tried again.
2. Validators: parts of an address at most 255, Luhn for cards, the number of
   digits for phones, the country's length and mod-97 for bank accounts.
3. Each span has a score: its kind's own (high if a checksum confirmed it),
   more if a word that goes with the kind stands near it, less if one that
   speaks against it does.  Base spans are always reported; those of the added
   kinds (iban, national phone numbers, social security numbers) if they reach
   the threshold and overlap no base span.

The expressions are written so that every text is scanned in linear time: an
email is looked for around its ``@`` and digit runs are taken whole.  Each text
is searched whole, in its own row, without a shuffle; a task holds one text
and its spans.

Defined results: null text is empty text and has no spans; equal and repeated
rows give equal rows; ids are passed through, null or not; an empty table
gives no rows; other columns are not read.  Spans are in code points, the end
exclusive, ordered by kind as listed in ``KINDS``, then by start.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.common import prepare, read_table, spread_small

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "national_phone", "ssn")
THRESHOLD = 0.5
BEFORE, AFTER = 48, 24        # code points in which a context word counts
NEAR, AGAINST = 0.3, -0.2

#: A kind's own score, and its score if a checksum confirmed it.
OWN_SCORE = {"email": 0.7, "ip": 0.5, "card": 0.8, "phone": 0.5, "iban": 0.8, "national_phone": 0.3, "ssn": 0.3}
#: Words that go with a kind, and words that speak against any.
CONTEXT = {
    "email": {"email", "mail", "contact", "correo", "courriel"},
    "ip": {"ip", "address", "host", "server", "login", "adresse"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "karte", "kreditkarte", "tarjeta", "carte"},
    "phone": {"phone", "call", "tel", "telephone", "mobile", "cell", "fax", "telefon", "handy", "teléfono", "téléphone"},
    "iban": {"iban", "account", "bank", "konto", "cuenta", "compte"},
    "national_phone": {"phone", "call", "tel", "telephone", "mobile", "cell", "fax", "telefon", "handy", "teléfono", "téléphone"},
    "ssn": {"ssn", "social", "security"},
}
COUNTER_WORDS = {"version", "release", "isbn", "order", "invoice", "serial", "sample", "dummy"}
#: Length of an account number by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24,
    "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29,
    "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24,
    "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_IBAN_REST = re.compile(r"(?: ?[A-Z0-9])")
_NATIONAL = re.compile(r"(?<![0-9+(])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Moved head, letters as 10 to 35, remainder 1."""
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of ``local@label(.label)+``, found around each ``@``."""
    at, floor = text.find("@"), 0
    while at >= 0:
        before = text[floor:at]
        start = floor + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        # local parts hold no "@": what lies before it is done with
        floor = domain.end() if domain else at + 1
        at = text.find("@", floor)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = (p.lstrip("0") for p in m[0].split("."))
        if all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:               # 19 digits and 18 marks between at most
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    at = text.find("+")
    while at >= 0:
        m = _PHONE.match(text, at)
        if m and 9 <= sum(map(m[0].count, "0123456789")) <= 15:
            yield m.span()
        at = text.find("+", m.end() if m else at + 1)


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN_HEAD.finditer(text):
        left, end = IBAN_LENGTH.get(m[0][:2], 0) - 4, m.end()
        while left > 0 and (more := _IBAN_REST.match(text, end)):
            left, end = left - 1, more.end()
        if left == 0 and not text[end:end + 1].isalnum() and mod97(text[m.start():end].replace(" ", "")):
            yield m.start(), end


def _matches(pattern):
    return lambda text: (m.span() for m in pattern.finditer(text))


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones, "iban": ibans,
           "national_phone": _matches(_NATIONAL), "ssn": _matches(_SSN)}


def score(text: str, kind: str, start: int, end: int) -> float:
    near = {w.lower() for w in _WORD.findall(text, max(0, start - BEFORE), start)}
    near |= {w.lower() for w in _WORD.findall(text, end, end + AFTER)}
    s = OWN_SCORE[kind] + (NEAR if near & CONTEXT[kind] else 0) + (AGAINST if near & COUNTER_WORDS else 0)
    return round(min(1.0, max(0.0, s)), 2)


def find_in(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, score, is a base span), by kind, then start."""
    out = [(k, a, b, score(text, k, a, b), True) for k in BASE for a, b in FINDERS[k](text)]
    starts, ends = union((a, b) for _, a, b, _, _ in out)
    for kind in KINDS[len(BASE):]:
        for a, b in FINDERS[kind](text):
            s = score(text, kind, a, b)
            before = bisect_left(starts, b)          # stretches that begin before the span's end
            if s >= threshold and not (before and ends[before - 1] > a):
                out.append((kind, a, b, s, False))
    return out


def union(spans: Iterable[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of what spans cover, in order."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def redacted(text: str, spans: list[tuple[str, int, int, float, bool]]) -> str:
    """``text`` with each span, or run of overlapping spans, replaced by its (first) kind."""
    out, at = [], 0
    for kind, a, b, _, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


DETAILS = "array<struct<kind:string,start:bigint,end:bigint,score:double,base:boolean>>"
_ARROW_DETAILS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                     ("score", pa.float64()), ("base", pa.bool_())]))


def find_personal_data(docs: DataFrame, *, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                       redact: bool = False) -> DataFrame:
    """``id``, ``details`` (all spans) and, with ``redact``, ``redacted`` text."""
    src = spread_small(docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ("kind", "start", "end", "score", "base")
        for rb in batches:
            spans, texts = [], []
            for value in rb.column(1):
                t = value.as_py()
                found = find_in(t, threshold)
                spans.append([dict(zip(keys, s, strict=True)) for s in found])
                if redact:
                    texts.append(redacted(t, found))
            columns = [rb.column(0), pa.array(spans, _ARROW_DETAILS)] + ([pa.array(texts, pa.string())] if redact else [])
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "details", "redacted"][:len(columns)])

    schema = f"_id {dict(src.dtypes)['_id']}, details {DETAILS}" + (", redacted string" if redact else "")
    return src.mapInArrow(run, schema).withColumnRenamed("_id", id)


def spans_text(details: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(details, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = find_personal_data(read_table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("details", lambda s: s["kind"] == kind)).cast("bigint")
    base = spans_text(F.filter("details", lambda s: s["base"]))
    return found.select("doc_id", *[of(k).alias(f"n_{k}") for k in BASE],
                        F.sha2(base.cast("binary"), 256).alias("base_sha256"), spans_text(F.col("details")).alias("spans"))


#: Matches and the pieces between them give the places.  The statement has the base kinds only: where
#: a table holds spans of the added kinds, column ``spans`` differs from it.
ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
p AS (
  SELECT doc_id, 'email' AS kind, 1 AS nth, regexp_extract_all(x, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS found,
         string_split_regex(x, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS apart FROM t
  UNION ALL
  SELECT doc_id, 'ip', 2, regexp_extract_all(x, '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)'),
         string_split_regex(x, '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)') FROM t
  UNION ALL
  SELECT doc_id, 'card', 3, regexp_extract_all(x, '[0-9](?:[\x20-]?[0-9])+'), string_split_regex(x, '[0-9](?:[\x20-]?[0-9])+') FROM t
  UNION ALL
  SELECT doc_id, 'phone', 4, regexp_extract_all(x, '\+[0-9][\x20().0-9-]+[0-9]'), string_split_regex(x, '\+[0-9][\x20().0-9-]+[0-9]') FROM t),
m AS (
  SELECT doc_id, kind, nth, found, apart, unnest(range(1, len(found) + 1)) AS i FROM p),
s AS (
  SELECT doc_id, kind, nth, found[i] AS v, regexp_replace(found[i], '[^0-9]', '', 'g') AS d,
         CAST(list_sum(list_transform(apart[1:i], lambda a: length(a)))
              + coalesce(list_sum(list_transform(found[1:i - 1], lambda a: length(a))), 0) AS BIGINT) AS first FROM m),
ok AS (
  SELECT doc_id, kind, nth, first, first + length(v) AS last FROM s
  WHERE CASE kind
    WHEN 'email' THEN true
    WHEN 'ip' THEN len(list_filter(string_split(v, '.'), lambda q: coalesce(TRY_CAST(q AS HUGEINT) > 255, true))) = 0
    WHEN 'card' THEN length(d) BETWEEN 13 AND 19 AND list_sum(list_transform(range(0, length(d)),
      lambda k: CAST(substr(d, length(d) - k, 1) AS INTEGER) * (1 + k % 2)
                - CASE WHEN k % 2 = 1 AND substr(d, length(d) - k, 1) > '4' THEN 9 ELSE 0 END)) % 10 = 0
    ELSE length(d) BETWEEN 9 AND 15 END),
g AS (
  SELECT doc_id, string_agg(kind || ':' || first || ':' || last, ',' ORDER BY nth, first) AS told,
         count(*) FILTER (WHERE kind = 'email') AS n_email, count(*) FILTER (WHERE kind = 'ip') AS n_ip,
         count(*) FILTER (WHERE kind = 'card') AS n_card, count(*) FILTER (WHERE kind = 'phone') AS n_phone
  FROM ok GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(told, '')) AS base_sha256, coalesce(told, '') AS spans
FROM t LEFT JOIN g ON t.doc_id = g.doc_id
"""
