"""HTML to text, as built-in Spark expressions.

Semantics followed (one document per page): the text is every text node in
document order concatenated with no separator, ``<title>`` included; the
contents of ``<script>`` and ``<style>`` and all comments and the doctype are
left out; character references are decoded once (so ``&amp;lt;`` gives
``&lt;``).  The title is the decoded text of the first ``<title>`` element,
or ``""`` when there is none.

Markup is one alternation scanned from left to right, so a comment mark in a
script, a tag in a comment, or a ``>`` in a quoted attribute belongs to what
was opened first.  An unclosed comment, script or style reaches to the end.

References follow HTML 5 by the table of the Python standard library: names
with a semicolon, the old names also without one, and numbers (the C1 range
by windows-1252; zero, surrogates and numbers beyond Unicode give U+FFFD).
Unknown names are kept as written.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# possessive: a tag without its end costs one scan, not many
_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
SCRIPTS_AND_COMMENTS = (rf"(?is)<script\b{_ATTRIBUTES}.*?(?:</script\s*>|\z)|<style\b{_ATTRIBUTES}.*?(?:</style\s*>|\z)"
                        r"|<!--.*?(?:-->|\z)")
MARKUP = rf"{SCRIPTS_AND_COMMENTS}|</?[a-z!?]{_ATTRIBUTES}"
TITLE = rf"(?is)<title\b{_ATTRIBUTES}(.*?)</title\s*>"

OLD_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
_OLD = "|".join(OLD_NAMES)
# a reference, a run of plain text, or a lone ampersand
_PIECES = rf"&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[A-Za-z][A-Za-z0-9]*;|&(?:{_OLD})|[^&]+|&"
REPLACEMENT = "�"


def c1_characters() -> dict[int, str]:
    """Code points 128 to 159 as windows-1252 reads them, where it does."""
    out = {}
    for cp in range(0x80, 0xA0):
        char = bytes([cp]).decode("cp1252", errors="ignore")
        if char:
            out[cp] = char
    return out


def _map(pairs) -> Column:
    """A constant map: one literal, which the optimizer folds, instead of one for each entry."""
    return F.from_json(F.lit(json.dumps(dict(pairs))), "map<string,string>")


def _character(cp: Column) -> Column:
    """Character of a code point; ``cp`` is null where the number is too large."""
    # UTF-32 big-endian bytes of the code point, decoded
    plain = F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")
    bad = cp.isNull() | (cp == 0) | (cp > 0x10FFFF) | cp.between(0xD800, 0xDFFF)
    c1 = F.try_element_at(_map((str(n), c) for n, c in c1_characters().items()), cp.cast("string"))
    return F.when(bad, F.lit(REPLACEMENT)).when(cp.between(0x80, 0x9F), F.coalesce(c1, plain)).otherwise(plain)


def decode_references(col) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    names = _map(sorted((n.rstrip(";"), c) for n, c in html5.items() if n.endswith(";")))
    old = _map(sorted((n, html5[n]) for n in OLD_NAMES))

    def one(tok: Column) -> Column:
        hexa = F.regexp_extract(tok, r"^&#[xX]0*([0-9a-fA-F]*);?$", 1)
        hex_cp = F.when(F.length(hexa) == 0, F.lit(0).cast("bigint")).when(
            F.length(hexa) <= 6, F.conv(hexa, 16, 10).try_cast("bigint"))
        digits = F.regexp_extract(tok, r"^&#0*([0-9]*);?$", 1)
        dec_cp = F.when(F.length(digits) == 0, F.lit(0).cast("bigint")).when(F.length(digits) <= 7, digits.try_cast("bigint"))
        known = F.try_element_at(names, F.regexp_extract(tok, r"^&([A-Za-z][A-Za-z0-9]*);$", 1))
        prefix = F.regexp_extract(tok, rf"^&({_OLD})", 1)
        by_prefix = F.concat(F.try_element_at(old, prefix), F.substr(tok, F.length(prefix) + 2))
        return (F.when(tok.rlike("^&#[xX]"), _character(hex_cp))
                .when(tok.rlike("^&#[0-9]"), _character(dec_cp))
                .when(tok.rlike("^&[A-Za-z]"), F.coalesce(known, by_prefix, tok))
                .otherwise(tok))

    toks = F.regexp_extract_all(col, F.lit(_PIECES), 0)
    return F.when(col.contains("&"), F.array_join(F.transform(toks, one), "")).otherwise(col)


def html_text(col) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return decode_references(F.regexp_replace(col, MARKUP, ""))


def html_title(col) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    title = F.regexp_extract(F.regexp_replace(col, SCRIPTS_AND_COMMENTS, ""), TITLE, 1)
    return decode_references(F.regexp_replace(title, MARKUP, ""))
