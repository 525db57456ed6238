"""Column functions on text: newline handling, whitespace, strip, tokens, ids.

All of them are built-in Spark expressions (JVM side, no Python worker).
The regular expressions are written so that Java's engine and RE2 read them
the same way; the DuckDB statements spell out their own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the pipeline being reproduced)
#   * whitespace normalisation maps newline, tab and no-break space to a space
#   * the txt loader tags every document with the literal source "Klexikon"
#   * a chunk may hold at most 8191 tokens
#   * embedding batches: total tokens // 100000 batches
# ---------------------------------------------------------------------------
NORMALISE_FROM = "\n\t "
NORMALISE_TO = "   "
TXT_SOURCE = "Klexikon"
MAX_CHUNK_TOKENS = 8191
TOKENS_PER_BATCH = 100000

# Characters Python's ``str.strip()`` removes (``str.isspace``), written as an
# explicit class so Java and RE2 agree (``\s`` differs between them).
PY_SPACE_CLASS = (
    r"[\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
PY_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# Runs of non-white-space characters: the pieces of Python's ``str.split()``.
NON_SPACE_RUN = "[^" + PY_SPACE_CLASS[1:-1] + "]+"

# Stand-in tokenizer for ``count_tokens``: runs of letters/digits, or any
# other single non-space character.
TOKEN_SPACES = "\t\n\x0b\x0c\r "
# Words used by the feature-hashing embedder.
WORD_PATTERN = r"[\p{L}\p{N}]+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def universal_newlines(col) -> Column:
    """Python text-mode reading: ``\\r\\n`` and lone ``\\r`` become ``\\n``."""
    return F.regexp_replace(_c(col), "\r\n?", "\n")


def normalise_whitespace(col) -> Column:
    """``\\n``, ``\\t`` and ``\\xa0`` each become one space (1:1, no collapsing)."""
    return F.translate(_c(col), NORMALISE_FROM, NORMALISE_TO)


def py_strip(col) -> Column:
    """Python ``str.strip()`` (Unicode white space at both ends)."""
    return F.btrim(_c(col), F.lit(PY_SPACES))


def token_count(col) -> Column:
    """Default native token counter (a stand-in for a provider tokenizer).

    Every run is shortened to one character and the spaces are taken out: what is
    left is as long as there are tokens, and no token is made for itself."""
    c = _c(col)
    runs = F.regexp_replace(c, WORD_PATTERN, "a")
    # ``size`` says what the count of a null is
    return F.when(c.isNull(), F.size(F.lit(None).cast("array<string>"))).otherwise(F.length(F.translate(runs, TOKEN_SPACES, "")))


def words(col) -> Column:
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(WORD_PATTERN), 0)


def stable_id(*cols) -> Column:
    """Deterministic row id: SHA-256 of the key parts joined by U+001F.

    Stable under task retry and re-runs, unlike a random UUID.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return F.sha2(F.concat_ws("\u001f", *parts), 256)
