"""Vector column functions (ARRAY<DOUBLE>) as built-in higher-order functions.

The dot product folds left to right from 0.0, the same order as a sequential
sum, so results are bit-identical to any engine that sums in index order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from vellum.functions.text import WORD_PATTERN, words
from vellum.session import ship_package

# Feature hashing (the offline embedder): fixed design of this library.
#   bucket = first 8 hex digits of md5(word) as an integer, modulo dim
#   sign   = +1 when the 9th hex digit is 0-7, else -1
DEFAULT_DIM = 64
NO_WORD_PATTERN = "[^" + WORD_PATTERN[1:-2] + "]+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element transform)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def as_double_vector(col) -> Column:
    return _c(col).cast("array<double>")


def dot(a, b) -> Column:
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x * y)
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0).cast("double"), lambda acc, x: acc + x * x))


def cosine(a, b) -> Column:
    """True cosine; NULL when either norm is zero."""
    return let(F.array(norm(a), norm(b)), lambda ns: F.when(
        (ns[0] > 0) & (ns[1] > 0), dot(a, b) / (ns[0] * ns[1])))


def l2_normalise(v) -> Column:
    def with_vec(vec: Column) -> Column:
        return let(norm(vec), lambda n: F.when(n > 0, F.transform(vec, lambda x: x / n)).otherwise(vec))
    return let(_c(v), with_vec)


def hash_codes(text, dim: int = DEFAULT_DIM) -> Column:
    """Per word: bucket, plus ``dim`` when the sign is negative.

    The digests are computed in one pass over the words; the sign test
    compares the 9th hex digit as a character ("8".."f" are >= "8").
    """
    digests = F.transform(words(text), lambda w: F.md5(w))
    return F.transform(digests, lambda h: (
        F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint"), F.lit(dim))
        + F.when(F.substring(h, 9, 1) >= F.lit("8"), F.lit(dim)).otherwise(F.lit(0))).cast("int"))


KEPT_CODES = 1 << 18             # words whose code a worker remembers


class WordCodes(dict):
    """``hash_codes`` of single words, remembered."""

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, word: str) -> int:
        h = hashlib.md5(word.encode("utf-8")).hexdigest()
        code = int(h[:8], 16) % self.dim + (self.dim if h[8] >= "8" else 0)
        if len(self) >= KEPT_CODES:
            self.clear()
        self[word] = code
        return code


_codes: dict[int, WordCodes] = {}


def hash_matrix(rows: Iterable[Sequence[str]], dim: int = DEFAULT_DIM) -> np.ndarray:
    """One row of ``hash_vector`` for the words of each text."""
    code = _codes.setdefault(dim, WordCodes(dim)).__getitem__
    flat: list[int] = []
    counts: list[int] = []
    for ws in rows:
        flat.extend(map(code, ws))
        counts.append(len(ws))
    cells = np.repeat(np.arange(len(counts)) * (2 * dim), counts) + np.asarray(flat, dtype=np.int64)
    both = np.bincount(cells, minlength=len(counts) * 2 * dim).reshape(-1, 2, dim)
    v = (both[:, 0] - both[:, 1]).astype(np.float64)
    n = np.sqrt((v * v).sum(axis=1, keepdims=True))          # of integers: exact in any order
    return np.divide(v, n, out=v, where=n > 0)


def hash_vector(text, dim: int = DEFAULT_DIM) -> Column:
    """Unit-length signed bag-of-words vector; all zeros for a text without words.

    Spark lower-cases the text and leaves its words; codes are looked up and counted in
    Arrow batches, as there are far fewer different words than words.
    """
    session = SparkSession.getActiveSession()
    if session is not None:
        ship_package(session)

    def vectors(texts: pa.Array) -> pa.Array:
        found = hash_matrix((t.split(" ") if t else () for t in texts.to_pylist()), dim)
        offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * dim, pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(found.ravel(), pa.float64()))

    c = _c(text)
    left = F.btrim(F.regexp_replace(F.lower(c), NO_WORD_PATTERN, " "))
    # a null has no words to count; ``size`` says what that makes of the vector
    unknown = F.size(F.lit(None).cast("array<int>"))
    of_null = l2_normalise(F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: (unknown - unknown).cast("double")))
    return F.when(c.isNull(), of_null).otherwise(F.arrow_udf(vectors, "array<double>")(left))


