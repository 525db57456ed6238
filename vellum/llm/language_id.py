"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1.  An n-gram is bound by
multiplying its letters' vectors, each rotated by its place in the n-gram;
a text's profile bundles (adds) the vectors of all its n-grams.  A
language's prototype bundles the profiles of its training texts, each
scaled to the same length.  A text gets the language whose prototype has
the largest cosine with its profile, both taken relative to the mean of the
prototypes (what all languages share says nothing).

Learning is one pass with a partial sum per task and a sum per language and
dimension; what reaches the driver is one vector per language.  Prediction
is a map over the rows.  Sums are of whole numbers, so a result does not
depend on the order of rows or on how tasks are cut.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import frugal, held_out, materialise, prepare, read_table, spread_small, unused

DIM = 512              # length of the vectors
NGRAM = 3
SEED = 20_011
SYMBOLS = 1 << 10      # letters are told apart up to this code, beyond it by a hash
SCALE = 1 << 16        # training profiles are scaled to this length and rounded
PIECE = 1 << 20        # characters of a text that are held as arrays at a time
REMEMBERED = 1 << 16   # n-gram vectors that a worker keeps
UNKNOWN = "und"
LONGEST = 40           # order of magnitude of the longest text there can be
#: The pipeline's stage rejects a text whose cosine with its language's prototype is below
#: this part of a low quantile of the cosines of training texts of that language and length.
REJECT_BELOW, QUANTILE, ENOUGH = 0.6, 0.05, 10


@functools.lru_cache(1)
def _symbols() -> np.ndarray:
    """Symbol of every code point; 0 stands for all that is no letter."""
    letters = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)
    code = np.arange(0x110000, dtype=np.int64)
    hashed = 1 + code * 2_654_435_761 % (SYMBOLS - 1)
    return np.where(letters, np.where(code < SYMBOLS, code, hashed), 0).astype(np.int64)


class Profiles:
    """Profiles of texts; keeps the vectors of the n-grams seen last."""

    def __init__(self):
        self.letters = np.random.default_rng(SEED).choice(np.array([-1, 1], dtype=np.int8), (SYMBOLS, DIM))
        self.codes = np.zeros(0, dtype=np.int64)
        self.vectors = np.zeros((0, DIM), dtype=np.int8)

    def _bind(self, codes: np.ndarray) -> np.ndarray:
        out = np.ones((len(codes), DIM), dtype=np.int8)
        for place in range(NGRAM):
            letter = codes // SYMBOLS ** place % SYMBOLS
            out *= np.roll(self.letters, place, axis=1)[letter]
        return out

    def _rows(self, codes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.codes, codes)
        known = np.zeros(len(codes), dtype=bool)
        inside = at < len(self.codes)
        known[inside] = self.codes[at[inside]] == codes[inside]
        if not known.all():
            fresh = codes[~known]
            if len(self.codes) + len(fresh) > REMEMBERED:
                self.codes, self.vectors = codes[:0], self.vectors[:0]
                fresh = codes
            place = np.searchsorted(self.codes, fresh)
            self.vectors = np.insert(self.vectors, place, self._bind(fresh), axis=0)
            self.codes = np.insert(self.codes, place, fresh)
            at = np.searchsorted(self.codes, codes)
        return self.vectors[at]

    def of(self, text: str) -> np.ndarray | None:
        """The bundle of a text's n-grams; None if it has no letter."""
        total, carry, any_letter = np.zeros(DIM), np.zeros(1, dtype=np.int64), False
        for start in range(0, len(text), PIECE):
            raw = text[start:start + PIECE].lower().encode("utf-32-le", "replace")
            s = np.concatenate([carry, _symbols()[np.frombuffer(raw, dtype="<u4")]])
            if start + PIECE >= len(text):
                s = np.append(s, 0)
            s = s[np.append(True, (s[1:] != 0) | (s[:-1] != 0))]      # runs of non-letters count as one
            any_letter = any_letter or bool(s.any())
            if len(s) >= NGRAM:
                grams = sum(s[k:len(s) - NGRAM + 1 + k] * SYMBOLS ** k for k in range(NGRAM))
                codes, counts = np.unique(grams, return_counts=True)
                for a in range(0, len(codes), 8192):
                    total += counts[a:a + 8192].astype(np.float64) @ self._rows(codes[a:a + 8192]).astype(np.float32)
            carry = s[-(NGRAM - 1):]
        return total if any_letter else None


@functools.lru_cache(1)
def _profiles() -> Profiles:
    return Profiles()


def learn(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their prototypes, one row each."""
    prepare(docs.sparkSession)

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for rb in batches:
            for text, lang in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                v = _profiles().of(text)
                if v is not None:
                    n = np.linalg.norm(v)
                    sums.setdefault(lang, np.zeros(DIM, dtype=np.int64))
                    sums[lang] += np.rint(v * (SCALE / n)).astype(np.int64) if n else 0
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * DIM, pa.string()), pa.array(range(DIM), pa.int32()),
                                              pa.array(total)], ["lang", "dim", "v"])

    rows = docs.select(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l")).where(
        "t is not null and l is not null")
    sums = (spread_small(rows).mapInArrow(frugal(run, _profiles), "lang string, dim int, v bigint")
            .groupBy("lang", "dim").agg(F.sum(F.col("v").cast("double")).alias("v")))
    # DIM rows per learned language
    got = sums.orderBy("lang", "dim").toPandas()
    langs = list(dict.fromkeys(got["lang"]))
    return langs, got["v"].to_numpy(dtype=np.float64).reshape(len(langs), DIM)


class Judge:
    def __init__(self, langs: list[str], prototypes: np.ndarray):
        self.langs = langs
        norms = np.linalg.norm(prototypes, axis=1, keepdims=True)
        unit = prototypes / np.where(norms > 0, norms, 1)
        self.unit = unit
        self.mean = unit.mean(axis=0) if len(langs) > 1 else np.zeros(DIM)
        rest = unit - self.mean
        norms = np.linalg.norm(rest, axis=1, keepdims=True)
        self.rest = rest / np.where(norms > 0, norms, 1)

    def __call__(self, text: str | None) -> tuple[str, float]:
        return self.with_fit(text)[:2]

    def with_fit(self, text: str | None) -> tuple[str, float, float]:
        """Language, score, and the cosine with the language's prototype itself."""
        v = _profiles().of(text) if text and self.langs else None
        if v is None:
            return UNKNOWN, 0.0, 0.0
        whole = v / (np.linalg.norm(v) or 1)
        v = whole - self.mean
        cosines = self.rest @ (v / (np.linalg.norm(v) or 1))
        best = int(np.argmax(cosines))         # ties: the first language by code point
        return self.langs[best], float(np.clip((1 + cosines[best]) / 2, 0, 1)), float(self.unit[best] @ whole)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], *, text_col: str = "text",
            pred_col: str = "lang_pred", score_col: str = "score", fit_col: str | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1: half of one plus the cosine).

    Null, empty and letterless texts, and every text if nothing could be
    learned, get ``und`` and score 0.  Each row is judged by its text alone;
    all columns are kept, and columns that have the results' names are
    replaced.  ``fit_col``, if given, gets the cosine with the prototype.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)    # one vector per language
    added = [pred_col, score_col, *([fit_col] if fit_col else [])]
    docs = docs.drop(*added)
    text_at = docs.columns.index(text_col)

    def run(batches):
        judge = Judge(*shared.value)
        for rb in batches:
            got = [judge.with_fit(t) for t in rb.column(text_at).to_pylist()]
            results = [pa.array([x[k] for x in got], pa.float64() if k else pa.string()) for k in range(len(added))]
            yield pa.RecordBatch.from_arrays([*rb.columns, *results], [*rb.schema.names, *added])

    schema = T.StructType(list(docs.schema.fields))
    for k, name in enumerate(added):
        schema = schema.add(name, "double" if k else "string")
    return spread_small(docs).mapInArrow(frugal(run, _profiles), schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model).drop("text")


def _length(text) -> Column:
    """Binary order of magnitude of a text's length."""
    return F.floor(F.log2(F.length(text))).cast("int")


def least_fits(marked: DataFrame, lang: str, text: str, pred: str, fit: str) -> DataFrame:
    """``lang, size, least``: per language and order of length, the least cosine with the prototype
    that is accepted, from training rows that were given their own language; an order that
    too few of them have takes the next smaller one's."""
    own = marked.where(F.col(pred) == F.col(lang).cast("string"))
    found = (own.groupBy(F.col(pred).alias("lang"), _length(text).alias("of"))
             .agg(F.percentile_approx(fit, QUANTILE, 10_000).alias("fit"), F.count("*").alias("n"))
             .where(F.col("n") >= ENOUGH))
    sizes = found.select("lang", "of", "fit", F.explode(F.sequence("of", F.lit(LONGEST))).alias("size"))
    return sizes.groupBy("lang", "size").agg((REJECT_BELOW * F.max_by("fit", "of")).alias("least"))


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose text has letters and fits a learned language.

    A text is held against training texts of its length, or else of the next
    smaller length that enough of them have; one shorter than all these stays.
    Null, empty and letterless texts go; without anything to learn from, all
    texts go.  Repeated rows stay as often as they come; a null ``lang`` is not learned
    from; other columns, whatever their names, go through; an empty table stays empty."""
    pred, score, fit, size = unused(docs, "_pred", "_score", "_fit", "_size")
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    # read back twice, for the limits and for the decision; predicted once
    marked = materialise(predict(docs, model, pred_col=pred, score_col=score, fit_col=fit))
    # a row for each language and order of length: written, so that Spark knows its size before it plans the join
    limits = materialise(least_fits(marked.where(~held_out(F.col("doc_id"))), "lang", "text", pred, fit))
    least = limits.select(F.col("lang").alias(pred), F.col("size").alias(size), F.col("least").alias(score))
    judged = marked.drop(score).withColumn(size, _length("text")).join(least, [pred, size], "left")
    fits = F.col(fit) >= F.coalesce(F.col(score), F.lit(-1.0))
    return judged.where((F.col(pred) != UNKNOWN) & fits).select(*docs.columns)
