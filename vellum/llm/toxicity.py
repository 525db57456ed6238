"""Toxicity scores by non-negative positive-unlabelled learning.

Only confirmed toxic texts teach as such; the other texts are an unlabelled
sample of the corpus, which holds toxic texts in the share of the class
prior pi.  A linear model on the presence of byte n-grams minimises the
class-prior-corrected risk with logistic loss

    pi * R+(toxic)  +  max(0, R-(unlabelled) - pi * R-(toxic))

(where the second part falls below zero, a step goes against its gradient).

The sample is bounded: at most ``POSITIVE`` toxic and ``UNLABELLED`` other texts, the
ones with the smallest hash of their id.  Which n-grams the model looks at
is counted over the sample in Spark: those that are ``LIFT`` times as frequent in
toxic texts as in the sample.  Scoring is one map over all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import held_out, materialise, prepare, read_table, slices, spread_small, utf8
from vellum.llm.words import _BASE, _BYTE, _INVERSE, _powers, _room, LOWER, mix64

POSITIVE, UNLABELLED = 4_000, 12_000   # bound of the training sample
GRAMS = (5, 6, 8)                      # bytes of an n-gram
BITS = 25                              # features are told apart by a hash of so many bits
OFTEN = 3
FEATURES, LIFT, SEEN = 4_096, 4.0, 4   # n-grams looked at, at most; their lift; toxic texts that have them
SIGMAS = 1.0                           # by which the count of those is lowered for the lift
STEPS, RATE, SHRINK = 400, 0.1, 1e-4   # of the training
BETA, GAMMA = 0.0, 1.0                 # of the non-negative correction
TOXIC = 0.7

_FOLDED = LOWER.copy()
_FOLDED[:48] = _FOLDED[58:65] = _FOLDED[91:97] = _FOLDED[123:128] = 32     # neither letter nor digit: a space


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, n-gram's hash) of every n-gram; spaces stand at an n-gram's ends only,
    and at least one letter or digit between them."""
    data, offs = utf8(column)
    # each text between two spaces
    n_rows, sizes = len(offs) - 1, np.diff(offs)
    room = np.full(len(data) + 2 * n_rows, 32, dtype=np.uint8)
    row = np.repeat(np.arange(n_rows, dtype=np.int64), sizes + 2)
    inner = np.arange(len(data)) + 2 * np.repeat(np.arange(n_rows), sizes) + 1
    room[inner] = _FOLDED[data]
    n = len(room)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[room] * _powers(_room(n), int(_BASE))[:n], out=sums[1:], dtype=np.uint64)
    spaces = np.concatenate([[0], np.cumsum(room == 32)])
    rows, features = [], []
    for k in GRAMS:
        if n < k:
            continue
        at = np.nonzero((spaces[k - 1:n] - spaces[1:n - k + 2]) == 0)[0]     # none but at the ends
        h = mix64((sums[at + k] - sums[at]) * _powers(_room(n), int(_INVERSE))[at] + np.uint64(k))
        rows.append(row[at])
        features.append((h >> np.uint64(65 - BITS)).astype(np.int64))
    if not rows:
        return (np.zeros(0, dtype=np.int64),) * 2
    return np.concatenate(rows), np.concatenate(features)


def present(column: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs, of the wanted features only.  An n-gram has
    two features: that it is there (even), and that it is there OFTEN (odd)."""
    row, gram = grams(column)
    if wanted is not None:
        hit = (wanted[::2] | wanted[1::2])[gram]
        row, gram = row[hit], gram[hit]
    pairs, counts = np.unique((row << BITS) | (gram << 1), return_counts=True)
    pairs = np.sort(np.concatenate([pairs, pairs[counts >= OFTEN] + 1]))
    if wanted is not None:
        pairs = pairs[wanted[pairs & ((1 << BITS) - 1)]]
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, float]:
    """Training rows (text, toxic), a bounded number of them, and the class prior."""
    taught = labels.where("toxic is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_y"))
    taught = taught.where(~held_out(F.col("_id")))
    n, toxic = taught.agg(F.count("*"), F.sum((F.col("_y") == 1).cast("int"))).first()
    ids = docs.select(F.col(id_col).alias("_id")).where(~held_out(F.col("_id")))
    order = [F.xxhash64(F.lit(29), "_id"), F.col("_id")]
    yes = taught.where("_y = 1").select("_id").orderBy(*order).limit(POSITIVE).withColumn("toxic", F.lit(1))
    rest = ids.distinct().orderBy(*order).limit(UNLABELLED).withColumn("toxic", F.lit(0))
    chosen = materialise(yes.unionByName(rest))         # at most POSITIVE + UNLABELLED ids
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(
        F.broadcast(chosen), "_id").select("_id", "text", "toxic")
    return rows, (toxic or 0) / n if n else 0.0


class Model:
    """Chosen features (sorted), their weights, the intercept."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, intercept: float):
        self.features, self.weights, self.intercept = features, weights, intercept

    def wanted(self) -> np.ndarray:
        """A flag for each feature there can be; for ``scores``, made once per task."""
        out = np.zeros(1 << BITS, dtype=bool)
        out[self.features] = True
        return out

    def scores(self, column: pa.Array, wanted: np.ndarray | None = None) -> np.ndarray:
        wanted = self.wanted() if wanted is None else wanted
        total = np.full(len(column), self.intercept)
        row, feature = present(column, wanted)
        if len(row):
            total += np.bincount(row, self.weights[np.searchsorted(self.features, feature)], minlength=len(column))
        return 1 / (1 + np.exp(-total))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from rows that are not held out.  Without toxic texts the model
    has no features and gives every text a score of 0.0003."""
    prepare(docs.sparkSession)
    rows, prior = sample(docs, labels, id_col, text_col)
    rows = materialise(rows)

    def count(batches):
        for rb in slices(batches, "text"):
            row, feature = present(rb.column(1))
            toxic = np.asarray(rb.column(2))[row]
            every, at = np.unique(feature, return_inverse=True)
            yes = np.bincount(at, toxic, minlength=len(every)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(every), pa.array(yes), pa.array(np.bincount(at, minlength=len(every)) - yes)],
                                             ["feature", "yes", "rest"])

    size = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    n_yes, n_rest = size.get(1, 0), size.get(0, 0)
    if not n_yes or not n_rest:
        return Model(np.zeros(0, dtype=np.int64), np.zeros(0), -8.0)
    seen = rows.mapInArrow(count, "feature bigint, yes bigint, rest bigint").groupBy("feature").agg(
        F.sum("yes").alias("yes"), F.sum("rest").alias("rest")).where(F.col("yes") >= SEEN)
    # what the count of toxic texts is at least, within so many standard deviations
    sure = F.col("yes") - SIGMAS * F.sqrt("yes")
    lift = (sure / n_yes) / ((F.col("rest") + 1) / n_rest)
    seen = seen.withColumn("lift", lift).where(F.col("lift") >= min(LIFT, 0.5 / max(prior, 1e-6)))
    features = np.array(sorted(r[0] for r in seen.orderBy(F.desc(F.col("yes") * F.log("lift")), "feature").limit(FEATURES)
                               .select("feature").collect()), dtype=np.int64)
    wanted = np.zeros(1 << BITS, dtype=bool)
    wanted[features] = True
    shared = docs.sparkSession.sparkContext.broadcast(features)

    def reduced(batches):
        wanted = np.zeros(1 << BITS, dtype=bool)
        wanted[shared.value] = True
        for rb in slices(batches, "text"):
            row, feature = present(rb.column(1), wanted)
            at = np.searchsorted(row, np.arange(rb.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.searchsorted(shared.value, feature)))
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(2), lists], ["_id", "toxic", "found"])

    # the sample's chosen features: a bounded number of rows
    kind = rows.schema["_id"].dataType.simpleString()
    got = rows.mapInArrow(reduced, f"_id {kind}, toxic int, found array<bigint>").toArrow().sort_by([("toxic", "ascending"), ("_id", "ascending")])
    toxic = np.asarray(got["toxic"].combine_chunks())
    found = got["found"].combine_chunks()
    offs = np.asarray(found.offsets)
    return Model(features, *nnpu(np.asarray(found.flatten()), np.repeat(np.arange(len(toxic)), np.diff(offs)),
                                 toxic == 1, len(features), prior))


def nnpu(column: np.ndarray, row: np.ndarray, toxic: np.ndarray, n_features: int, prior: float):
    """Weights and intercept by full-batch Adam on the non-negative PU risk."""
    w, m, v = np.zeros(n_features + 1), np.zeros(n_features + 1), np.zeros(n_features + 1)
    n_yes, n_rest = toxic.sum(), (~toxic).sum()
    prior = min(max(prior, 1e-3), 0.9)
    for step in range(1, STEPS + 1):
        z = np.bincount(row, w[column], minlength=len(toxic)) + w[-1]
        p = 1 / (1 + np.exp(-z))
        as_no = np.logaddexp(0, z)                       # loss if called toxic wrongly
        gap = as_no[~toxic].mean() - prior * as_no[toxic].mean()
        # d loss+/dz = p - 1, d loss-/dz = p
        plus = np.where(toxic, prior * (p - 1) / n_yes, 0.0)
        minus = np.where(toxic, -prior * p / n_yes, p / n_rest)
        g = plus + minus if gap >= -BETA else -GAMMA * minus
        grad = np.append(np.bincount(column, g[row], minlength=n_features), g.sum())
        grad[:-1] += SHRINK * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: Model, *, text_col: str = "text", keep: list[str]) -> DataFrame:
    """``keep`` with ``score`` and ``predicted`` for each row, judged by its text alone.

    Null and empty texts have no n-gram: their score is the intercept's, which
    stands for a text without any sign of toxicity.  Repeated rows get equal
    scores; other columns are not read; an empty table gives an empty result.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)         # at most FEATURES weights
    src = docs.select(*keep, F.col(text_col).alias("_text"))

    def run(batches):
        model = shared.value
        wanted = model.wanted()
        for rb in slices(batches, "_text"):
            s = model.scores(rb.column(rb.num_columns - 1), wanted)
            yield pa.RecordBatch.from_arrays([*rb.columns[:-1], pa.array(s), pa.array((s >= TOXIC).astype(np.int32))],
                                             [*rb.schema.names[:-1], "score", "predicted"])

    schema = T.StructType(list(src.schema.fields)[:-1]).add("score", "double").add("predicted", "integer")
    return spread_small(src).mapInArrow(run, schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return score(docs.withColumn("held_out", held_out(F.col("doc_id"))), model, keep=["doc_id", "held_out"])
