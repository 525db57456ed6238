"""Token accounting, the token guard, embedding batches and embedders.

* ``token_guard``: a chunk above 8191 tokens fails the build (``strict``) or
  is split off (``quarantine``).
* ``embed_batches``: the reference batching -- ``k = total_tokens // 100000``
  batches (one when ``k == 0``), equal-count runs in chunk order with the
  first ``n mod k`` one longer (NTILE with a computed ``k``).  Global row
  numbers come from a range-partitioned sort plus per-partition offsets,
  so no step gathers the table into one task.
* ``hash_embed``: the built-in offline embedder (native feature hashing).
* ``embed``: a user batch embedder run with ``mapInPandas``; batches are cut
  inside each task by a token budget, one client per task.  Builds use
  ``embed_cached`` instead: global batches, a cache of vectors, an audited join.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions.text import MAX_CHUNK_TOKENS, TOKENS_PER_BATCH, WORD_PATTERN
from vellum.functions.vectors import DEFAULT_DIM, hash_matrix, hash_vector

HASH_MODEL = "feature-hash-64"


def token_guard(df: DataFrame, tokens_col: str = "tokens", mode: str = "strict",
                limit: int = MAX_CHUNK_TOKENS) -> DataFrame:
    over = F.col(tokens_col) > F.lit(limit)
    if mode == "strict":
        fail = F.raise_error(F.lit(
            f"The total number of tokens for a chunk exceeds the limit of {limit} tokens. Use a smaller chunk size."))
        return df.where(F.when(over, fail).otherwise(F.lit(True)))
    if mode == "quarantine":
        return df.where(~over)
    if mode == "flag":
        return df.withColumn("within_limit", ~over)
    raise ValueError(f"unknown mode {mode!r}")


def over_limit(df: DataFrame, tokens_col: str = "tokens", limit: int = MAX_CHUNK_TOKENS) -> DataFrame:
    """What the guard's ``quarantine`` leaves out."""
    return df.where(F.col(tokens_col) > F.lit(limit))


def global_row_number(df: DataFrame, order_cols: Sequence[str], name: str = "row_number",
                      sum_col: str | None = None) -> DataFrame:
    """1-based row number over the total order of ``order_cols`` (unique key).

    Range-partition and sort, tag each row with (partition, position), count
    rows per partition and add the broadcast prefix offsets (one row per
    partition).  Adds ``_n``
    (total rows) and, with ``sum_col``, ``_total`` (its sum).
    """
    ranged = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    # (partition, position) tags are materialised once: the counts and the
    # numbering must see the same partitioning (AQE may coalesce two
    # consumers of one shuffle differently), and a recomputed partition after
    # an executor loss must not renumber rows.
    tagged = (ranged.withColumn("_pid", F.spark_partition_id())
              .withColumn("_local", F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
              .checkpoint(eager=True))
    aggs = [F.count(F.lit(1)).alias("_cnt")]
    if sum_col:
        aggs.append(F.sum(sum_col).alias("_psum"))
    counts = tagged.groupBy("_pid").agg(*aggs)
    every = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(every).alias("_n"),
        *([F.sum("_psum").over(every).alias("_total")] if sum_col else []))
    out = tagged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(name, F.col("_off") + F.col("_local") + 1).drop("_pid", "_local", "_off")


def ntile_index(r0: Column, n: Column, k: Column) -> Column:
    """0-based NTILE bucket of 0-based row ``r0`` among ``n`` rows in ``k`` buckets."""
    q = F.floor(n / k)
    m = n - q * k
    big = m * (q + 1)
    return F.when(r0 < big, F.floor(r0 / (q + 1))).otherwise(m + F.floor((r0 - big) / q)).cast("int")


def embed_batches(chunks: DataFrame, order_cols: Sequence[str], tokens_col: str = "tokens",
                  per_batch: int = TOKENS_PER_BATCH, keep: Sequence[str] = ("id",),
                  checkpoint: bool = True, place: str | None = None) -> DataFrame:
    """``keep`` columns + tokens + ``batch`` (0-based) and ``n_batches``; with ``place`` also the
    row number in chunk order under that name.

    The numbering reads its input three times (range sample, counts, rows);
    with ``checkpoint`` the narrow key/token projection is first written to
    the shared checkpoint folder, so the upstream chunking runs once and a
    lost executor does not recompute it.
    """
    cols = list(dict.fromkeys([*keep, *order_cols, tokens_col]))
    narrow = chunks.select(*cols)
    if checkpoint:
        narrow = narrow.checkpoint(eager=True)
    numbered = global_row_number(narrow, order_cols, "_rn", sum_col=tokens_col)
    k = F.greatest(F.floor(F.col("_total") / per_batch), F.lit(1))
    out = (numbered
           .withColumn("n_batches", k.cast("int"))
           .withColumn("batch", ntile_index(F.col("_rn") - 1, F.col("_n"), k)))
    return (out.withColumn(place, F.col("_rn")) if place else out).drop("_rn", "_n", "_total")


def hash_embed(df: DataFrame, text_col: str = "content", dim: int = DEFAULT_DIM,
               out_col: str = "embedding") -> DataFrame:
    return df.withColumn(out_col, hash_vector(text_col, dim))


# --- user embedders ------------------------------------------------------

Embedder = Callable[[list[str]], tuple[list[Sequence[float]], int]]


class HashEmbedder:
    """Python form of the feature-hashing embedder, usable through ``embed``.

    Same vectors as ``hash_vector``; lets the user-function path be checked
    against the native one.
    """

    def __init__(self, dim: int = DEFAULT_DIM):
        self.dim = dim
        import regex  # noqa: PLC0415 - worker-side import
        self._words = regex.compile(WORD_PATTERN)

    def __call__(self, texts: list[str]) -> tuple[list[np.ndarray], int]:
        found = [self._words.findall(t.lower()) for t in texts]
        return list(hash_matrix(found, self.dim)), sum(map(len, found))


def _budget_batches(tokens: np.ndarray, budget: int) -> list[slice]:
    """Consecutive runs whose token sum stays within ``budget`` (at least one row each)."""
    cuts, start, acc = [], 0, 0
    for i, t in enumerate(tokens):
        if i > start and acc + t > budget:
            cuts.append(slice(start, i))
            start, acc = i, 0
        acc += int(t)
    if start < len(tokens):
        cuts.append(slice(start, len(tokens)))
    return cuts


def embed(df: DataFrame, embedder_factory: Callable[[], Embedder], key_cols: Sequence[str],
          text_col: str = "content", tokens_col: str | None = "tokens",
          budget: int = TOKENS_PER_BATCH, dim: int = DEFAULT_DIM, max_attempts: int = 1,
          mode: str = "strict", wait_seconds: float = 0.0) -> DataFrame:
    """Run a user batch embedder over ``df`` in Arrow batches.

    ``key_cols`` are passed through (any columns: vectors never leave their
    row).  Attempts are ``wait_seconds`` apart, slept in the worker.
    Output: key columns, ``embedding ARRAY<DOUBLE>``, ``embed_tokens`` (tokens
    the provider reported for the call, on the first row of each call) and
    ``error`` (NULL on success).  ``strict`` fails the task after the last
    attempt; ``quarantine`` returns the failure in ``error``.  A returned
    vector whose length is not ``dim``, or a count mismatch, is a failure:
    nothing is silently truncated.
    """
    keys = list(key_cols)
    cols = list(dict.fromkeys([*keys, text_col, *([tokens_col] if tokens_col else [])]))
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                           for f in df.select(*keys).schema.fields)
    schema = f"{key_schema}, embedding array<double>, embed_tokens bigint, error string"

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = embedder_factory()
        for pdf in it:
            texts = pdf[text_col].tolist()
            toks = pdf[tokens_col].to_numpy() if tokens_col else np.ones(len(pdf), dtype=np.int64)
            vecs: list = [None] * len(pdf)
            used = [None] * len(pdf)
            errs: list = [None] * len(pdf)
            for sl in _budget_batches(toks, budget):
                last_exc = None
                for attempt in range(max_attempts):
                    if attempt and wait_seconds:
                        time.sleep(wait_seconds)
                    try:
                        got, n_used = client(texts[sl])
                        if len(got) != sl.stop - sl.start:
                            raise RuntimeError(f"embedder returned {len(got)} vectors for {sl.stop - sl.start} texts")
                        for j, v in enumerate(got):
                            arr = np.asarray(v, dtype=np.float64)
                            if arr.shape != (dim,):
                                raise RuntimeError(f"embedding of size {arr.size}, expected {dim}")
                            vecs[sl.start + j] = arr.tolist()
                        used[sl.start] = int(n_used)
                        last_exc = None
                        break
                    except Exception as exc:  # noqa: BLE001 - provider failure
                        last_exc = exc
                if last_exc is not None:
                    if mode == "strict":
                        raise RuntimeError(f"API request failed: {last_exc}")
                    for j in range(sl.start, sl.stop):
                        errs[j] = str(last_exc)
            out = pdf[keys].copy()
            out["embedding"] = vecs
            out["embed_tokens"] = pd.array(used, dtype="Int64")
            out["error"] = errs
            yield out

    return df.select(*cols).mapInPandas(run, schema)


def embed_text(spark, embedder_factory: Callable[[], Embedder], text: str,
               dim: int = DEFAULT_DIM) -> list[float]:
    """One text's vector (the vector itself, not a list of vectors)."""
    one = spark.createDataFrame([(0, text)], "k int, content string")
    row = embed(one, embedder_factory, ["k"], "content", None, dim=dim).first()
    return list(row.embedding)


def check_one_to_one(left: DataFrame, right: DataFrame, key: str = "id") -> None:
    one = F.lit(1)
    both = left.select(key, one.alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(key, F.lit(0).alias("_l"), one.alias("_r"))).groupBy(key).agg(F.sum("_l").alias("l"), F.sum("_r").alias("r"))
    a, b, j = both.agg(F.sum("l"), F.sum("r"), F.sum(((F.col("l") == 1) & (F.col("r") == 1)).cast("int"))).first()
    if not ((a or 0) == (b or 0) == (j or 0)):
        raise ValueError(f"chunks ({a}) and vectors ({b}) do not pair 1:1 ({j} joined)")
