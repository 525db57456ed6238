"""Embedding through a content-addressed cache, one provider call per batch.

``cached_embeddings`` embeds staged chunks:

1. a chunk's vector is that of its text: the digests of all chunks, left-anti the
   cache of the model, are what is missing, each text once;
2. the missing texts, in chunk order, are cut into the global token batches
   (``embed_batches``), and tasks are dealt whole batches: one batch is one call;
3. a call's vectors are written to the cache (through a journal) as soon as
   the call returns, so a build that ends early, or a task that is repeated, does not pay for
   them again;
4. chunks meet the cache by digest.

``attach_embeddings`` is the pairing of rows and vectors: one outer pass
that counts, or refuses, whatever has no partner or more than one.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from vellum.functions.text import TOKENS_PER_BATCH
from vellum.functions.vectors import DEFAULT_DIM
from vellum.operators.embed import embed_batches
from vellum.session import shared_path
from vellum.sources.journal import Journal
from vellum.sources.shared_files import exists, qualified

ENTRY = pa.schema([("digest", pa.string()), ("embedding", pa.list_(pa.float64())), ("call_tokens", pa.int64())])


def text_digest(text: str | Column) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.sha2(column.cast("binary"), 256)


def hex_digest(digest: str) -> Column:
    return F.lower(F.hex(digest))


def cache_folder(cache: str, model: str, dim: int) -> str:
    return f"{cache.rstrip('/')}/{quote(model, safe='')}-{dim}"


def cached_vectors(spark: SparkSession, cache: str, model: str, dim: int = DEFAULT_DIM) -> DataFrame | None:
    """``digest, embedding, call_tokens`` (tokens that the provider counted, on one row of each
    call); a text that two attempts embedded is there twice."""
    folder = cache_folder(cache, model, dim)
    if not exists(spark, folder):
        return None
    vectors = (spark.read.schema("digest string, embedding array<double>, call_tokens bigint")
               .option("recursiveFileLookup", "true").parquet(folder))
    return vectors if vectors.inputFiles() else None


def _checked(got, n: int, dim: int) -> list[list[float]]:
    if len(got) != n:
        raise RuntimeError(f"embedder returned {len(got)} vectors for {n} texts")
    out = []
    for v in got:
        a = np.asarray(v, dtype=np.float64)
        if a.shape != (dim,):
            raise RuntimeError(f"embedding of size {a.size}, expected {dim}")
        out.append(a.tolist())
    return out


def _whole_batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames sorted by ``batch``, regrouped so that each holds one batch."""
    held: list[pd.DataFrame] = []
    for pdf in frames:
        for batch, rows in pdf.groupby("batch", sort=False):
            if held and held[0]["batch"].iloc[0] != batch:
                yield pd.concat(held)
                held = []
            held.append(rows)
    if held:
        yield pd.concat(held)


def embed_into_cache(texts: DataFrame, embedder_factory: Callable, cache: str, model: str, order_cols: Sequence[str],
                     text_col: str = "content", tokens_col: str = "tokens", dim: int = DEFAULT_DIM, max_attempts: int = 1,
                     wait_seconds: float = 0.0, per_batch: int = TOKENS_PER_BATCH, missing: DataFrame | None = None) -> int:
    """Embed ``texts`` (binary ``digest``, text, tokens and a unique order; read several times, so give a
    written table); returns the number of batches.

    With ``missing`` (``digest``, tokens and order, without the text; read several times too)
    only these rows of ``texts`` are embedded."""
    spark = texts.sparkSession
    # places and tokens are numbered; texts join their batch afterwards
    numbered = embed_batches(texts if missing is None else missing, [*order_cols, "digest"], tokens_col, per_batch=per_batch,
                             keep=("digest",), checkpoint=False, place="place")
    names = {c: f"_{k}" for k, c in enumerate(["digest", *order_cols])}
    numbered = numbered.select(*[F.col(c).alias(n) for c, n in names.items()], "batch", "n_batches", "place")
    same = [F.col(c).eqNullSafe(F.col(n)) if c != "digest" else F.col(c) == F.col(n) for c, n in names.items()]
    dealt = (texts.select(*names, F.col(text_col).alias("text")).join(numbered, same)
             .select("batch", "n_batches", "place", "digest", "text").repartition("batch")
             .sortWithinPartitions("batch", "place").select("batch", "n_batches", hex_digest("digest").alias("digest"), "text"))
    job = Journal(qualified(spark, f"{cache_folder(cache, model, dim)}/{uuid.uuid4().hex}"), "digest", ENTRY)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        partition = TaskContext.get().partitionId()
        done, client, batches = job.recorded(partition), embedder_factory(), 0
        with job.writer(partition) as log:
            for pdf in _whole_batches(frames):
                batches = int(pdf["n_batches"].iloc[0])
                open_ = pdf[~pdf["digest"].isin(done)].drop_duplicates("digest")
                if not len(open_):
                    continue
                failure = None
                for attempt in range(max_attempts):
                    if attempt and wait_seconds:
                        time.sleep(wait_seconds)
                    try:
                        got, used = client(open_["text"].tolist())
                        vectors = _checked(got, len(open_), dim)
                        failure = None
                        break
                    except Exception as exc:  # noqa: BLE001 - provider failure
                        failure = exc
                if failure is not None:
                    raise RuntimeError(f"API request failed: {failure}")
                log.add(*({"digest": d, "embedding": v, "call_tokens": int(used) if k == 0 else None}
                          for k, (d, v) in enumerate(zip(open_["digest"], vectors, strict=True))))
                log.flush()                                  # the call is paid
        yield pd.DataFrame({"n": [batches]})

    return dealt.mapInPandas(run, "n int").agg(F.max("n")).first()[0] or 0


def cached_embeddings(chunks: DataFrame, embedder_factory: Callable, model: str, order_cols: Sequence[str], cache: str | None = None,
                      key: str = "id", text_col: str = "content", tokens_col: str = "tokens", dim: int = DEFAULT_DIM,
                      max_attempts: int = 1, wait_seconds: float = 0.0, per_batch: int = TOKENS_PER_BATCH) -> DataFrame:
    """``key, embedding`` for each row of ``chunks`` (a written table: it is read several times).

    Texts that the cache of ``model`` holds are not sent; without ``cache`` a new one is
    used.  The embedder is called before this returns; a failure fails it.
    """
    spark = chunks.sparkSession
    cache = cache or shared_path(spark, "vectors", unique=True)
    digests = chunks.withColumn("digest", F.unhex(text_digest(text_col)))         # half as long on its way
    # each missing text once, at its first place; the texts themselves stay where they are
    place = F.struct(*order_cols, tokens_col)
    firsts = digests.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min(place).alias("_place"))
    known = cached_vectors(spark, cache, model, dim)
    if known is not None:
        firsts = firsts.join(known.select(F.unhex("digest").alias("digest")).distinct(), "digest", "left_anti")
    path = shared_path(spark, "missing-texts", unique=True)
    firsts.select("digest", "_place.*").write.option("compression", "zstd").parquet(path)
    missing = spark.read.parquet(path)
    if not missing.isEmpty():
        embed_into_cache(digests, embedder_factory, cache, model, order_cols, text_col, tokens_col, dim, max_attempts,
                         wait_seconds, per_batch, missing)
    known = cached_vectors(spark, cache, model, dim)
    if known is None:
        return spark.createDataFrame([], f"{key} {dict(chunks.dtypes)[key]}, embedding array<double>")
    # both sides of the join are plain tables, so that Spark can split a text that very many
    # chunks share; vectors are written again only if a text is in the cache twice
    known = known.select(F.unhex("digest").alias("digest"), "embedding")
    if not known.groupBy("digest").count().where("count > 1").isEmpty():
        path = shared_path(spark, "needed-vectors", unique=True)
        (known.join(digests.select("digest").distinct(), "digest", "left_semi").dropDuplicates(["digest"])
         .write.option("compression", "zstd").parquet(path))
        known = spark.read.parquet(path)
    return digests.select(key, "digest").join(known, "digest").select(key, "embedding")


def attach_embeddings(chunks: DataFrame, vectors: DataFrame, key: str = "id", mode: str = "strict",
                      report: Observation | None = None) -> DataFrame:
    """1:1 join of rows and vectors by ``key``, audited in the same pass.

    A key without a partner, null, or there more than once on a side does not pair.  ``strict``
    fails on the first such row; ``report`` leaves these rows out, and the observation
    ``report`` gets ``paired``, ``without_vector``, ``without_chunk`` (the partner is missing or
    repeated) and ``repeated``: each row of both sides is in one of them.
    """
    if mode not in ("strict", "report"):
        raise ValueError(f"unknown mode {mode!r}")
    # the count needs the rows of a key together, which the join needs anyway
    times = F.count(F.lit(1)).over(Window.partitionBy(key))
    left = chunks.withColumn("_left", times)
    right = vectors.withColumn("_right", times)
    lone_left, lone_right = F.col("_right").isNull(), F.col("_left").isNull()
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    refuse = lambda cond, why: F.when(cond, F.raise_error(F.concat(F.lit(why + ": "), name))).otherwise(F.lit(True))
    if mode == "strict":
        # a repeated key is refused before the join could multiply it
        left = left.where(refuse(F.col("_left") > 1, "key is there more than once"))
        right = right.where(refuse(F.col("_right") > 1, "key is there more than once"))
        both = left.join(right, key, "full_outer")
        return (both.where(refuse(lone_left, "chunk without a vector")).where(refuse(lone_right, "vector without a chunk"))
                .drop("_left", "_right"))
    both = (left.where("_left = 1").join(right.where("_right = 1"), key, "full_outer")
            .unionByName(left.where("_left > 1"), allowMissingColumns=True).unionByName(right.where("_right > 1"), allowMissingColumns=True))
    repeated = (F.coalesce("_left", F.lit(0)) > 1) | (F.coalesce("_right", F.lit(0)) > 1)
    number = lambda cond: F.coalesce(F.sum(cond.cast("bigint")), F.lit(0))
    if report is not None:
        both = both.observe(report, number(~repeated & ~lone_left & ~lone_right).alias("paired"),
                            number(~repeated & lone_left).alias("without_vector"),
                            number(~repeated & lone_right).alias("without_chunk"), number(repeated).alias("repeated"))
    return both.where(~repeated & ~lone_left & ~lone_right).drop("_left", "_right")
