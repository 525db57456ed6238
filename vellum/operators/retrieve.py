"""Retrieval: similarity, max over a query set, threshold, top-k, gather.

A *query set* is several phrasings of one question: a chunk's score for the
set is the maximum dot product over its phrasings (the reference calls it
cosine similarity; it is cosine only for unit vectors).  Chunks with a score
``>= threshold`` (NaN never passes) are ranked by score descending, ties by id,
and the first ``k`` kept.  Scores are compared to 12 places, which is what a
double keeps of a sum whatever its order; the reported similarity is rounded
to 6 places for display only.

Many query sets run in one job, and the chunk side is never shuffled whole:

* ``score_sets`` (default engine) is a block product of both sides: tasks write the
  query side as block files (``query_blocks``), and each task that reads the store takes
  tiles of its vectors through one block at a time (NumPy/BLAS), takes the
  per-set maximum, applies the threshold and keeps the k first rows per set by
  the total order (score, id);
* ``score_sets_native`` computes the same with higher-order functions in the
  JVM against the query sets packed by a scalar subquery (no join).

The final ranking is a ``row_number() <= k`` window per set, which Spark
plans with a partial window-group limit before its shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions.vectors import dot
from vellum.operators.query_blocks import Block, QueryBlocks, tiles, write_query_blocks

# Label of the similarity function in results; defaults.
SIMILARITY_FUNCTION = "cosine_similarity"
DEFAULT_TOP_K = 5
DEFAULT_THRESHOLD = 0.15

QUERY_BLOCK_BYTES = 64 << 20     # query vectors shipped to a task at a time
TILE_BYTES = 32 << 20            # scores held by a task at a time
STORE_TILE_BYTES = 64 << 20      # store vectors that a task takes through all query blocks
RANK_PLACES = 12                 # scores that agree so far are ties


def check_top_k(k: int) -> None:
    if k < 0:
        raise ValueError("top_k must be >= 0")


def query_blocks(queries: DataFrame, set_col: str = "query_set_id", vec_col: str = "embedding",
                 block_bytes: int | None = None) -> list[DataFrame]:
    """Split the query side into blocks of at most about ``block_bytes`` of vectors.

    Rows are spread by a hash of (set, query) so that even one huge query
    set is divided evenly; the maximum over a set is combined across blocks
    afterwards.  One block (no split) in the usual case.
    """
    limit = block_bytes or QUERY_BLOCK_BYTES
    n, d = queries.agg(F.count("*"), F.max(F.size(vec_col))).first()
    size = n * max(d or 0, 1) * 8
    if size <= limit:
        return [queries]
    blocks = -(-2 * size // limit)
    key = F.pmod(F.xxhash64(*[F.col(c) for c in queries.columns if c != vec_col]), F.lit(blocks))
    tagged = queries.withColumn("_block", key)
    return [tagged.where(F.col("_block") == b).drop("_block") for b in range(blocks)]


def _combine_blocks(parts: list[DataFrame], id_col: str, set_col: str) -> DataFrame:
    if len(parts) == 1:
        return parts[0]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(set_col, id_col).agg(F.max("score").alias("score"))


def _prune(set_idx: np.ndarray, score: np.ndarray, ids: pa.Array, k: int):
    """Keep the k first rows per set by (score descending, id ascending)."""
    if len(score) == 0:
        return set_idx, score, ids
    table = pa.table({"s": pa.array(set_idx), "key": pa.array(np.round(score, RANK_PLACES)), "id": ids})
    order = np.asarray(pc.sort_indices(table, [("s", "ascending"), ("key", "descending"), ("id", "ascending")]))
    s = set_idx[order]
    pos = np.arange(len(s))
    first = np.r_[True, s[1:] != s[:-1]]
    idx = order[pos - np.maximum.accumulate(np.where(first, pos, 0)) < k]
    return set_idx[idx], score[idx], ids.take(pa.array(idx))


def score_sets(db: DataFrame, queries: DataFrame, *, k: int | None, threshold: float,
               id_col: str = "id", vec_col: str = "embedding",
               set_col: str = "query_set_id", dim: int | None = None,
               block_bytes: int | None = None) -> DataFrame:
    """Candidate rows ``(query_set_id, <id_col>, score)`` via Arrow + BLAS.

    The store is read once, whatever the number of query blocks: a task takes
    a tile of store vectors and multiplies it with one block after the other.
    With one block, the block is held and the store streams by.

    With ``k``, every row that can be in a set's top-k is among the candidates:
    a chunk that wins globally is within the top-k of the block in which its maximum is
    reached, so per-block top-k followed by the maximum over blocks loses
    nothing.  ``k=None`` gives all rows that pass, without any top-k state.
    """
    if k is not None:
        check_top_k(k)
    id_type = dict(db.select(id_col).dtypes)[id_col]
    schema = f"{set_col} bigint, `{id_col}` {id_type}, score double"
    blocks = write_query_blocks(queries, set_col, "embedding", dim, block_bytes or QUERY_BLOCK_BYTES)
    if not blocks or k == 0:
        return db.sparkSession.createDataFrame([], schema)
    src = db.select(F.col(id_col), F.col(vec_col).cast("array<double>").alias(vec_col))
    scores = src.mapInArrow(_score_task(blocks, k, threshold, [set_col, id_col, "score"]), schema)
    if not blocks.single:
        scores = scores.groupBy(set_col, id_col).agg(F.max("score").alias("score"))
    return scores


def _below_kth(scores: np.ndarray, k: int) -> np.ndarray:
    """Per column a bound that no row among the k first, ties included, lies below."""
    kth = np.partition(scores, len(scores) - k, axis=0)[len(scores) - k]
    with np.errstate(invalid="ignore"):
        return kth - 2 * 10.0 ** -RANK_PLACES - 1e-15 * np.abs(kth)


def _passing(x: np.ndarray, ids: pa.Array, kept: _Candidates, threshold: float) -> Iterator[tuple]:
    """(places of sets, scores, ids) of the pairs that pass, tile by tile of scores; with ``k``
    without those that k others of the tile, or of the candidates so far, are ahead of."""
    block, k = kept.block, kept.k
    turned = np.ascontiguousarray(block.matrix.T)
    step = max(1, TILE_BYTES // (8 * turned.shape[1]))
    for lo in range(0, len(x), step):
        best = np.maximum.reduceat(x[lo:lo + step] @ turned, block.starts, axis=1)
        with np.errstate(invalid="ignore"):
            passes = best >= (threshold if k is None else np.maximum(threshold, kept.floor))
            if k is not None and len(best) > k and np.count_nonzero(passes) > 2 * k * len(block.sets):
                passes &= best >= _below_kth(np.where(passes, best, -np.inf), k)
        rows, sets = np.nonzero(passes)
        if len(rows):
            yield sets.astype(np.int64), best[rows, sets], ids.take(pa.array(rows + lo))


class _Candidates:
    """The k first rows per set so far (all rows of the last call if k is None)."""

    def __init__(self, k: int | None, block: Block):
        self.k, self.block = k, block
        self.sets, self.scores, self.ids = np.zeros(0, dtype=np.int64), np.zeros(0), None
        self.floor = np.full(len(block.sets), -np.inf)       # what is lower is not among the k first

    def add(self, sets, scores, ids) -> None:
        self.sets, self.scores = np.concatenate([self.sets, sets]), np.concatenate([self.scores, scores])
        self.ids = ids if self.ids is None else pa.concat_arrays([self.ids, ids])
        if self.k is not None and len(self.scores) > 4 * self.k * len(self.block.sets) + 4096:
            self.prune()

    def prune(self) -> None:
        self.sets, self.scores, self.ids = _prune(self.sets, self.scores, self.ids, self.k)
        full = np.bincount(self.sets, minlength=len(self.floor)) >= self.k
        least = np.full(len(self.floor), np.inf)
        np.minimum.at(least, self.sets, self.scores)
        with np.errstate(invalid="ignore"):
            self.floor = np.where(full, least - 2 * 10.0 ** -RANK_PLACES - 1e-15 * np.abs(least), -np.inf)

    def batches(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        if self.ids is not None:
            if self.k is not None:
                self.prune()
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.block.sets[self.sets], pa.int64()), self.ids, pa.array(self.scores, pa.float64())], names=names)
        self.__init__(self.k, self.block)


def _score_task(blocks: QueryBlocks, k: int | None, threshold: float, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if blocks.single:
            kept = None
            for ids, x in tiles(batches, blocks.dim, 0):
                kept = kept or _Candidates(k, next(blocks.read()))
                for found in _passing(x, ids, kept, threshold):
                    kept.add(*found)
                    if k is None:
                        yield from kept.batches(names)
            if kept is not None:
                yield from kept.batches(names)
            return
        for ids, x in tiles(batches, blocks.dim, STORE_TILE_BYTES):
            for block in blocks.read():
                kept = _Candidates(k, block)
                for found in _passing(x, ids, kept, threshold):
                    kept.add(*found)
                    if k is None:
                        yield from kept.batches(names)
                yield from kept.batches(names)

    return run


def packed_query_sets(queries: DataFrame, set_col: str = "query_set_id",
                      vec_col: str = "embedding", checked: bool = False) -> Column:
    """Scalar subquery: ``array<struct<set, vectors>>`` of the query sets.

    The caller passes a block already bounded by ``query_blocks`` (or the
    count is checked here)."""
    if not checked and len(query_blocks(queries, set_col, vec_col)) > 1:
        raise ValueError("the query vectors exceed one block; use query_blocks")
    per_set = queries.groupBy(F.col(set_col).cast("bigint").alias("s")).agg(
        F.collect_list(F.col(vec_col).cast("array<double>")).alias("vs"))
    return per_set.agg(F.collect_list(F.struct("s", "vs")).alias("sets")).scalar()


def score_sets_native(db: DataFrame, queries: DataFrame, *, threshold: float,
                      id_col: str = "id", vec_col: str = "embedding",
                      set_col: str = "query_set_id", dim: int | None = None,
                      block_bytes: int | None = None) -> DataFrame:
    """All passing ``(query_set_id, id, score)`` rows, computed in the JVM
    (blocks of query vectors combined by maximum)."""
    parts = [_score_block_native(db, qb, threshold=threshold, id_col=id_col, vec_col=vec_col,
                                 set_col=set_col, dim=dim)
             for qb in query_blocks(queries, set_col, "embedding", block_bytes)]
    return _combine_blocks(parts, id_col, set_col)


def _score_block_native(db: DataFrame, queries: DataFrame, *, threshold: float, id_col: str,
                        vec_col: str, set_col: str, dim: int | None) -> DataFrame:
    packed = packed_query_sets(queries, set_col, vec_col, checked=True)
    e = F.col(vec_col).cast("array<double>")
    if dim is not None:
        e = F.when(F.size(e) == dim, e).otherwise(F.raise_error(F.lit(f"embedding size must be {dim}")))
    per_set = F.transform(F.col("_qs"), lambda g: F.struct(
        g["s"].alias(set_col),
        F.array_max(F.transform(g["vs"], lambda q: dot(F.col("_e"), q))).alias("score")))
    passing = F.filter(per_set, lambda p: ~F.isnan(p["score"]) & (p["score"] >= F.lit(threshold)))
    return (db.select(F.col(id_col), e.alias("_e"), packed.alias("_qs"))
            .select(id_col, F.explode(passing).alias("p"))
            .select(F.col(f"p.{set_col}").alias(set_col), id_col, F.col("p.score").alias("score")))


def rank_key(score: str = "score") -> Column:
    return F.round(score, RANK_PLACES)


def rank_top_k(scores: DataFrame, k: int, id_col: str = "id",
               set_col: str = "query_set_id") -> DataFrame:
    """``similarity`` (6 places) and 1-based ``rank`` per set; keeps rank <= k."""
    check_top_k(k)
    sim = scores.withColumn("similarity", F.round("score", 6))
    w = Window.partitionBy(set_col).orderBy(rank_key().desc(), F.col(id_col).asc())
    return sim.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k_single(scores: DataFrame, k: int, id_col: str = "id") -> DataFrame:
    """Top-k of one query set: a global ``orderBy().limit(k)``
    (TakeOrderedAndProject: per-partition top-k, then a k-row merge)."""
    check_top_k(k)
    sim = scores.withColumn("similarity", F.round("score", 6))
    top = sim.orderBy(rank_key().desc(), F.col(id_col).asc()).limit(k)
    return top


MAX_PUSHED_IDS = 100            # ids in an IN list: Parquet's filter is a chain as deep as the list is long
MAX_BROADCAST_ROWS = 1_000_000  # winners (id, scores) that are broadcast


def late_materialise(top: DataFrame, db: DataFrame, id_col: str = "id",
                     cols: tuple[str, ...] = ("content", "metadata"),
                     max_rows: int | None = None, push_ids: bool = True) -> DataFrame:
    """Fetch content and metadata for the winners only.

    ``top`` is bounded by k x sets (``max_rows`` when the caller knows it).
    The winners are checkpointed (one scoring pass).  When there are few of
    them their ids are pushed into the store scan as an ``IN`` filter (row
    groups are skipped by the bloom filter; the session's limit on the length
    of such lists is raised as far as needed).  More are only joined: Spark hands
    the list to Parquet as nested ORs, which overflow a task's stack at about a thousand,
    and so many ids leave few row groups to skip.  The store side is read
    column-pruned and joined to the winners.
    """
    store = db.select(id_col, *cols)
    bounded = max_rows is not None and max_rows <= MAX_BROADCAST_ROWS
    if max_rows is not None:
        top = top.checkpoint(eager=True)
    if push_ids and bounded and max_rows <= MAX_PUSHED_IDS:
        ids = [r[0] for r in top.select(id_col).distinct().collect()]
        conf, name = db.sparkSession.conf, "spark.sql.parquet.pushdown.inFilterThreshold"
        conf.set(name, str(max(int(conf.get(name)), len(ids))))
        store = store.where(F.col(id_col).isin(ids)) if ids else store.limit(0)
    return store.join(F.broadcast(top) if bounded else top, id_col, "inner")


def result_columns(df: DataFrame, embedding_model: str) -> DataFrame:
    return (df.withColumn("similarity_function", F.lit(SIMILARITY_FUNCTION))
            .withColumn("embedding_model", F.lit(embedding_model)))


def render(df: DataFrame) -> DataFrame:
    """Display form: document number and similarity to 4 places."""
    return (df.withColumn("document_number", F.col("rank").cast("int"))
            .withColumn("similarity_text", F.format_string("%.4f", F.col("score"))))
