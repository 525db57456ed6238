"""The query side of the similarity search, in blocks on the shared folder.

Spark tasks write the query vectors, sorted by set, as Parquet files of at most
about ``block_bytes`` of vectors each; the tasks that read the store open these
files themselves and hold one block at a time.  No vector passes through the
driver, which only counts rows and bytes and knows the files' names.

The folder must be one that Arrow can open in a task (a mounted folder, HDFS,
S3, GCS ...); ``write_query_blocks`` refuses another one when the plan is made.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.session import shared_path
from vellum.sources.shared_files import files_of, open_input


@dataclass(frozen=True)
class Block:
    """Query vectors as rows of ``matrix``, the rows of ``sets[i]`` from ``starts[i]`` on."""
    sets: np.ndarray
    starts: np.ndarray
    matrix: np.ndarray


@dataclass(frozen=True)
class QueryBlocks:
    """Names of the block files; picklable, so it goes to the tasks as it is."""
    files: Sequence[str]
    dim: int

    def __bool__(self) -> bool:
        return bool(self.files)

    @property
    def single(self) -> bool:
        return len(self.files) == 1

    def read(self) -> Iterator[Block]:
        for name in self.files:
            yield read_block(name)


def read_block(uri: str) -> Block:
    import pyarrow.parquet as pq
    with open_input(uri) as f:
        table = pq.ParquetFile(f).read(columns=["s", "v"])
    vectors = table["v"].combine_chunks()
    matrix = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
    sets = table["s"].to_numpy()
    starts = np.r_[0, np.nonzero(sets[1:] != sets[:-1])[0] + 1]
    return Block(sets[starts], starts, matrix)


def write_query_blocks(queries: DataFrame, set_col: str, vec_col: str, dim: int | None,
                       block_bytes: int) -> QueryBlocks:
    """Query vectors (rows without a set are in none) as block files.

    Vectors that are null or differ in length are refused.  Blocks are ranges
    of (set, hash of the row): sets lie together, and one set may be larger than a
    block, so its maximum may have to be combined from several.
    """
    spark = queries.sparkSession
    rest = [F.col(c) for c in queries.columns if c != vec_col]
    src = queries.where(F.col(set_col).isNotNull()).select(
        F.col(set_col).cast("bigint").alias("s"), F.col(vec_col).cast("array<double>").alias("v"), F.xxhash64(*rest).alias("h"))
    size = F.coalesce(F.size("v"), F.lit(-1))
    n, least, most = src.agg(F.count(F.lit(1)), F.min(size), F.max(size)).first()
    if not n:
        return QueryBlocks([], dim or 0)
    if least != most or least < 0 or (dim is not None and least != dim):
        raise ValueError("query vectors have inconsistent dimensions")
    blocks = max(1, -(-n * max(1, least) * 8 // block_bytes))
    folder = shared_path(spark, "query-blocks", unique=True)
    (src.repartitionByRange(int(blocks), "s", "h").sortWithinPartitions("s", "h").drop("h")
     .write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(folder))
    files = sorted(files_of(spark.read.parquet(folder)))
    try:
        open_input(files[0]).close()
    except (pa.ArrowException, OSError, ValueError) as exc:
        raise ValueError(f"tasks cannot open the shared folder: {files[0]}") from exc
    return QueryBlocks(files, int(least))


def lists_of(rb: pa.RecordBatch, dim: int) -> np.ndarray:
    """The vectors of a batch (second column) as a matrix."""
    vecs = rb.column(1)
    offs = np.asarray(vecs.offsets)
    if np.any(np.diff(offs) != dim) or vecs.null_count:
        raise ValueError(f"embedding vectors must all have {dim} values")
    values = np.asarray(pc.fill_null(vecs.values, float("nan")), dtype=np.float64)
    return values[offs[0]:offs[-1]].reshape(-1, dim)


def tiles(batches: Iterator[pa.RecordBatch], dim: int, most_bytes: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, matrix) of consecutive store rows, each of at least ``most_bytes`` but for the last."""
    ids, rows, held = [], [], 0
    for rb in batches:
        if not rb.num_rows:
            continue
        ids.append(rb.column(0))
        rows.append(lists_of(rb, dim))
        held += rows[-1].nbytes
        if held >= most_bytes:
            yield pa.concat_arrays(ids), np.concatenate(rows)
            ids, rows, held = [], [], 0
    if ids:
        yield pa.concat_arrays(ids), np.concatenate(rows)
