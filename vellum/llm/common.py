"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.session import ensure_checkpoint_dir, read_table, ship_package
from vellum.sources.shared_files import delete

__all__ = ["read_table", "prepare", "materialise", "release", "Scratch", "frugal", "unused", "slices", "spread_small", "utf8", "held_out"]

#: Bytes of text that a Python task holds as NumPy arrays at a time (one text may be longer).
SLICE_BYTES = 2 << 20
#: Bytes of a record batch between Spark and a Python task (one row may be larger).
BATCH_BYTES = 8 << 20

def prepare(spark: SparkSession) -> SparkSession:
    """Checkpoint folder set (the session's own setting comes first), the
    package known to the Python workers, and record batches bounded in bytes:
    texts vary in length too much for a bound on rows."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ship_package(spark)
    return spark


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back:
    cuts the lineage, survives lost executors, and is computed once however
    often it is used."""
    spark = df.sparkSession
    path = "/".join([ensure_checkpoint_dir(spark).rstrip("/"), "vellum-llm", uuid.uuid4().hex])
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(*written: DataFrame) -> None:
    """Delete what ``materialise`` wrote.  For frames whose last reader has itself been
    written: nothing may be computed from them any more, not even again."""
    for df in written:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if "/vellum-llm/" in folder:
                delete(df.sparkSession, folder)


class Scratch:
    """Tables that a step writes for itself; ``drop`` deletes them when its result
    has been written."""

    def __init__(self):
        self.tables: list[DataFrame] = []

    def write(self, df: DataFrame) -> DataFrame:
        self.tables.append(materialise(df))
        return self.tables[-1]

    def drop(self) -> None:
        release(*self.tables)
        self.tables = []


@functools.lru_cache(1)
def _libc():
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None


def frugal(run: Callable, *caches) -> Callable:
    """A task's body that gives its memory back when it ends (workers are kept for
    later tasks, and with them all that the allocators hold); ``caches`` are emptied."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            for cache in caches:
                cache.cache_clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            if _libc() is not None and hasattr(_libc(), "malloc_trim"):
                _libc().malloc_trim(0)

    return task


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def spread_small(df: DataFrame) -> DataFrame:
    """At least one partition per core for CPU-heavy row work on few splits."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores // 2 else df


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column (null: empty), without a copy per row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if column.null_count == 0 else (
        column.fill_null("").cast(pa.large_binary()))
    offs = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return data[offs[0]:offs[-1]] if len(offs) else data[:0], offs - (offs[0] if len(offs) else 0)


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each has about ``limit`` bytes of text."""
    for rb in batches:
        if not rb.num_rows:
            continue
        col = rb.column(rb.schema.get_field_index(text))
        size = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0), dtype=np.int64))
        start = 0
        while start < rb.num_rows:
            base = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, base + limit, side="right")))
            yield rb.slice(start, stop - start)
            start = stop


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's text mod 3 is 1 (a null id is held out: it has no text)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))
