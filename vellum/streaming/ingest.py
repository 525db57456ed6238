"""Incremental store build over a growing corpus folder (Structured Streaming).

New files dropped into ``root/subject`` are picked up by a file stream; each
micro-batch runs the same build (admit, load, normalise, chunk, guard,
embed) and is added to the store as a part named by stream and epoch.  A
micro-batch that is replayed after a failure replaces exactly its own part, so
the store never holds a batch twice; the stream's checkpoint (in the shared checkpoint
folder) records which files were consumed.  ``read_store`` reads all parts of
a subject.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vellum.plans.build import build_database
from vellum.session import shared_path, table_path
from vellum.sources.corpus import file_format
from vellum.sources.shared_files import is_folder
from vellum.sources.store import write_store

def part_name(checkpoint_location: str, epoch_id: int) -> str:
    """A micro-batch's part of the store: one name for a stream and epoch."""
    return f"stream-{hashlib.sha256(checkpoint_location.encode()).hexdigest()[:16]}-{int(epoch_id)}"


BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def corpus_stream(spark: SparkSession, root: str, subject: str,
                  max_files_per_trigger: int = 1000) -> DataFrame:
    folder = root.rstrip("/") + "/" + subject
    raw = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
           .option("maxFilesPerTrigger", max_files_per_trigger)
           .load(folder))
    return raw.select(F.lit(subject).alias("subject"), "path", file_format("path").alias("format"), "content")


def start_ingest(spark: SparkSession, root: str, subject: str, store_path: str,
                 checkpoint_location: str | None = None, available_now: bool = True,
                 **build_kw) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and stops."""
    ckpt = checkpoint_location or shared_path(spark, "streams", "ingest", subject)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        rows = build_database(batch, **build_kw)
        write_store(rows, store_path, part=part_name(ckpt, epoch_id))

    writer = (corpus_stream(spark, root, subject).writeStream
              .foreachBatch(write_batch)
              .option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def table_stream_build(spark: SparkSession, sf_dir: str, store_path: str,
                       checkpoint_location: str | None = None, files_per_trigger: int = 1,
                       **build_kw) -> StreamingQuery:
    """The ``documents`` table (one file, or a folder of part files) read as a file stream
    (txt corpus rows) and built into the store micro-batch by micro-batch (idempotent epochs)."""
    ckpt = checkpoint_location or shared_path(spark, "streams", "documents", unique=True)
    table = table_path(sf_dir, "documents")
    reader = spark.readStream.schema(spark.read.parquet(table).schema).option("maxFilesPerTrigger", files_per_trigger)
    # a file stream reads folders only
    stream = reader.parquet(table) if is_folder(spark, table) else reader.option("pathGlobFilter", "documents.parquet").parquet(sf_dir)
    files = stream.select(
        F.col("lang").alias("subject"),
        F.format_string("corpus/%s/doc-%d.txt", F.col("lang"), F.col("doc_id")).alias("path"),
        F.lit("txt").alias("format"), F.col("text").alias("content"))

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        rows = build_database(batch, include_pdf=False, **build_kw)
        write_store(rows, store_path, part=part_name(ckpt, epoch_id))

    return (files.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
